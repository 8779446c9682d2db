"""JSON text to one VARIANT per field, each message parsed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscore.functions.sql import text

# A last member put into every message, so that anything left over behind the message is noticed:
# without it the parser stops at the closing brace and takes `{"a": 1} rest` as good.
_END_KEY, _END = "logscore:end", "of message"
_CORRUPT_KEY = "logscore:corrupt"
#: Columns that `decode` adds; messages may not have them.
MESSAGE, IS_OBJECT = "_message", "_is_object"
# JSON white space, as the characters that TRIM removes.
_SPACE = r"' \t\r\n'"


def _options(non_finite: bool) -> dict[str, str]:
    return {
        "columnNameOfCorruptRecord": _CORRUPT_KEY,
        "allowSingleQuotes": "false",
        "allowNonNumericNumbers": str(non_finite).lower(),
    }


def once(df: DataFrame, expression: Column, name: str) -> DataFrame:
    """Add a column that is computed exactly once per row.

    Catalyst copies a projected expression into every filter and field read above it. It does not
    move anything across a generator, and exploding a one-element array leaves the rows as they are.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))


def as_text(raw: DataFrame) -> DataFrame:
    """`value` as a string; a message broker hands it over as bytes."""
    if raw.schema["value"].dataType == T.BinaryType():
        return raw.withColumn("value", F.col("value").cast("string"))
    return raw


def _with_members(raw: DataFrame) -> DataFrame:
    """Add `_members`, an object's text up to its closing brace; NULL if it does not end in one."""
    trimmed = f"CASE WHEN endswith(value, '}}') THEN value ELSE trim(TRAILING {_SPACE} FROM value) END"
    text = raw.withColumn("_text", F.expr(trimmed))
    # Cut as bytes, which need no counting of characters.
    members = "CAST(substring(CAST(_text AS BINARY), 1, octet_length(_text) - 1) AS STRING)"
    return text.withColumn(
        "_members", F.expr(f"CASE WHEN endswith(_text, '}}') THEN {members} END")
    ).drop("_text")


def _with_end_member() -> Column:
    """The object's text with a last member added, which an empty object takes without a comma."""
    empty = r"NOT endswith(_members, '\"') AND _members RLIKE r'\{[ \t\r\n]*\z'"
    end = text(f'"{_END_KEY}":"{_END}"}}')
    return F.expr(f"concat(_members, CASE WHEN {empty} THEN '' ELSE ',' END, {end})")


def decode(
    raw: DataFrame,
    columns: Sequence[str],
    *,
    trailing_text: str = "reject",
    non_finite: bool = False,
    check_utf8: bool = False,
) -> DataFrame:
    """Parse `value` as a JSON object.

    Adds `_is_object` and `_message`, a struct with one VARIANT per wanted column: SQL NULL if the
    column is absent, a VARIANT null if it is JSON null. Only the wanted columns are built; of a
    key given twice the last one counts. `_message` is meant only where `_is_object` is true.
    """
    taken = [c for c in raw.columns if c in (MESSAGE, IS_OBJECT)]
    if taken:
        raise ValueError(f"rename these columns, decoding adds columns of that name: {taken}")
    if trailing_text not in ("reject", "ignore"):
        raise ValueError(f"trailing_text must be reject or ignore, not {trailing_text!r}")
    whole = trailing_text == "reject"
    raw = as_text(raw)
    schema = T.StructType([T.StructField(c, T.VariantType()) for c in columns])
    schema.add(_END_KEY, T.StringType()).add(_CORRUPT_KEY, T.StringType())
    parsed = F.from_json(
        _with_end_member() if whole else F.col("value"), schema, _options(non_finite)
    )

    # Fields come out of the generator as columns of their own, so that each is unpacked once.
    fields = [f"_field{n}" for n in range(len(columns))]
    texts = _with_members(raw) if whole else raw
    rows = texts.select("*", F.inline(F.array(parsed)).alias(*fields, "_end", "_corrupt"))
    is_object = "_corrupt IS NULL AND "
    if whole:
        is_object += f"coalesce(_end = '{_END}', false)"
    else:
        # Blank text and the text `null` parse to nothing at all.
        is_object += f"coalesce(startswith(trim(LEADING {_SPACE} FROM value), '{{'), false)"
    if check_utf8:
        is_object += " AND is_valid_utf8(value)"
    message = F.struct(*(F.col(f).alias(c) for f, c in zip(fields, columns, strict=True)))
    return rows.select(
        *raw.columns,
        F.expr(is_object).alias(IS_OBJECT),
        message.alias(MESSAGE),
    )


def is_json(*, non_finite: bool = False) -> Column:
    """Whether `value` is one whole JSON value of any kind, a plain number or `null` included."""
    listed = F.from_json(
        F.concat(F.lit("["), "value", F.lit(f',"{_END}"]')), "array<string>", _options(non_finite)
    )
    whole = (F.size(listed) == 2) & (F.get(listed, F.lit(1)) == _END)
    return F.coalesce(whole, F.lit(False))


def whole_message(*, non_finite: bool = False) -> Column:
    """The whole message as a VARIANT, under the rules of `decode`; its text if that fails."""
    whole = F.try_parse_json("value")
    if non_finite:
        listed = F.from_json(
            F.concat(F.lit("["), "value", F.lit("]")), "array<variant>", _options(non_finite)
        )
        whole = F.coalesce(whole, F.get(listed, F.lit(0)))
    return F.coalesce(whole, F.col("value").cast("variant"))


def decode_problem(is_object: Column, *, non_finite: bool = False) -> Column:
    """Why a row holds no message: "malformed JSON", "not a JSON object", or NULL if it does."""
    not_object = ~F.ltrim("value").startswith("{") & is_json(non_finite=non_finite)
    return F.when(
        ~is_object, F.when(not_object, "not a JSON object").otherwise("malformed JSON")
    )
