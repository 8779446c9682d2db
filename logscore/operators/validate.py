"""Messages against a schema: typed rows out, and for every other row the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscore.functions.coercion import POLICIES, coerce
from logscore.functions.sql import name, text
from logscore.operators.decode import (
    IS_OBJECT,
    MESSAGE,
    as_text,
    decode,
    decode_problem,
    once,
    whole_message,
)
from logscore.schema import TAG_TYPES, Schema


def _decode(raw: DataFrame, schema: Schema, policy: str) -> DataFrame:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    if "reject_reason" in (*schema.fields, *raw.columns):
        raise ValueError("rename the field or column reject_reason, which validation adds")
    return decode(
        raw,
        schema.columns,
        trailing_text="ignore" if policy == "strict" else "reject",
        non_finite=policy == "pydantic",
        check_utf8=policy == "pydantic",
    )


def _rules(
    schema: Schema, policy: str, uuid_check: bool | None
) -> tuple[list[tuple[str, str]], dict[str, str]]:
    """Ordered (condition to hold, reason if it does not), and the typed value of each field."""
    if uuid_check is None:
        uuid_check = policy == "pydantic"
    rules = []
    for column in schema.required:
        variant = f"{MESSAGE}.{name(column)}"
        present = f"{variant} IS NOT NULL"
        if policy != "strict" or column in schema.fields:
            present += f" AND NOT is_variant_null({variant})"
        rules.append((present, f"missing required field: {column}"))
    values = {}
    for column in schema.fields:
        tag = schema.tag(column, policy)
        uuid = uuid_check and column == "event_id"
        # The field named event_id is an id whatever its tag says.
        tag = "str" if uuid else tag
        ok, value = coerce(
            f"{MESSAGE}.{name(column)}", tag, policy, required=column in schema.required, uuid=uuid
        )
        expected = "a version-4 UUID" if uuid else tag
        rules.append((ok, f"field {column}: not acceptable as {expected}"))
        values[column] = f"CAST({value} AS {TAG_TYPES[tag]})"
    return rules, values


def _first_failing(policy: str, rules: list[tuple[str, str]]) -> Column:
    cases = " ".join(f"WHEN NOT ({ok}) THEN {text(reason)}" for ok, reason in rules)
    return F.coalesce(
        decode_problem(F.col(IS_OBJECT), non_finite=policy == "pydantic"),
        F.expr(f"CASE {cases} END") if cases else F.lit(None),
    )


def _all_hold(rules: list[tuple[str, str]]) -> str:
    return " AND ".join([IS_OBJECT, *(f"({ok})" for ok, _ in rules)])


def _not_found(raw: DataFrame, schema: Schema) -> DataFrame:
    return as_text(raw).withColumn("reject_reason", F.lit(f"schema not found: {schema.name}"))


def check(
    raw: DataFrame, schema: Schema, policy: str = "pydantic", *, uuid_check: bool | None = None
) -> DataFrame:
    """Every row with its typed fields and `reject_reason`, NULL for a valid row.

    The typed fields of a rejected row are NULL. Columns of `raw` stay, `value` included.
    """
    if not schema.found:
        return _not_found(raw, schema)
    rules, values = _rules(schema, policy, uuid_check)
    judged = _decode(raw, schema, policy).withColumn(
        "reject_reason", _first_failing(policy, rules)
    )
    typed = [
        F.expr(f"CASE WHEN reject_reason IS NULL THEN {value} END").alias(column)
        for column, value in values.items()
    ]
    kept = [F.col(c) for c in raw.columns if c not in schema.fields]
    return judged.select(*kept, *typed, "reject_reason")


def valid_rows(
    raw: DataFrame,
    schema: Schema,
    policy: str = "pydantic",
    *,
    uuid_check: bool | None = None,
    keep_raw: bool = False,
    counters: str | None = None,
) -> DataFrame:
    """The valid messages as typed rows, with the columns of `raw` other than `value`.

    Fields the schema does not name are dropped; `keep_raw` keeps the whole message as the VARIANT
    column `raw` (as a VARIANT text where no VARIANT object can hold it). `counters` names observed metrics: messages `fetched`, and `dropped` as invalid.
    """
    kept = [F.col(c) for c in raw.columns if c != "value" and c not in schema.fields]
    if not schema.found:
        return _not_found(raw, schema).where(F.lit(False)).select(*kept)
    rules, values = _rules(schema, policy, uuid_check)
    decoded = _decode(raw, schema, policy)
    valid = _all_hold(rules)
    if keep_raw:
        decoded = once(decoded, whole_message(non_finite=policy == "pydantic"), "_whole")
        kept.append(F.col("_whole").alias("raw"))
    if counters:
        decoded = decoded.withColumn("_valid", F.expr(valid)).observe(
            counters,
            F.count(F.lit(1)).alias("fetched"),
            F.count_if(~F.col("_valid")).alias("dropped"),
        )
        valid = "_valid"
    typed = [F.expr(value).alias(column) for column, value in values.items()]
    return decoded.where(valid).select(*kept, *typed)


def rejected_rows(
    raw: DataFrame, schema: Schema, policy: str = "pydantic", *, uuid_check: bool | None = None
) -> DataFrame:
    """The rows that are not valid, as they came, with `reject_reason`."""
    if not schema.found:
        return _not_found(raw, schema)
    rules, _ = _rules(schema, policy, uuid_check)
    rejected = _decode(raw, schema, policy).where(f"NOT ({_all_hold(rules)})")
    return rejected.select(*raw.columns, _first_failing(policy, rules).alias("reject_reason"))


def batch_counts(flagged: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Per `batch_id`: messages fetched, dropped as invalid, valid, and events produced.

    `flagged` is the output of `check`; `events` are those that were made of it, with `batch_id`
    carried along.
    """
    dropped = F.col("reject_reason").isNotNull()
    counts = flagged.groupBy("batch_id").agg(
        F.count("*").alias("fetched"),
        F.count_if(dropped).alias("dropped"),
        F.count_if(~dropped).alias("valid"),
    )
    if events is None:
        return counts
    produced = events.groupBy("batch_id").agg(F.count("*").alias("produced"))
    return counts.join(produced, "batch_id", "left").fillna(0, ["produced"])
