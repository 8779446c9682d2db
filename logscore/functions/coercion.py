"""Three coercion policies as SQL expressions: is a field acceptable, and what is its value.

`pydantic`  whole numbers, flags and numeric text may stand for one another; null is no value
`lenient`   almost anything may be text, fractions are cut to whole numbers
`strict`    the JSON type must be the declared type
"""

from __future__ import annotations

from logscore.functions.identity import UUID4_PATTERN
from logscore.functions.numbers import finite, shortest_float_text
from logscore.functions.sql import text, texts

POLICIES = ("pydantic", "lenient", "strict")

# Texts read as flags.
PYDANTIC_TRUE = ("1", "on", "t", "true", "y", "yes")
PYDANTIC_FALSE = ("0", "off", "f", "false", "n", "no")
LENIENT_TRUE = ("1", "t", "T", "TRUE", "true", "True")
LENIENT_FALSE = ("0", "f", "F", "FALSE", "false", "False")
# What a JSON null becomes in a text field of the lenient policy.
LENIENT_NULL_TEXT = "<nil>"
# Texts read as numbers (\z, as `$` would also match before a final line break).
PYDANTIC_INT_TEXT = r"^\s*[+-]?\d+(?:_\d+)*(?:\.0+)?\s*\z"
PYDANTIC_FLOAT_TEXT = (
    r"^\s*[+-]?(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+)?\s*\z"
)
PYDANTIC_NON_FINITE_TEXT = r"^(?i)\s*[+-]?(?:inf(?:inity)?|nan)\s*\z"
LENIENT_INT_TEXT = r"^[+-]?\d+\z"
LENIENT_FLOAT_TEXT = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\z"
LENIENT_NON_FINITE_TEXT = r"^(?i)(?:[+-]?inf(?:inity)?|nan)\z"


class Value:
    """One message field as VARIANT, with the questions the rules below ask about it.

    SQL NULL means the field is absent; a JSON null is present with type VOID. Every test is
    false, never NULL, for an absent field.
    """

    def __init__(self, variant: str):
        self.variant = variant
        kind = f"schema_of_variant({variant})"
        self.absent = f"{variant} IS NULL"
        self.null = f"is_variant_null({variant})"
        self.string = f"{kind} <=> 'STRING'"
        self.boolean = f"{kind} <=> 'BOOLEAN'"
        self.integer = f"{kind} <=> 'BIGINT'"
        # Written with a point or exponent, or too large for 64 bits.
        self.fraction = f"coalesce({kind} RLIKE '^(DOUBLE|DECIMAL)', false)"
        self.number = f"({self.integer} OR {self.fraction})"
        self.text = self.get("string")

    def get(self, spark_type: str) -> str:
        """The value as a Spark type, NULL where Spark cannot convert it."""
        return f"try_variant_get({self.variant}, '$', '{spark_type}')"

    def reads(self, *patterns: str) -> str:
        """It is text that matches one of the patterns."""
        matches = " OR ".join(f"{self.text} RLIKE {text(p)}" for p in patterns)
        return f"({self.string} AND ({matches}))"


def _case(test: str, then: str, otherwise: str) -> str:
    return f"CASE WHEN {test} THEN {then} ELSE {otherwise} END"


def _text(v: Value, policy: str, uuid: bool) -> tuple[str, str]:
    if policy == "lenient":
        # Objects and lists keep their JSON text.
        value = _case(v.number, shortest_float_text(v.get("double")), v.text)
        return (v.reads(UUID4_PATTERN) if uuid else "true"), value
    return (v.reads(UUID4_PATTERN) if uuid else v.string), v.text


def _int(v: Value, policy: str) -> tuple[str, str]:
    whole = (
        f"({v.fraction} AND {finite(v.get('double'))}"
        f" AND {v.get('double')} = floor({v.get('double')}) AND {v.get('bigint')} IS NOT NULL)"
    )
    if policy == "strict":
        return f"({v.integer} OR {whole})", v.get("bigint")
    if policy == "pydantic":
        digits = f"regexp_replace({v.text}, {text(r'[\s_]|\.0+\s*\z')}, '')"
        from_text = f"try_cast({digits} AS BIGINT)"
        ok = (
            f"({v.integer} OR {v.boolean} OR {whole}"
            f" OR ({v.reads(PYDANTIC_INT_TEXT)} AND {from_text} IS NOT NULL))"
        )
        return ok, _case(v.string, from_text, v.get("bigint"))
    # Numbers of the lenient policy pass through a double.
    from_text = f"try_cast({v.text} AS BIGINT)"
    from_number = f"try_cast({v.get('double')} AS BIGINT)"
    ok = (
        f"(({v.number} AND {from_number} IS NOT NULL)"
        f" OR ({v.reads(LENIENT_INT_TEXT)} AND {from_text} IS NOT NULL))"
    )
    return ok, _case(v.string, from_text, from_number)


def _float(v: Value, policy: str) -> tuple[str, str]:
    if policy == "strict":
        return v.number, v.get("double")
    if policy == "pydantic":
        digits = f"regexp_replace({v.text}, {text(r'[\s_]')}, '')"
        reads = v.reads(PYDANTIC_FLOAT_TEXT, PYDANTIC_NON_FINITE_TEXT)
        ok = f"({v.number} OR {v.boolean} OR {reads})"
        return ok, _case(v.string, f"try_cast({digits} AS DOUBLE)", v.get("double"))
    from_text = f"try_cast({v.text} AS DOUBLE)"
    ok = (
        f"({v.number} OR ({v.reads(LENIENT_FLOAT_TEXT)} AND {finite(from_text)})"
        f" OR {v.reads(LENIENT_NON_FINITE_TEXT)})"
    )
    return ok, _case(v.string, from_text, v.get("double"))


def _bool(v: Value, policy: str) -> tuple[str, str]:
    if policy == "strict":
        return v.boolean, v.get("boolean")
    if policy == "pydantic":
        word, number = f"lower({v.text})", v.get("double")
        ok = (
            f"({v.boolean} OR ({v.number} AND coalesce({number} IN (0D, 1D), false))"
            f" OR ({v.string} AND {word} IN {texts(PYDANTIC_TRUE + PYDANTIC_FALSE)}))"
        )
        other = _case(v.number, f"{number} = 1D", v.get("boolean"))
        return ok, _case(v.string, f"{word} IN {texts(PYDANTIC_TRUE)}", other)
    ok = f"({v.boolean} OR ({v.string} AND {v.text} IN {texts(LENIENT_TRUE + LENIENT_FALSE)}))"
    return ok, _case(v.string, f"{v.text} IN {texts(LENIENT_TRUE)}", v.get("boolean"))


def coerce(
    variant: str, tag: str, policy: str, *, required: bool, uuid: bool = False
) -> tuple[str, str]:
    """(acceptable, value) of one field; the value is meant only where the field is acceptable.

    An absent optional field is acceptable with value NULL. `uuid` asks for a version-4 UUID.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    v = Value(variant)
    if tag == "str":
        ok, value = _text(v, policy, uuid)
        if policy == "lenient":
            # JSON null is a text of its own here.
            value = _case(v.null, text(LENIENT_NULL_TEXT), value)
    else:
        ok, value = {"int": _int, "float": _float, "bool": _bool}[tag](v, policy)
    if not required:
        absent = f"{v.absent} OR {v.null}" if policy == "pydantic" else v.absent
        ok = f"({absent} OR {ok})"
    return ok, value
