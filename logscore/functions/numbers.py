"""Numbers as text."""

from __future__ import annotations

from functools import reduce

from logscore.functions.sql import text

# Rewrites from Spark's text of a DOUBLE to the `%g` form with the fewest digits,
# which goes over to exponents below 1e-4 and from 1e6 up.
_REWRITES = (
    # 1234567.5 -> 1.2345675e+06
    (r"^(-?\d)(\d{6})\.(\d+)\z", "$1.$2$3e+06"),
    # 1.25E-4 -> 0.000125
    (r"^(-?)(\d)\.(\d+)E-4\z", "$10.000$2$3"),
    # 1.5E10 -> 1.5e+10, 1.5E-5 -> 1.5e-5
    (r"E-", "e-"),
    (r"E", "e+"),
    # 1.5e+7 -> 1.5e+07
    (r"(e[+-])(\d)\z", "$10$2"),
    # Zeros at the end of the fraction, and a point with nothing behind it.
    (r"(\.\d*?)0+(e.*)?\z", "$1$2"),
    (r"\.(e.*)?\z", "$1"),
    (r"^Infinity\z", "+Inf"),
    (r"^-Infinity\z", "-Inf"),
)


def shortest_float_text(number: str) -> str:
    """A DOUBLE with the fewest digits: 12.0 gives `12`, 1234567.0 `1.234567e+06`, 1e-5 `1e-05`.

    Runs inside `transform`, which is evaluated only where it is asked for and keeps these rarely
    used steps out of the generated code of the rows around it.
    """
    rewritten = reduce(
        lambda value, step: f"regexp_replace({value}, {text(step[0])}, {text(step[1])})",
        _REWRITES,
        "CAST(number AS STRING)",
    )
    return f"get(transform(array({number}), number -> {rewritten}), 0)"


def finite(number: str) -> str:
    return f"coalesce(NOT isnan({number}) AND abs({number}) < double('infinity'), false)"
