"""Names and text inside SQL expressions."""

from __future__ import annotations


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(map(text, values)) + ")"
