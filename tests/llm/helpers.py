"""Small tables with what real ones hold: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def documents(spark: SparkSession, texts: list, more: str = "") -> DataFrame:
    """Rows with ids from 0; a text may also be a tuple (doc_id, text[, lang[, source]])."""
    rows = []
    for i, text in enumerate(texts):
        given = text if isinstance(text, tuple) else (i, text)
        doc_id, text, lang, source = (*given, "en", "a")[:4] if len(given) < 4 else given
        if len(given) == 3:
            source = "a"
        rows.append((doc_id, text, lang, source, None))
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.selectExpr("*", *([more] if more else []))


def rows_of(df: DataFrame, *names: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
