"""From raw documents to token ids: quality, language, near-duplicates, benchmark, encoding.

Each stage takes (spark, docs, folder of tables), works on all rows the one before kept and returns a
DataFrame, which is written and read again for the next. All but the last return the columns of
documents; the last returns each document's piece ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logscore.llm import decontaminate, language, pieces, quality
from logscore.llm.near_dedup import kept_rows
from logscore.llm.stored import stored


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that fail the base rule or are outliers of their language and source go."""
    return quality.good_rows(docs)


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is not known go."""
    model = language.fit(language.learning_rows(docs))
    return language.known_language(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return kept_rows(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold enough of a benchmark item go."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark)


def encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """`doc_id` and the piece `ids` of each document."""
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", encoding),
]

#: Language ID and piece encoding are beyond SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
