"""One query per training-data operator over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from logscore.llm import (
    decontaminate,
    language,
    negatives,
    pieces,
    quality,
    repeats,
    token_store,
    toxicity,
    tries,
    warc,
    wrappers,
)
from logscore.llm.licenses import scan_licenses
from logscore.llm.near_dedup import near_duplicates
from logscore.llm.stored import stored

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.write_pages(_table(spark, folder, "pages"))
    captures = warc.assemble(warc.read_records(spark, archive))
    fields = F.try_element_at("metadata", F.lit(1))["payload"]
    return captures.select(
        warc.field(fields, "page-id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        warc.field(fields, "refers-to-page-id").cast("bigint").alias("refers_to"),
        F.size("requests").cast("bigint").alias("n_requests"),
    )


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = language.fit(language.learning_rows(docs.where(~language.held_out())))
    found = language.identify(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdicts(_table(spark, folder, "documents"))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = wrappers.outlined(_table(spark, folder, "pages"))
    return wrappers.extract_main_text(pages, stored(wrappers.induce_wrappers(pages), "wrappers"))


def op5_token_store(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    store = token_store.write_store(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_store(store, docs.select("doc_id"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return decontaminate.digest(decontaminate.scan(docs, benchmark))


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    known = [table.where(~language.held_out()) for table in (docs, labels)]
    model = toxicity.fit(toxicity.learning_rows(*known))
    found = toxicity.score(docs, model)
    return found.select("doc_id", language.held_out().alias("held_out"), "score", "predicted")


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(_table(spark, folder, "documents"))


def op11_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.cut_repeats(_table(spark, folder, "documents"))
    n_removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return cut.select(
        "doc_id",
        "n_bytes",
        n_removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    return tries.trie(_table(spark, folder, "conversations"))


def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    rows = negatives.integer_vectors(_table(spark, folder, "embeddings"), label)
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Query]:
    found = (
        op1_warc,
        op2_language,
        op3_quality,
        op4_main_text,
        op5_token_store,
        op6_near_duplicates,
        op7_decontaminate,
        op8_pieces,
        op9_toxicity,
        op10_licenses,
        op11_repeats,
        op12_trie,
        op13_negatives,
    )
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}
