from __future__ import annotations

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tests.llm.helpers import documents
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_near_dedup import brute as brute_groups
from tests.llm.test_quality import brute_counts

FOLDER = "/root/testdata/sf0.001"


def test_whole_run_against_brute_force(spark):
    """Base rules, language labels, all pairs and all windows, and the library's ids."""
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, FOLDER).collect()}
    kept = [r for r in table if not brute_counts(r.text)[-1]]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, FOLDER).collect()}
    assert good <= {r.doc_id for r in kept}
    known = {r.doc_id for r in labels.where("quality = 1").collect()} & {r.doc_id for r in kept}
    assert len(known - good) <= 0.02 * len(known)
    kept = [r for r in kept if r.doc_id in good]
    groups = brute_groups([(r.doc_id, r.text) for r in kept])
    kept = [r for r in kept if groups[r.doc_id][1] == r.doc_id]
    hits = {x[0]: x[-1] for x in brute_hits([r.text for r in kept], items)}
    kept = [r for i, r in enumerate(kept) if not hits[i]]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert found == {r.doc_id: library.encode(r.text) for r in kept}


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = documents(spark, ["word " * 60, None, "", "a b"], "1 AS score").where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, FOLDER)
        assert result.columns == docs.columns
        assert result.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect() == []


def test_stages_take_nulls_in_all_columns(spark):
    docs = documents(spark, [(None, None, None, None), (None, "word " * 60, None, None)])
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).collect()
