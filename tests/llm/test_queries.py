"""The registered queries on the smallest data: against their SQL, or for their columns."""

from __future__ import annotations

import subprocess
import sys

import pytest

from logscore.llm.oracle import oracle_sql
from logscore.llm.queries import queries
from tests import oracle_check

FOLDER = "/root/testdata/sf0.001"
WITHOUT_SQL = {
    "op2_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_main_text": ["page_id", "url", "text", "n_chars"],
    "op5_token_store": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op8_pieces": ["doc_id", "n_pieces", "ids_crc32", "same"],
    "op9_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op10_licenses": [
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
    ],
}


@pytest.mark.parametrize("name", oracle_sql())
def test_against_sql(spark, name):
    assert oracle_check.difference(spark, oracle_check.connect(FOLDER), FOLDER, name) is None


@pytest.mark.parametrize("name", WITHOUT_SQL)
def test_one_row_for_each_input_row(spark, name):
    result = queries()[name](spark, FOLDER)
    assert result.columns == WITHOUT_SQL[name]
    table = "pages" if name == "op4_main_text" else "documents"
    assert result.count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_every_operator_is_registered():
    names = {*oracle_sql(), *WITHOUT_SQL, "pipeline"}
    assert names == queries().keys()
    assert {name.split("_")[0] for name in names} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


def test_nothing_else_imports_the_package():
    code = "import sys, logscore, logscore.plans.queries; print(any('llm' in m for m in sys.modules))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "False"
