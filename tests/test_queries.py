"""Every query against its SQL, on the smallest data."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

import __spark_entry__
from logscore.plans.oracle import oracle_sql
from logscore.plans.queries import queries
from tests import oracle_check

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries()


@pytest.fixture(scope="module")
def db():
    return oracle_check.connect(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == oracle_sql().keys()
    assert QUERIES.keys() <= __spark_entry__.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    assert oracle_check.difference(spark, db, FOLDER, name) is None


def test_the_check_sees_differences(spark, db, monkeypatch):
    name = "hash_score"
    sql = __spark_entry__.oracle_sql()[name]
    for changed, expected in (
        (f"SELECT * REPLACE (score + 1e-15 AS score) FROM ({sql})", "first different row"),
        (f"SELECT * FROM ({sql}) WHERE user_id <> '1'", "rows"),
        (f"SELECT * EXCLUDE (score) FROM ({sql})", "columns"),
    ):
        monkeypatch.setattr(oracle_check, "oracle_sql", lambda sql=changed: {name: sql})
        assert expected in oracle_check.difference(spark, db, FOLDER, name)


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert isinstance(result, DataFrame)
    assert result.count() > 0
