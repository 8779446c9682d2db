from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from logscore.llm.groups import by_group


def sizes(group: pa.Table):
    first = {name: [group.column(name)[0].as_py()] for name in ("k", "m")}
    kinds = pa.schema([("k", pa.int64()), ("m", pa.string()), ("n", pa.int64())])
    yield pa.RecordBatch.from_pydict(first | {"n": [group.num_rows]}, kinds)


def test_each_group_once(spark):
    """Also above a join by the same key that adaptive execution turns into a broadcast."""
    rows = spark.range(4000).select(F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"), "id")
    counts = rows.repartition(6).groupBy("k").agg(F.lit("x").alias("m"))
    threshold = "autoBroadcastJoinThreshold"
    settings = {f"spark.sql.{threshold}": "-1", f"spark.sql.adaptive.{threshold}": "10m"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = rows.repartition(6).join(counts, "k")
        found = by_group(joined, ["k"], sizes, "k bigint, m string, n bigint").collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert sorted(r.k for r in found) == [1, 2, 3, 4, 5, 6]
    assert sum(r.n for r in found) == rows.where("k IS NOT NULL").count()


def test_groups_of_several_keys_and_nulls(spark):
    rows = spark.range(600).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 2 > 0, "a").alias("m"))
    found = by_group(rows, ["k", "m"], sizes, "k bigint, m string, n bigint").collect()
    assert sorted((r.k, r.m or "", r.n) for r in found) == [(k, m, 100) for k in range(3) for m in ("", "a")]
