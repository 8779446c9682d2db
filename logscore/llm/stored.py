"""Results that are written once and read again, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logscore.session import scratch_folder


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write `df` below `spark.checkpoint.dir` and read it back.

    The lineage ends there, and no executor that is lost takes part of it along.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
