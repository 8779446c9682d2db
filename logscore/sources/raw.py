"""Reading raw messages, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def broker_options(
    servers: str,
    topic: str,
    *,
    start: str = "earliest",
    per_batch: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source for one topic.

    `per_batch` bounds a micro-batch (streams only). `min_partitions` splits busy topic partitions
    over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(per_batch)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_messages(
    spark: SparkSession, source: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    """Messages as a bounded table with the JSON text in `value`."""
    return spark.read.format(source).options(**options).load(path)


def stream_messages(
    spark: SparkSession, source: str, options: Mapping[str, str], path: str | None = None
) -> DataFrame:
    """Messages as a stream with the JSON text in `value`: `kafka` with `broker_options`, or
    `text` files with `maxFilesPerTrigger`."""
    return spark.readStream.format(source).options(**options).load(path)
