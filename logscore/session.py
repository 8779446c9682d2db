"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # JSON objects may repeat a key; the last one counts, nested objects included.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Join strategy, skewed users and partition counts are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


#: For streams whose micro-batches are small: what they cost besides their rows counts most.
MICRO_BATCH_SETTINGS = {
    # A batch of a few megabytes is split over all cores, not read by one task a file.
    "spark.sql.files.openCostInBytes": "262144",
    # No stages that wait for one another's sizes; spread very active users with `salt` instead.
    "spark.sql.adaptive.enabled": "false",
}


def configure(spark: SparkSession, *, micro_batches: bool = False) -> SparkSession:
    """Apply the runtime settings the library is written for; returns the session.

    `micro_batches` is for a session that runs streams with small batches and nothing else.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in MICRO_BATCH_SETTINGS.items() if micro_batches else ():
        spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name for this run below `spark.checkpoint.dir`.

    On a cluster the setting must name storage that every executor sees. Only a local session may
    leave it unset; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="logscore-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
