"""A table of events with a ledger of what each micro-batch has committed.

A micro-batch may be written in several parts, and again after a failure, in other parts. Each part has
a folder of its own; when the batch is done, one small file that names its parts is moved into the
ledger, in one step. Readers follow the ledger, so they see a batch whole or not at all, and of a
batch that was written twice only the last time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscore.streaming.batch import Batch

_ENTRY = "batch_id bigint, seq bigint, folder string"
_LEDGER, _DATA = "_ledger", "data"


class LedgerWriter:
    """A writer to such a table; `begin` and `commit` frame a batch. `read_committed` reads it."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self._written: dict[int, list[str]] = {}
        self._spark: SparkSession | None = None

    def begin(self, batch: Batch) -> None:
        self._written[batch.id] = []

    def __call__(self, events: DataFrame, batch: Batch) -> None:
        if batch.id is None:
            raise ValueError("a ledger is for micro-batches, which have an id")
        folder = f"{_DATA}/batch_id={batch.id}/{uuid.uuid4().hex}"
        events.write.parquet(f"{self.path}/{folder}")
        self._spark = events.sparkSession
        self._written.setdefault(batch.id, []).append(folder)

    def commit(self, batch: Batch) -> None:
        """Put the parts written since `begin` into the ledger, in place of what it has of the batch."""
        folders = self._written.pop(batch.id, [])
        spark = self._spark or SparkSession.active()
        entries = _entries(spark, self.path, batch.id)
        if not folders and not entries:
            return
        seq = max(entries, default=0) + 1
        lines = [
            json.dumps({"batch_id": batch.id, "seq": seq, "folder": folder})
            for folder in folders or [None]
        ]
        _put(spark, f"{self.path}/{_LEDGER}/{batch.id}-{seq}.json", "\n".join(lines) + "\n")


@contextmanager
def committing(batch: Batch, *writers: object) -> Iterator[None]:
    """Frames the work on a batch: writers that have a ledger commit when it is done."""
    framed = [w for w in writers if isinstance(w, LedgerWriter)]
    for writer in framed:
        writer.begin(batch)
    yield
    for writer in framed:
        writer.commit(batch)


def read_committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The events of all committed batches, each once; a path without a ledger gives no rows.

    The folders' names go through the driver, one for each part of a batch.
    """
    folders = [row.folder for row in _latest(spark, path).collect() if row.folder is not None]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{path.rstrip('/')}/{x}" for x in folders))


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete parts that the ledger does not name, of batches before the last committed one; returns
    how many. Readers that began before may still want them."""
    latest = _latest(spark, path).collect()
    named = {row.folder for row in latest}
    last = max((row.batch_id for row in latest), default=0)
    deleted = 0
    for part in _glob(spark, f"{path.rstrip('/')}/{_DATA}/batch_id=*/*"):
        name = f"{_DATA}/{part.getParent().getName()}/{part.getName()}"
        if name not in named and int(part.getParent().getName().split("=")[1]) < last:
            deleted += part.getFileSystem(_conf(spark)).delete(part, True)
    return deleted


def _latest(spark: SparkSession, path: str) -> DataFrame:
    if not _glob(spark, f"{path.rstrip('/')}/{_LEDGER}/*.json"):
        return spark.createDataFrame([], _ENTRY)
    entries = spark.read.schema(_ENTRY).json(f"{path.rstrip('/')}/{_LEDGER}/*.json")
    last = F.max("seq").over(Window.partitionBy("batch_id"))
    return entries.withColumn("last", last).where("seq = last").select("batch_id", "folder")


def _conf(spark: SparkSession):
    return spark.sparkContext._jsc.hadoopConfiguration()


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _glob(spark: SparkSession, pattern: str) -> list:
    place = _path(spark, pattern)
    found = place.getFileSystem(_conf(spark)).globStatus(place)
    return [status.getPath() for status in found or []]


def _entries(spark: SparkSession, path: str, batch_id: int) -> list[int]:
    """The numbers of the entries that the ledger has for a batch."""
    files = _glob(spark, f"{path}/{_LEDGER}/{batch_id}-*.json")
    return [int(f.getName().removesuffix(".json").split("-")[1]) for f in files]


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A new file that is there whole or not at all."""
    target = _path(spark, path)
    hidden = _path(spark, f"{target.getParent()}/.{uuid.uuid4().hex}")
    files = target.getFileSystem(_conf(spark))
    out = files.create(hidden, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(hidden, target):
        raise OSError(f"cannot move {hidden} to {target}")
