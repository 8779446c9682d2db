"""Bounded groups of rows, many to a task, without a call for each."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_group(
    df: DataFrame, keys: list[str], work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Apply `work` to the rows of each key; a group must be small enough for one task.

    Rows are shuffled and sorted by the keys and read as a stream, so a task holds one Arrow batch
    and the group that goes on into the next one. They are dealt by a hash of the keys, a column of
    its own: a shuffle by the keys themselves is left out where a join below is dealt by them, and
    adaptive execution may then turn that join into one that is not.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            cuts = _cuts(table, keys)
            for begin, end in zip(cuts[:-2], cuts[1:-1], strict=True):
                yield from work(table.slice(begin, end - begin))
            held = table.slice(cuts[-2]).combine_chunks()
        if held is not None and held.num_rows:
            yield from work(held)

    dealt = df.withColumn("_dealt_by", F.xxhash64(*keys)).repartition("_dealt_by")
    return dealt.sortWithinPartitions(*keys).drop("_dealt_by").mapInArrow(apply, schema)


def _cuts(table: pa.Table, keys: list[str]) -> list[int]:
    """Where groups begin, and the end."""
    changed = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
    for key in keys:
        codes = table.column(key).combine_chunks().dictionary_encode()
        codes = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        changed |= codes[1:] != codes[:-1]
    return [0, *(np.flatnonzero(changed) + 1).tolist(), table.num_rows]
