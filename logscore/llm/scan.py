"""Running counts and checksums along ordered keys, however many rows one key has."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logscore.llm.stored import stored


def _local(key: str, xors: Sequence[str], number: str, names: list[str]):
    """Numbers and running xors of one sorted partition."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        last, carry = None, {name: 0 for name in (number, *xors)}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            starts = np.append(True, keys[1:] != keys[:-1])
            goes_on = last is not None and keys[0] == last
            at = np.maximum.accumulate(np.where(starts, np.arange(len(keys)), 0))
            first = at == 0  # rows of the batch's first key
            made = {number: np.arange(len(keys)) - at + 1}
            for name in xors:
                total = np.append(
                    0, np.bitwise_xor.accumulate(batch.column(name).to_numpy(zero_copy_only=False))
                )
                made[name] = total[1:] ^ total[at]
            if goes_on:
                made[number] += np.where(first, carry[number], 0)
                for name in xors:
                    made[name] ^= np.where(first, carry[name], 0)
            last, carry = keys[-1], {name: int(values[-1]) for name, values in made.items()}
            made["_task"] = np.full(len(keys), task)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[c]) if c in made else batch.column(c) for c in names], names=names
            )

    return apply


def running(
    df: DataFrame, key: str, order: Sequence[str], *, number: str, xors: Sequence[str] = ()
) -> DataFrame:
    """`df` with `number`, the place of each row among those of its `key` in the given order, from
    1, and with the columns `xors` (bigint) replaced by the xor of all rows up to this one.

    `key` is a bigint without nulls; nulls in `order` come first. Rows are sorted by ranges of key and
    order, so that a key with very many rows lies in several tasks, even where rows repeat. Each task
    counts its own rows; what the tasks before hold of its first key, one row at most for each task,
    is then added. The rows are written and read again.
    """
    names = [*df.columns, number, "_task"]
    schema = df.withColumns({c: F.lit(0).cast("bigint") for c in (number, "_task")}).schema
    by = [key, *order, "_row"]
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by)
    local = dealt.sortWithinPartitions(*by).drop("_row").mapInArrow(
        _local(key, xors, number, names), schema
    )
    local = stored(local, "running")
    ends = local.groupBy(key, "_task").agg(
        F.max(number).alias("_n"), *(F.max_by(c, number).alias(f"_{c}") for c in xors)
    )
    before = Window.partitionBy(key).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum("_n").over(before).alias("_n")]
    sums += [F.bit_xor(f"_{c}").over(before).alias(f"_{c}") for c in xors]
    ends = ends.select(key, "_task", *sums).where("_n IS NOT NULL")  # one row at most for each task
    joined = local.join(F.broadcast(ends), [key, "_task"], "left")
    made = {number: F.col(number) + F.coalesce("_n", F.lit(0))}
    made |= {c: F.col(c).bitwiseXOR(F.coalesce(F.col(f"_{c}"), F.lit(0))) for c in xors}
    return joined.withColumns(made).select(*df.columns, number)
