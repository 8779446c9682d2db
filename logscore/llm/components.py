"""Connected components of a graph given as pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscore.llm.stored import stored

#: Pairs that one task contracts; it holds no more than their nodes.
PAIRS_PER_TASK = 200_000


class Joined:
    """Sets of things that were joined; the root of each is its smallest."""

    def __init__(self):
        self.above: dict = {}

    def root(self, x):
        path = []
        while (y := self.above.get(x, x)) != x:
            path.append(x)
            x = y
        for y in path:
            self.above[y] = x
        return x

    def join(self, x, y) -> bool:
        """Whether they were apart."""
        x, y = self.root(x), self.root(y)
        self.above[max(x, y)] = min(x, y)
        return x != y


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a task's pairs with the smallest one it is joined with there."""
    joined, kinds = Joined(), None
    for batch in batches:
        kinds = batch.schema
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            joined.join(u, v)
    if kinds is not None:
        pairs = [(x, root) for x in list(joined.above) if (root := joined.root(x)) != x]
        for begin in range(0, len(pairs), 10_000):
            part = pairs[begin : begin + 10_000]
            columns = [pa.array([p[i] for p in part], kinds.field(i).type) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)


def _smallest(pairs: DataFrame) -> DataFrame:
    """The smallest neighbour of each `u`, itself included."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return least.select("u", F.least("u", "least").alias("least"))


def _stars(pairs: DataFrame) -> DataFrame:
    """A large-star and a small-star step; every pair has u > v."""
    both = pairs.union(pairs.select("v", "u"))
    large = both.join(_smallest(both), "u").where("v > u and v <> least")
    large = large.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    joined = large.join(_smallest(large), "u")
    small = joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
    return small.union(joined.select("u", "least")).where("u <> v").distinct()


def _state(pairs: DataFrame) -> tuple:
    """Equal for equal sets of pairs; first their number."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(pairs.agg(F.count("*"), digest).first())


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Columns `node` and `root`, the smallest node of its component.

    Nodes without a pair are left out; pairs may repeat, hold nulls (ignored) or a node twice. Tasks
    contract the pairs they hold, a bounded number each; what is left, if it is more than one task's
    share, goes through large and small stars in turn (Kiveris et al. 2014), which need a logarithmic
    number of rounds and only aggregate and join pairs. A node with very many pairs is aggregated
    map-side and its join partition is split by adaptive execution.
    """
    pairs = pairs.where(f"{a} <> {b}").select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    count, state = pairs.count(), ()
    while True:
        parts = max(1, -(-count // PAIRS_PER_TASK))
        contracted = pairs.repartition(parts).mapInArrow(_contract, pairs.schema)
        pairs = stored(contracted, "components")
        if parts == 1:
            break
        pairs = stored(_stars(pairs), "components")
        before, state = state, _state(pairs)
        if state == before:
            break
        count = state[0]
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
