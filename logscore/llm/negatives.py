"""Hard negatives by angular triangle filtering.

Every vector stores its angles to a few reference directions. Angles obey the triangle inequality: two
vectors lie at least |a - b| and at most a + b apart if a and b are their angles to a reference, which
bounds their cosine from both sides; times the norms, widened by more than rounding can do, that
bounds their score. Vectors are kept in blocks of near angles; first whole blocks, then single rows
are passed over for an anchor if their bounds do not reach into the window of scores still wanted. Only
the rest is scored, in integers.

Anchors are read in chunks of bounded size that Spark broadcasts, and each chunk meets all rows in one
scan. Tasks keep the best rows of each anchor; those of all tasks are then ranked together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logscore.llm.stored import stored

POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least this share, in percent, of the positive's score.
LEAST_PERCENT = 80
#: Components are multiplied by this before their floor is taken.
SCALE = 256
#: Reference directions, chosen from a bounded sample of vectors, far apart from one another.
REFERENCES = 8
SAMPLE = 512
#: Rows of a block of near angles, and bytes of anchor vectors that are broadcast at a time.
BLOCK = 256
#: Anchors that are compared with the rows of a block at a time.
ANCHORS = 2048
CHUNK_BYTES = 16 << 20
#: Vectors with this norm or more take no part: a hundred times a score stays a 64-bit number.
MOST_NORM = float(1 << 28)
#: Scores below this are exact sums of doubles.
_EXACT = float(1 << 53)


def integer_vectors(embeddings: DataFrame, label: Column | str = "label") -> DataFrame:
    """`vec_id`, `label` and `vector`, the floors of the scaled components, of rows that take part."""
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
        "embedding",
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    whole = F.forall(
        "embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) * SCALE < MOST_NORM)
    )  # neither NaN, which is larger than all numbers, nor infinite
    rows = rows.where(whole).select("vec_id", "label", parts.alias("vector"))
    squares = F.aggregate(
        "vector", F.lit(0.0), lambda n, x: n + x.cast("double") * x.cast("double")
    )
    return rows.where(squares < MOST_NORM**2)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    made = np.zeros((len(column), width))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    made[np.repeat(np.arange(len(sizes)), sizes), _places(sizes)] = flat
    return made


def _places(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def references(rows: DataFrame, width: int, count: int = REFERENCES) -> np.ndarray:
    """Unit directions, each the sampled one that is farthest from those before. The sample is the
    `SAMPLE` rows with the smallest hashes of their ids."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    found = _matrix(sample.column("vector"), width)
    norms = np.linalg.norm(found, axis=1)
    found = found[norms > 0] / norms[norms > 0, None]
    chosen: list[int] = []
    nearest = np.full(len(found), -1.0)
    while len(chosen) < min(count, len(found)):
        chosen.append(int(np.argmin(nearest)) if chosen else 0)
        nearest = np.maximum(nearest, found @ found[chosen[-1]])
    return found[chosen]


def _with_angles(width: int, directions: np.ndarray):
    """Adds the norm and the angle to each direction; a vector without a length has the angle 0."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), width)
            norms = np.linalg.norm(vectors, axis=1)
            units = vectors / np.where(norms > 0, norms, 1)[:, None]
            angles = np.arccos(np.clip(units @ directions.T, -1, 1))
            angles[norms == 0] = 0
            flat = pa.array(angles.ravel())
            offsets = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * len(directions))
            nearest = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(angles), np.int64)
            near = angles.min(axis=1, initial=np.pi)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(norms),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.array(nearest),
                    pa.array(near),
                ],
                names=[*batch.schema.names, "norm", "angles", "cell", "near"],
            )

    return apply


def with_angles(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with `norm` and `angles`, written in the order of near angles within each task, and the
    number of components of the longest vector."""
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    directions = references(rows, width)
    schema = (
        "vec_id bigint, label bigint, vector array<bigint>, norm double, angles array<double>, "
        "cell bigint, near double"
    )
    made = rows.mapInArrow(_with_angles(width, directions), schema)
    made = made.sortWithinPartitions("cell", "near").drop("cell", "near")
    return stored(made, "angles"), width


@dataclass
class Vectors:
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    norms: np.ndarray
    angles: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, width: int) -> Vectors:
        angles = batch.column("angles")
        numbers = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "norm")
        )
        ids, labels, norms = numbers
        values = _matrix(batch.column("vector"), width)
        return cls(ids, labels, values, norms, _matrix(angles, len(angles[0])))

    def take(self, chosen) -> Vectors:
        parts = (self.ids, self.labels, self.values, self.norms, self.angles)
        return Vectors(*(part[chosen] for part in parts))


def cosine_bounds(a_low: np.ndarray, a_high: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest cosine between vectors whose angles to the references are within
    [a_low, a_high] and others with angles `b`: a row for each of the others.

    Angles are off by 1e-7 at most, also near 0 and pi, where the arc cosine is worst.
    """
    least = np.zeros((len(b), len(a_low)))
    most = np.full((len(b), len(a_low)), np.pi)
    for r in range(b.shape[1]):
        x = b[:, r, None]
        low, high = a_low[None, :, r], a_high[None, :, r]
        np.maximum(least, np.maximum(low - x, x - high), out=least)
        np.minimum(most, np.minimum(high + x, 2 * np.pi - (low + x)), out=most)
    least = np.clip(least - 2e-7, 0, np.pi)
    most = np.clip(most + 2e-7, 0, np.pi)
    return np.cos(np.maximum(most, least)), np.cos(least)


def _bounds(cosines: tuple, sizes: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of whole-numbered scores from those of cosines and of products of norms."""
    (least, most), (small, large) = cosines, sizes
    slack = 1 + large * 1e-9
    low = np.minimum(least * small, least * large) - slack
    high = np.maximum(most * small, most * large) + slack
    return np.floor(low), np.ceil(high)


def scores(anchors: Vectors, rows: Vectors) -> np.ndarray:
    """Integer inner products, exact."""
    if anchors.norms.max(initial=0) * rows.norms.max(initial=0) < _EXACT:
        return (anchors.values @ rows.values.T).astype(np.int64)
    return anchors.values.astype(np.int64) @ rows.values.astype(np.int64).T


class Best:
    """The first `count` rows of each of many slots, by falling score, then by id."""

    def __init__(self, slots: int, count: int):
        self.count = count
        self.scores = np.full((slots, count), np.iinfo(np.int64).min)
        self.ids = np.full((slots, count), np.iinfo(np.int64).max)

    def worst(self) -> np.ndarray:
        return self.scores[:, -1]

    def better(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        last = self.scores[slots, -1]
        return (scores > last) | ((scores == last) & (ids < self.ids[slots, -1]))

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in candidates; a slot's own rows compete with them."""
        chosen = self.better(slots, scores, ids)
        slots, scores, ids = slots[chosen], scores[chosen], ids[chosen]
        if not len(slots):
            return
        touched = np.unique(slots)
        slots = np.concatenate([np.repeat(touched, self.count), slots])
        scores = np.concatenate([self.scores[touched].ravel(), scores])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((ids, ~scores, slots))  # ~x falls as x grows, and never overflows
        slots, scores, ids = slots[order], scores[order], ids[order]
        starts = np.flatnonzero(np.append(True, slots[1:] != slots[:-1]))
        rank = np.arange(len(slots)) - np.repeat(starts, np.diff(np.append(starts, len(slots))))
        kept = rank < self.count
        self.scores[slots[kept], rank[kept]] = scores[kept]
        self.ids[slots[kept], rank[kept]] = ids[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.scores > np.iinfo(np.int64).min)
        return slot, self.scores[slot, place], self.ids[slot, place]


def _scored(anchors: Vectors, rows: Vectors, low: np.ndarray, high: np.ndarray) -> Iterator[tuple]:
    """Pairs whose bounds meet the window [low, high] of their anchor: anchor, row, score.

    First the block of all rows is tried, then the rows of it one by one.
    """
    edges = rows.angles.min(axis=0, keepdims=True), rows.angles.max(axis=0, keepdims=True)
    cosines = (x[:, 0] for x in cosine_bounds(*edges, anchors.angles))
    sizes = anchors.norms * rows.norms.min(), anchors.norms * rows.norms.max()
    below, above = _bounds(tuple(cosines), sizes)
    near = np.flatnonzero((above >= low) & (below <= high))
    for begin in range(0, len(near), ANCHORS):
        part = near[begin : begin + ANCHORS]
        some = anchors.take(part)
        size = some.norms[:, None] * rows.norms[None, :]
        cosines = cosine_bounds(rows.angles, rows.angles, some.angles)
        below, above = _bounds(cosines, (size, size))
        wanted = (above >= low[part, None]) & (below <= high[part, None])
        columns = np.flatnonzero(wanted.any(axis=0))
        if len(columns):
            found = scores(some, rows.take(columns))
            a, r = np.nonzero(wanted[:, columns])
            yield part[a], columns[r], found[a, r]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Vectors]:
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            yield Vectors.of(batch.slice(begin, BLOCK), width)


def _positives(broadcast, width: int):
    """The best rows of the same label for each anchor, of one task."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Vectors = broadcast.value
        best = Best(len(anchors.ids), POSITIVES)
        for rows in _blocks(batches, width):
            low = best.worst().astype(np.float64)
            for a, r, score in _scored(anchors, rows, low, np.full(len(low), np.inf)):
                same = (anchors.labels[a] == rows.labels[r]) & (anchors.ids[a] != rows.ids[r])
                best.add(a[same], score[same], rows.ids[r[same]])
        slot, score, ids = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(ids), pa.array(score)],
            names=["anchor", "positive_id", "positive_score"],
        )

    return apply


_NEGATIVE = (
    "anchor bigint, anchor_id bigint, positive_id bigint, positive_score bigint, "
    "negative_id bigint, negative_score bigint"
)


def _negatives(broadcast, width: int):
    """The best rows of another label in the window below each positive, of one task.

    A slot is an anchor and one of its positives; slots of an anchor share one filter.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, slots = broadcast.value
        anchor, positive, high = slots
        low = -((-LEAST_PERCENT * high) // 100)
        first = np.searchsorted(anchor, np.arange(len(anchors.ids)))
        many = np.searchsorted(anchor, np.arange(len(anchors.ids)), side="right") - first
        open_ = low <= high
        top = np.full(len(anchors.ids), -np.inf)
        np.maximum.at(top, anchor[open_], high[open_].astype(np.float64))
        best = Best(len(anchor), NEGATIVES)
        for rows in _blocks(batches, width):
            wanted = np.maximum(low, best.worst()).astype(np.float64)
            bottom = np.full(len(anchors.ids), np.inf)
            np.minimum.at(bottom, anchor[open_], wanted[open_])
            for a, r, score in _scored(anchors, rows, bottom, top):
                other = (anchors.labels[a] != rows.labels[r]) & (anchors.ids[a] != rows.ids[r])
                a, r, score = a[other], r[other], score[other]
                for i in range(int(many.max(initial=0))):
                    slot = np.minimum(first[a] + i, len(anchor) - 1)
                    fits = (many[a] > i) & (score <= high[slot]) & (score >= low[slot])
                    best.add(slot[fits], score[fits], rows.ids[r[fits]])
        slot, score, ids = best.rows()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchor[slot]),
                pa.array(anchors.ids[anchor[slot]]),
                pa.array(positive[slot]),
                pa.array(high[slot]),
                pa.array(ids),
                pa.array(score),
            ],
            names=_NEGATIVE.replace(" bigint", "").split(", "),
        )

    return apply


def _first(rows: DataFrame, keys: list[str], score: str, ident: str, count: int) -> DataFrame:
    """The first `count` rows of each key, with their `rank`."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _chunks(anchors: DataFrame, width: int) -> list[Column]:
    """Conditions that cut the anchors into chunks of about `CHUNK_BYTES` of vectors."""
    per_chunk = max(1, CHUNK_BYTES // (8 * max(width, 1)))
    chunks = -(-anchors.count() // per_chunk)
    place = F.pmod(F.xxhash64("vec_id"), F.lit(max(chunks, 1)))
    return [place == i for i in range(chunks)]


_COLUMNS = [
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
]


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """Hard negatives of the rows that `is_anchor` names: `anchor_id`, `positive_id`, `rank`,
    `negative_id`, `positive_score`, `negative_score`.

    `rows` has `vec_id`, `label` and `vector` as `integer_vectors` gives them. An anchor's positives are
    the first `POSITIVES` rows of its label with another id; for each the first `NEGATIVES` rows of
    other labels that score from `LEAST_PERCENT` of it up to itself. Higher scores come first, ties by
    id. A shorter vector counts as filled up with zeros. Rows that repeat count once; of rows that
    share an id but differ each counts. An empty table, or one without anchors, gives no rows.
    """
    spark = rows.sparkSession
    rows, width = with_angles(rows.distinct())
    anchors = rows.where(is_anchor)
    results = []
    for chunk in _chunks(anchors, width):
        table = anchors.where(chunk).orderBy("vec_id", "label", "vector").toArrow()
        if not table.num_rows:
            continue
        given = Vectors.of(table.combine_chunks().to_batches()[0], width)
        shared = spark.sparkContext.broadcast(given)  # about CHUNK_BYTES of vectors
        found = rows.mapInArrow(
            _positives(shared, width), "anchor bigint, positive_id bigint, positive_score bigint"
        )
        found = _first(found, ["anchor"], "positive_score", "positive_id", POSITIVES)
        found = found.orderBy("anchor", "rank").toArrow()  # POSITIVES rows for each anchor given
        slots = (found.column(c).to_numpy() for c in ("anchor", "positive_id", "positive_score"))
        wanted = spark.sparkContext.broadcast((given, tuple(slots)))
        found = rows.mapInArrow(_negatives(wanted, width), _NEGATIVE)
        slot = ["anchor", "positive_id", "positive_score"]
        found = _first(found, slot, "negative_score", "negative_id", NEGATIVES)
        results.append(stored(found.select(_COLUMNS), "negatives"))
    if not results:
        kinds = {c: "int" if c == "rank" else "bigint" for c in _COLUMNS}
        return rows.selectExpr(*(f"CAST(0 AS {k}) AS {c}" for c, k in kinds.items())).where("false")
    return reduce(DataFrame.union, results)
