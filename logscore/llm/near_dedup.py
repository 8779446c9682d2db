"""Near-duplicate documents: b-bit MinHash.

1. Each text becomes its set of five-word shingles (64-bit hashes) and 144 minima. Rows of four
   minima are the keys of 36 bands; the low four bits of all minima are packed into nine numbers.
2. Texts with equal sets are one class. Only classes are compared, so copies never meet in pairs.
3. Within a band bucket every class meets the bucket's smallest class. Pairs whose estimated
   similarity (from counts of equal packed bits, corrected for chance agreement) is far below the
   threshold are left; the others are confirmed on the full sets.
4. Buckets whose classes are then in one component are done: further links cannot change it. In
   the others all classes meet, in blocks of bounded size, by their packed bits alone; those that
   may be similar form families (a spanning forest of each block, then components).
5. Within a family all classes of different components meet, in blocks, on their full sets. A block
   skips pairs that its own finds have joined, and returns at most one link for each join.
6. Components give the smallest reachable document.

So no step returns all pairs of a group: each returns at most as many rows as it has members.

A pair at the threshold shares no band with probability (1 - 0.75^4)^36 = 1e-6, and is passed over
by its estimate with probability below 1e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscore.llm.components import Joined, components
from logscore.llm.groups import by_group
from logscore.llm.stored import stored
from logscore.llm.words import SPACED, Words, by_run, mix, words_of

SHINGLE = 5
BANDS, ROWS = 36, 4
MINIMA = BANDS * ROWS
BITS = 4
PACKED = MINIMA * BITS // 64
#: Standard error of the estimate at 0.75 is 0.038; six of them below.
SLACK = 0.23
#: Classes of a bucket or family in one block; two blocks meet at once.
BLOCK = 256

_NIBBLES = 0x1111111111111111
_CHANCE = 2.0**-BITS
_BITS = ["n_shingles", *(f"s{i}" for i in range(PACKED))]


def _constants(seed: int) -> np.ndarray:
    return mix(np.arange(1, MINIMA + 1, dtype=np.uint64) + np.uint64(seed << 32))


_FACTORS = (_constants(1) | np.uint64(1)).astype(np.uint32)
_OFFSETS = _constants(2).astype(np.uint32)


def shingle_sets(words: Words) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, _ = words.window_hashes(SHINGLE)
    for begin, end in zip(words.first[:-1], words.first[1:], strict=True):
        count = int(end - begin)
        if count >= SHINGLE:
            yield np.unique(hashes[begin : end - SHINGLE + 1])
        elif count:
            whole = hashlib.blake2b(words.text(begin, end), digest_size=8).digest()
            yield np.frombuffer(whole, dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """MINIMA x sets; every set has a member."""
    members = np.concatenate(sets)
    members = (members >> np.uint64(32)).astype(np.uint32)
    begins = np.cumsum([0, *map(len, sets[:-1])])
    result = np.empty((MINIMA, len(sets)), dtype=np.uint32)
    hashed = np.empty_like(members)
    for k in range(MINIMA):
        np.multiply(members, _FACTORS[k], out=hashed)
        np.add(hashed, _OFFSETS[k], out=hashed)
        np.minimum.reduceat(hashed, begins, out=result[k])
    return result


def _band_keys(minima: np.ndarray) -> np.ndarray:
    """sets x BANDS"""
    keys = np.empty((minima.shape[1], BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(minima.shape[1], band + 1, dtype=np.uint64)
        for row in minima[band * ROWS : (band + 1) * ROWS]:
            key = mix(key + row)
        keys[:, band] = key
    return keys


def _packed(minima: np.ndarray) -> np.ndarray:
    """sets x PACKED"""
    low = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint64).T
    low = low.reshape(len(low), PACKED, 64 // BITS)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low << shifts, axis=2)


SIGNED = (
    "doc_id bigint, text_key bigint, n_shingles bigint, node binary, bands array<bigint>, "
    + ", ".join(f"s{i} bigint" for i in range(PACKED))
)


def _sign(run: pa.RecordBatch) -> pa.RecordBatch:
    sets = list(shingle_sets(words_of(run.column("text"), SPACED)))
    full = np.flatnonzero([len(x) > 0 for x in sets])
    bands = np.zeros((len(full), BANDS), dtype=np.uint64)
    packed = np.zeros((len(sets), PACKED), dtype=np.uint64)
    if len(full):
        minima = _minima([sets[i] for i in full])
        bands, packed[full] = _band_keys(minima), _packed(minima)
    lengths = np.zeros(len(sets) + 1, dtype=np.int32)
    lengths[full + 1] = BANDS
    nodes = [hashlib.blake2b(x, digest_size=16).digest() if len(x) else None for x in sets]
    names = ["doc_id", "text_key", "n_shingles", "node", "bands"]
    return pa.RecordBatch.from_arrays(
        [
            run.column("doc_id"),
            run.column("text_key"),
            pa.array([len(x) for x in sets], pa.int64()),
            pa.array(nodes, pa.binary()),
            pa.ListArray.from_arrays(
                np.cumsum(lengths, dtype=np.int32), pa.array(bands.view(np.int64).ravel())
            ),
            *(pa.array(np.ascontiguousarray(column).view(np.int64)) for column in packed.T),
        ],
        names=[*names, *(f"s{i}" for i in range(PACKED))],
    )


def signatures(docs: DataFrame) -> DataFrame:
    """One row per document: set size, class (null without words), band keys, packed bits."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(by_run(_sign), SIGNED)


def estimate(a: str, b: str) -> Column:
    """Similarity of two packed signatures, corrected for minima that agree by chance."""
    different: Column = F.lit(0)
    for i in range(PACKED):
        x = F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_NIBBLES))
        different = different + F.bit_count(x)
    return ((1 - different / MINIMA) - _CHANCE) / (1 - _CHANCE)


def _may_link(a: str, b: str) -> Column:
    """Whether sizes and estimate leave room for a link."""
    x, y = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    sizes = 100 * F.least(x, y) >= 75 * F.greatest(x, y)
    return sizes & (estimate(a, b) >= 0.75 - SLACK)


def _candidates(left: pa.Table, right: pa.Table) -> np.ndarray:
    """`_may_link` for all pairs of two blocks: rows x rows."""
    different = np.zeros((left.num_rows, right.num_rows), dtype=np.uint16)
    for i in range(PACKED):
        x, y = (t.column(f"s{i}").to_numpy().view(np.uint64) for t in (left, right))
        x = x[:, None] ^ y[None, :]
        x |= x >> np.uint64(2)
        x |= x >> np.uint64(1)
        different += np.bitwise_count(x & np.uint64(_NIBBLES))
    similar = ((1 - different / MINIMA) - _CHANCE) / (1 - _CHANCE) >= 0.75 - SLACK
    x, y = (t.column("n_shingles").to_numpy() for t in (left, right))
    least, most = np.minimum(x[:, None], y[None, :]), np.maximum(x[:, None], y[None, :])
    return similar & (100 * least >= 75 * most)


def _sides(group: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The two blocks that meet; a block that meets itself is both."""
    first = group.column("first").to_numpy(zero_copy_only=False).astype(bool)
    left, right = group.filter(pa.array(first)), group.filter(pa.array(~first))
    return (left, right) if group.column("i")[0] != group.column("j")[0] else (left, left)


def _open_pairs(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, int]]:
    """Candidates whose classes are in different components."""
    found = _candidates(left, right)
    x, y = (np.array(t.column("root").to_pylist(), dtype=object) for t in (left, right))
    found &= x[:, None] != y[None, :]
    if left is right:
        found = np.triu(found, 1)
    yield from zip(*(places.tolist() for places in np.nonzero(found)), strict=True)


def _pair_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([pair[k] for pair in pairs], pa.binary()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _forest(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the candidates of two blocks."""
    left, right = _sides(group)
    if left.num_rows and right.num_rows:
        x, y = left.column("node").to_pylist(), right.column("node").to_pylist()
        joined = Joined()
        yield _pair_batch(
            [(x[i], y[j]) for i, j in _open_pairs(left, right) if joined.join(x[i], y[j])]
        )


def _links(group: pa.Table) -> Iterator[pa.RecordBatch]:
    """Links of two blocks between components that no other link of theirs has joined."""
    left, right = _sides(group)
    if not left.num_rows or not right.num_rows:
        return
    sets = [list(shingle_sets(words_of(t.column("text"), SPACED))) for t in (left, right)]
    nodes = [t.column("node").to_pylist() for t in (left, right)]
    roots = [t.column("root").to_pylist() for t in (left, right)]
    joined, links = Joined(), []
    for i, j in _open_pairs(left, right):
        if joined.root(roots[0][i]) != joined.root(roots[1][j]) and _similar(
            sets[0][i], sets[1][j]
        ):
            joined.join(roots[0][i], roots[1][j])
            links.append((nodes[0][i], nodes[1][j]))
    yield _pair_batch(links)


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= 75 * (len(x) + len(y) - both)


def _confirm(run: pa.RecordBatch) -> pa.RecordBatch:
    """Of pairs of texts, those whose sets are as similar as asked."""
    left = shingle_sets(words_of(run.column("text"), SPACED))
    right = shingle_sets(words_of(run.column("other_text"), SPACED))
    similar = [_similar(x, y) for x, y in zip(left, right, strict=True)]
    return run.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))


def _confirmed(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by their full sets."""
    other = texts.select(F.col("node").alias("b"), F.col("text").alias("other_text"))
    joined = pairs.join(texts.withColumnRenamed("node", "a"), "a").join(other, "b")
    linked = joined.select("a", "b", "text", "other_text").mapInArrow(
        by_run(_confirm), "a binary, b binary"
    )
    return stored(linked, name)


def _texts(docs: DataFrame, chosen: DataFrame, nodes: DataFrame) -> DataFrame:
    """The text of one document of each class."""
    wanted = chosen.select("node", "doc_id", "text_key").join(nodes.distinct(), "node")
    wanted = wanted.select("node", F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
    texts = rows.join(wanted, same).groupBy("node").agg(F.first("text").alias("text"))
    return stored(texts, "near-texts")


def _found(docs: DataFrame) -> DataFrame:
    """`near_duplicates` with the hash of each text."""
    docs = docs.select("doc_id", "text")
    signed = stored(signatures(docs), "near-signatures")
    values = ["doc_id", "text_key", "bands", *_BITS]
    least = signed.where("node is not null").groupBy("node")
    chosen = least.agg(F.min_by(F.struct(*values), F.struct("doc_id", "text_key")).alias("x"))
    chosen = stored(chosen.select("node", "x.*"), "near-classes")
    bits = chosen.select("node", *_BITS)

    members = chosen.select("node", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("size"))
    members = stored(members.join(buckets.where("size > 1"), "bucket"), "near-buckets")

    stars = members.where("a <> node").select("a", F.col("node").alias("b")).distinct()
    stars = stars.join(bits.alias("x"), F.col("a") == F.col("x.node"))
    stars = stars.join(bits.alias("y"), F.col("b") == F.col("y.node")).where(_may_link("x", "y"))
    stars = stored(stars.select("a", "b"), "near-stars")
    nodes = stars.select(F.explode(F.array("a", "b")).alias("node"))
    links = _confirmed(stars, _texts(docs, chosen, nodes), "near-links")
    roots = components(links, "a", "b")

    more = _across(docs, chosen, members, roots)
    roots = stored(components(links.union(more), "a", "b"), "near-components")
    return _result(signed, roots)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` (smallest doc_id reachable) and `kept` of each row.

    Reads `doc_id` and `text`; other columns, whatever their names, are not touched. A null text or
    one without words has no shingles and is linked with nothing: it is its own component. A text
    of fewer than five words is one shingle. Repeated rows are all returned, with the same result;
    rows of equal text but different ids are linked. A null doc_id never names a component while
    another member has an id; if all are null, component_id is null and the rows are kept.
    Very long texts are worked on one at a time. An empty table gives an empty result.
    """
    return _found(docs).drop("text_key")


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows that `near_duplicates` keeps; all columns pass through.

    Rows that repeat an id and its text are kept or not together.
    """
    kept = _found(docs).where("kept").select("doc_id", "text_key").distinct()
    whole = docs.select(F.struct("*").alias("whole"), "doc_id", F.xxhash64("text").alias("text_key"))
    same = whole["doc_id"].eqNullSafe(kept["doc_id"]) & (whole["text_key"] == kept["text_key"])
    return whole.join(kept, same, "left_semi").select("whole.*")


def _blocked(rows: DataFrame) -> DataFrame:
    """Rows of each key in blocks (`size` is their number); a row for each pair of blocks it is in."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = rows.withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("block", "other"), F.greatest("block", "other")
    first = F.col("block") <= F.col("other")
    return rows.select("*", i.alias("i"), j.alias("j"), first.alias("first")).drop(
        "blocks", "block", "other", "size"
    )


def _across(docs: DataFrame, chosen: DataFrame, members: DataFrame, roots: DataFrame) -> DataFrame:
    """Links between classes in one bucket but in different components so far.

    Buckets of two are settled: their one pair was confirmed or refused.
    """
    bits = chosen.select("node", *_BITS)
    root = F.coalesce("root", "node").alias("root")
    placed = members.where("size > 2").join(roots, "node", "left")
    placed = placed.select("bucket", "size", "node", root)
    split = placed.groupBy("bucket").agg(F.min("root").alias("r"), F.max("root").alias("s"))
    placed = placed.join(split.where("r <> s").select("bucket"), "bucket").join(bits, "node")
    forest = by_group(
        _blocked(placed), ["bucket", "i", "j"], _forest, "a binary, b binary"
    )
    families = components(stored(forest, "near-forest"), "a", "b")
    families = stored(families.withColumnRenamed("root", "family"), "near-families")
    sizes = families.groupBy("family").agg(F.count("*").alias("size"))
    texts = _texts(docs, chosen, families.select("node"))
    rows = families.join(sizes, "family").join(roots, "node", "left")
    rows = rows.select("family", "size", "node", root).join(bits, "node").join(texts, "node")
    found = by_group(_blocked(rows), ["family", "i", "j"], _links, "a binary, b binary")
    return stored(found, "near-links")


def _result(signed: DataFrame, roots: DataFrame) -> DataFrame:
    rows = signed.select("doc_id", "text_key", "n_shingles", "node").join(roots, "node", "left")
    rows = rows.withColumn("root", F.coalesce("root", "node"))
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    rows = rows.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return rows.select(
        "doc_id",
        "text_key",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )
