"""Removal of passages that an earlier document has, by merged Burrows-Wheeler transforms.

A window is a string of `length` bytes within a document. Equal windows meet in one task as follows.
Every window has an anchor, the least hash of the grams of `GRAM` bytes in it, so equal windows have
equal anchors; windows in a row with the same anchor are a piece of text.

1. Documents are written once as parts, as they lie, bucketed by part: texts are never shuffled.
2. Parts send the hashes of their anchors, each once, to tasks that tell which are in two documents.
   Only pieces with such anchors go on (a superset: hashes are cut to 28 bits and their bucket).
3. Each part sends the hashes of its different pieces, with the smallest doc_id that has each, to the
   buckets of their anchors. There it is known which document is the first with a piece: the later
   ones lose all of it, and their parts are told so. No text is sent for that.
4. Different pieces with the same anchor may share windows. Of those, and only of those, the part of
   the first document sends the string; one that is alone with its anchor has nothing to be compared
   with. Tasks make the Burrows-Wheeler transforms of shards and merge them by interleave refinement.
   A run of suffixes with `length` bytes in common is a repeated window: all but those of its smallest
   doc_id are to be removed. What is to be removed goes back to the parts.
   Of anchors with very many different pieces the hash of each window is sent instead, dealt by itself.
5. Parts cut their documents.

What a task holds is bounded by the size of a part and of a bucket, not by how often a text is
repeated: a string is sent by the parts that have its first document only, and a piece as a hash once
by each part that has it. Pieces of an anchor are told apart by 64 bits, windows by 92.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscore.llm import bwt
from logscore.llm.groups import by_group
from logscore.llm.words import buffer_of, mix, runs
from logscore.session import scratch_folder

LENGTH = 50
#: Bytes of a gram, of which the least hash in a window is its anchor.
GRAM = 20
#: Bytes of text in a part, about, and those that are worked on at a time.
PART_BYTES = 32 << 20
#: Parts that a reading task's text is cut into at most; if it has more, texts are dealt anew first.
MOST_CUTS = 64
RUN_BYTES = 128 << 10
#: Bytes of pieces that are merged at a time, about.
GROUP_BYTES = 128 << 10
#: Bytes of pieces in a shard.
SHARD_BYTES = 64 << 10
#: Different pieces of an anchor, or pieces of it in a part, above which it is split by window.
HOT_PIECES = 4096
#: Parts of which a bucket can hold that many pieces of an anchor; more pieces are not dealt by it.
HOT_PARTS = 256
#: Windows of a piece; a bit each.
PIECE_WINDOWS = 64

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_STEP = 0xD6E8FEB86659FD93
_LOW = np.uint64(0xFFFFFFFF)
_NO_DOC = np.iinfo(np.int64).min

_powers: dict[str, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i below `size`."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(1 << max(size - 1, 1).bit_length(), base, dtype=np.uint64)
        known[0] = 1
        known = _powers[base] = np.cumprod(known, dtype=np.uint64)
    return known[:size]


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` bytes by where they begin, from those of half the bytes."""
    if len(data) < size:
        return np.zeros(0, np.uint64)

    def hashes(size: int) -> np.ndarray:
        if size == 1:
            return data.astype(np.uint64) + np.uint64(1)
        half = hashes(size // 2)
        count, width = len(data) - size + 1, size // 2
        made = half[:count] * np.uint64(pow(_BASE, width, 1 << 64))
        made += half[width : width + count]
        if size % 2:
            made *= np.uint64(_BASE)
            made += data[size - 1 :].astype(np.uint64) + np.uint64(1)
        return made

    return mix(hashes(size))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of `width` values in a row."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


@dataclass
class Pieces:
    """Pieces of a run of texts: where each begins, its windows, its anchor, the text it is of."""

    data: np.ndarray
    offsets: np.ndarray
    length: int
    starts: np.ndarray
    counts: np.ndarray
    anchors: np.ndarray
    texts: np.ndarray
    sums: np.ndarray

    def hashes(self, starts: np.ndarray, counts: np.ndarray | int) -> np.ndarray:
        """Hashes of the strings of `counts` windows; equal strings have equal ones."""
        ends = starts + counts + (self.length - GRAM)
        back = _power(pow(_STEP, -1, 1 << 64), len(self.sums))[starts]
        return mix((self.sums[ends] - self.sums[starts]) * back + np.uint64(1) * _wide(counts))

    def strings(self, starts: np.ndarray, counts: np.ndarray) -> pa.Array:
        return _strings(self.data, starts, counts + (self.length - 1))

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each window of some pieces begins, and the text it is of."""
        counts = self.counts[chosen]
        return _ranges(self.starts[chosen], counts), np.repeat(self.texts[chosen], counts)


def _wide(counts: np.ndarray | int) -> np.ndarray:
    return np.asarray(counts).astype(np.uint64)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] numbers, for all i."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def _strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.cumsum(sizes, dtype=np.int64)
    offsets = np.append(0, ends)
    values = pa.py_buffer(data[_ranges(starts, sizes)].tobytes())
    kind = pa.large_binary()
    made = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(offsets.tobytes()), values])
    return made


def pieces_of(column: pa.Array, length: int = LENGTH) -> Pieces:
    data, offsets = buffer_of(column)
    size = len(data)
    grams = _grams(data, GRAM)
    sums = np.zeros(len(grams) + 1, dtype=np.uint64)
    np.cumsum(grams * _power(_STEP, len(grams)), out=sums[1:])
    if size < length:
        none = np.zeros(0, np.int64)
        return Pieces(data, offsets, length, none, none, none.astype(np.uint64), none, sums)
    least = _least(grams, length - GRAM + 1)
    marks = np.zeros(size + 1, dtype=np.int32)
    long = offsets[1:] - offsets[:-1] >= length
    marks[offsets[:-1][long]] += 1
    marks[offsets[1:][long] - length + 1] -= 1
    fits = np.cumsum(marks)[: len(least)] > 0
    begins = fits.copy()
    begins[1:] &= (least[1:] != least[:-1]) | ~fits[:-1]
    starts = np.flatnonzero(begins)
    stops = fits & np.append(begins[1:] | ~fits[1:], True)
    counts = np.flatnonzero(stops) + 1 - starts
    if (counts > PIECE_WINDOWS).any():
        parts = -(-counts // PIECE_WINDOWS)
        place = _ranges(np.zeros(len(parts), np.int64), parts)
        starts, ends = np.repeat(starts, parts), np.repeat(starts + counts, parts)
        starts = starts + place * PIECE_WINDOWS
        counts = np.minimum(ends - starts, PIECE_WINDOWS)
    texts = np.searchsorted(offsets, starts, side="right") - 1
    return Pieces(data, offsets, length, starts, counts, least[starts], texts, sums)


def _ids(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    column = batch.column("doc_id")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.fill_null(_NO_DOC).to_numpy(zero_copy_only=False)


def _runs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    for batch in table.to_batches():
        yield from runs(batch, "text", RUN_BYTES)


def _groups_of(values: np.ndarray) -> np.ndarray:
    """Where runs of equal sorted values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else values


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes & _LOW) % np.uint64(buckets)


def _cut_hash(hashes: np.ndarray) -> np.ndarray:
    """28 bits of each, above four that are free."""
    return (hashes >> np.uint64(36)).astype(np.uint32) << np.uint32(4)


def _often(pieces: int) -> np.ndarray:
    """Numbers of pieces up to the given one; three bits tell which, or 7 for more."""
    return pieces // 4 ** np.arange(6, -1, -1)


def _anchor_buckets(
    part: int, anchors: np.ndarray, docs: np.ndarray, buckets: int, often: np.ndarray
):
    """One row for each bucket of a part's anchors: cut hashes with a bit for anchors of several
    documents and three for the least number in `often` that they stand there no more often than."""
    order = np.argsort(anchors)
    anchors, docs = anchors[order], docs[order]
    at = _groups_of(anchors)
    several = np.minimum.reduceat(docs, at) < np.maximum.reduceat(docs, at)
    times = np.searchsorted(often, np.diff(np.append(at, len(anchors))))
    anchors = anchors[at]
    cut = _cut_hash(anchors) | several.astype(np.uint32) | (times.astype(np.uint32) << np.uint32(1))
    bucket = _bucket(anchors, buckets)
    order = np.argsort((bucket << np.uint64(32)) | cut.astype(np.uint64))
    bucket, cut = bucket[order], cut[order]
    at = _groups_of(bucket)
    rows = [x.tobytes() for x in np.split(cut, at[1:])]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[at].astype(np.int64)),
            pa.array(np.full(len(at), part, dtype=np.int64)),
            pa.array(rows, pa.binary()),
        ],
        names=["bucket", "part", "cut"],
    )


def _anchors(length: int, buckets: int, often: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        count = 0
        for batch in batches:
            part = batch.column("part").to_numpy(zero_copy_only=False)
            cuts = [*_groups_of(part).tolist(), batch.num_rows]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                for run in runs(batch.slice(begin, end - begin), "text", RUN_BYTES):
                    found, docs = pieces_of(run.column("text"), length), _ids(run)
                    docs = docs[found.texts]
                    known = docs != _NO_DOC
                    held.setdefault(int(part[begin]), []).append((found.anchors[known], docs[known]))
                    count += len(docs)
                if count > 4_000_000:
                    yield from flush(held)
                    count = 0
        yield from flush(held)

    def flush(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        for part, arrays in held.items():
            anchors, docs = (np.concatenate(x) for x in zip(*arrays, strict=True))
            if len(anchors):
                yield _anchor_buckets(part, anchors, docs, buckets, often)
        held.clear()

    return work


def _shared(often: np.ndarray, most: int):
    """Which anchors of a bucket are in two documents, told to the parts that have them; those that
    may have more than `most` pieces, or have more in a part than `often` says, are marked."""

    def work(bucket: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = bucket.column("cut").to_pylist()
        sizes = [len(row) // 4 for row in rows]
        cut = np.frombuffer(b"".join(rows), dtype=np.uint32)
        part = np.repeat(bucket.column("part").to_numpy(), sizes)
        order = np.argsort(cut >> np.uint32(4), kind="stable")
        cut, part = cut[order], part[order]
        at = _groups_of(cut >> np.uint32(4))
        times = np.diff(np.append(at, len(cut)))
        shared = (times > 1) | (np.bitwise_or.reduceat(cut & np.uint32(1), at) > 0)
        pieces = np.append(often, most + 1)[(cut >> np.uint32(1)) & np.uint32(7)]
        hot = np.add.reduceat(pieces, at) > most
        keys = (cut[at] >> np.uint32(4) << np.uint32(1)) | hot
        keys = np.repeat(keys[shared], times[shared])
        part = part[np.repeat(shared, times)]
        order = np.argsort(part, kind="stable")
        part, keys = part[order], keys[order]
        at = _groups_of(part)
        if len(at):
            number = bucket.column("bucket")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[at]),
                    pa.array(np.full(len(at), number)),
                    pa.array([x.tobytes() for x in np.split(keys, at[1:])], pa.binary()),
                ],
                names=["part", "bucket", "keys"],
            )

    return work


def _different(hashes: np.ndarray, docs: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each string of a part once: where it is with the smallest doc_id, and the largest it has."""
    order = np.lexsort((docs, hashes))
    at = _groups_of(hashes[order])
    return order[at], np.maximum.reduceat(most[order], at) if len(at) else most


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings and where each begins and ends."""
    offsets = np.frombuffer(strings.buffers()[1], np.int64)
    offsets = offsets[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(strings.buffers()[2] or b"", np.uint8), offsets


def _packed(values: np.ndarray) -> bytes:
    """The least number, and as narrow as they fit what the others are above it."""
    low = values.min()
    above = (values - low).view(np.uint64)
    return low.tobytes() + above.astype(np.min_scalar_type(above.max())).tobytes()


def _unpacked(packed: bytes, count: int) -> np.ndarray:
    above = np.frombuffer(packed, np.dtype(f"u{(len(packed) - 8) // count}"), offset=8)
    return np.frombuffer(packed, np.int64, 1) + above.astype(np.int64)


#: Strings of a part in a bucket: cut hashes of their anchors with bits for strings of several
#: documents and anchors that are split, hashes of the strings, their smallest doc_ids and, where they
#: are to be compared, the strings: their sizes, then one after the other. `alone` are single windows.
_STRINGS = (
    "bucket bigint, part bigint, alone boolean, marks binary, hashes binary, docs binary, "
    "strings binary"
)
#: What a part is told, by kind: of pieces, of single windows, or that pieces are split into these.
_TOLD = "part bigint, kind bigint, hashes binary, firsts binary, bits binary"
_PIECE, _WINDOW, _SPLIT = range(3)
_CODEC = "zstd"


_ARROW = {"bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _empty(schema: str) -> pa.Table:
    fields = [part.split() for part in schema.split(", ")]
    return pa.table({name: pa.array([], _ARROW[kind]) for name, kind in fields})


def _size(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little")


def _to_buckets(
    part: int,
    alone: bool,
    bucket: np.ndarray,
    marks: np.ndarray,
    hashes: np.ndarray,
    docs: np.ndarray,
    strings: pa.Array | None = None,
) -> pa.Table:
    if not len(bucket):
        return _empty(_STRINGS)
    order = np.argsort((bucket << np.uint64(32)) | marks)
    bucket, marks, hashes, docs = bucket[order], marks[order], hashes[order], docs[order]
    at = _groups_of(bucket)
    cuts = [*zip(at.tolist(), [*at[1:].tolist(), len(order)], strict=True)]
    texts = [None] * len(cuts)
    if strings is not None:
        data, offsets = _bytes_of(strings.take(pa.array(order)))
        sizes = np.diff(offsets).astype(np.uint8)
        texts = [sizes[a:b].tobytes() + data[offsets[a] : offsets[b]].tobytes() for a, b in cuts]
        texts = [_size(x) + pa.compress(x, codec=_CODEC, asbytes=True) for x in texts]
    return pa.table(
        {
            "bucket": pa.array(bucket[at].astype(np.int64)),
            "part": pa.array(np.full(len(at), part, dtype=np.int64)),
            "alone": pa.array(np.full(len(at), alone)),
            "marks": pa.array([marks[a:b].tobytes() for a, b in cuts], pa.binary()),
            "hashes": pa.array([hashes[a:b].tobytes() for a, b in cuts], pa.binary()),
            "docs": pa.array([_packed(docs[a:b]) for a, b in cuts], pa.binary()),
            "strings": pa.array(texts, pa.binary()),
        }
    )


def _in_bucket(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Marks, hashes, doc_ids and parts of the strings of a bucket."""
    hashes = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
    sizes = [len(x) for x in hashes]
    docs = map(_unpacked, rows.column("docs").to_pylist(), sizes)
    marks = np.frombuffer(b"".join(rows.column("marks").to_pylist()), np.uint32)
    part = np.repeat(rows.column("part").to_numpy(), sizes)
    return marks, np.concatenate(hashes), np.concatenate([*docs]), part


def _first(marks: np.ndarray, hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest doc_id with each string, and how many different strings its anchor has."""
    anchor = marks >> np.uint32(1)
    order = np.lexsort((docs, hashes, anchor))
    anchor, hashes = anchor[order], hashes[order]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (hashes[1:] != hashes[:-1]))
    first, count = np.empty_like(docs), np.empty(len(docs), dtype=np.int64)
    first[order] = docs[order][new][np.cumsum(new) - 1]
    at = _groups_of(anchor)
    count[order] = np.repeat(np.add.reduceat(new, at, dtype=np.int64), np.diff([*at, len(order)]))
    return first, count


def _tell(
    kind: int,
    part: np.ndarray,
    hashes: np.ndarray,
    firsts: np.ndarray | None = None,
    bits: np.ndarray | None = None,
) -> Iterator[pa.RecordBatch]:
    """One row for each part."""
    order = np.argsort(part, kind="stable")
    at = _groups_of(part[order])
    if not len(at):
        return

    def cut(values: np.ndarray | None, pack=np.ndarray.tobytes) -> pa.Array:
        rows = [None] * len(at) if values is None else map(pack, np.split(values[order], at[1:]))
        return pa.array([*rows], pa.binary())

    yield pa.RecordBatch.from_arrays(
        [
            pa.array(part[order][at]),
            pa.array(np.full(len(at), kind)),
            cut(hashes),
            cut(firsts, _packed),
            cut(bits),
        ],
        names=["part", "kind", "hashes", "firsts", "bits"],
    )


def _told(told: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of what a part is told, each once, the first doc_ids and the bits."""
    rows = told.filter(pa.array(told.column("kind").to_numpy(zero_copy_only=False) == kind)).to_pylist()
    hashes = [np.frombuffer(row["hashes"], np.uint64) for row in rows]
    firsts = [
        np.zeros(len(x), np.int64) if row["firsts"] is None else _unpacked(row["firsts"], len(x))
        for row, x in zip(rows, hashes, strict=True)
    ]
    bits = [
        np.zeros(len(x), np.uint64) if row["bits"] is None else np.frombuffer(row["bits"], np.uint64)
        for row, x in zip(rows, hashes, strict=True)
    ]
    none = np.zeros(0, np.uint64)
    hashes, firsts = np.concatenate([none, *hashes]), np.concatenate([none.view(np.int64), *firsts])
    order = np.argsort(hashes)
    hashes, firsts, bits = hashes[order], firsts[order], np.concatenate([none, *bits])[order]
    at = _groups_of(hashes)  # a piece may be told twice, once with bits; its first doc_id is the same
    return hashes[at], firsts[at], np.bitwise_or.reduceat(bits, at) if len(at) else bits


def _found(hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `wanted` are among sorted `hashes`, and where."""
    if not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    hit = np.flatnonzero(hashes[at] == wanted)
    return hit, at[hit]


def _shared_pieces(length: int, buckets: int):
    """The different pieces of a part whose anchors are in two documents, as hashes."""

    def work(docs: pa.Table, keys: pa.Table) -> pa.Table:
        told = [np.frombuffer(x, np.uint32).astype(np.uint64) for x in keys.column("keys").to_pylist()]
        numbers = keys.column("bucket").to_numpy().astype(np.uint64)
        told = [x | (n << np.uint64(29)) for n, x in zip(numbers, told, strict=True)]
        told = np.unique(np.concatenate([np.zeros(0, np.uint64), *told]))
        known, hot = told >> np.uint64(1), (told & np.uint64(1)) > 0
        found = []
        for run in _runs(docs) if len(told) else ():
            pieces, ids = pieces_of(run.column("text"), length), _ids(run)
            key = (_bucket(pieces.anchors, buckets) << np.uint64(28)) | (pieces.anchors >> np.uint64(36))
            hit, at = _found(known, key)
            here = ids[pieces.texts[hit]]
            hit, at, here = (x[here != _NO_DOC] for x in (hit, at, here))
            hashes = pieces.hashes(pieces.starts[hit], pieces.counts[hit])
            one, most = _different(hashes, here, here)
            found.append((hashes[one], here[one], most, pieces.anchors[hit[one]], hot[at[one]]))
        if not found:
            return _empty(_STRINGS)
        hashes, ids, most, anchors, hot = (np.concatenate(x) for x in zip(*found, strict=True))
        one, most = _different(hashes, ids, most)
        hashes, ids, hot = hashes[one], ids[one], hot[one]
        # Pieces of anchors that are split need not meet but with their equals.
        anchors = np.where(hot, hashes, anchors[one])
        marks = _cut_hash(anchors) | (most > ids) | (hot.astype(np.uint32) << np.uint32(1))
        part = docs.column("part")[0].as_py()
        return _to_buckets(part, False, _bucket(anchors, buckets), marks, hashes, ids)

    return work


def _bucket_first(bucket: pa.Table, most: int) -> tuple[np.ndarray, ...]:
    marks, hashes, docs, part = _in_bucket(bucket)
    first, count = _first(marks, hashes, docs)
    hot = (marks & np.uint32(2) > 0) | (count > most)
    # Of the documents with a piece the first may yet lose windows that other pieces have too.
    asked = (first == docs) & (hot | (count > 1))
    return marks, hashes, docs, part, first, asked & ~hot, asked & hot


def _ask(most: int):
    """Asks the parts with the first document of a piece for its string, or for its windows if its
    anchor has more than `most` pieces."""

    def work(bucket: pa.Table) -> Iterator[pa.RecordBatch]:
        _, hashes, _, part, _, whole, split = _bucket_first(bucket, most)
        yield from _tell(_PIECE, part[whole], hashes[whole])
        yield from _tell(_SPLIT, part[split], hashes[split])

    return work


def _tell_first(most: int):
    """Tells the parts with later documents of a piece which one is the first."""

    def work(bucket: pa.Table) -> Iterator[pa.RecordBatch]:
        marks, hashes, docs, part, first, _, split = _bucket_first(bucket, most)
        later = (first < docs) | (marks & np.uint32(1) > 0)
        yield from _tell(_PIECE, part[later], hashes[later], first[later])
        yield from _tell(_SPLIT, part[split], hashes[split])

    return work


def _asked_strings(length: int, buckets: int):
    """The strings, or the hashes of the windows, of the pieces that a part is asked for."""

    def work(docs: pa.Table, told: pa.Table) -> pa.Table:
        asked = {kind: _told(told, kind)[0] for kind in (_PIECE, _SPLIT)}
        found = {kind: [] for kind in asked}
        for run in _runs(docs) if told.num_rows else ():
            pieces, ids = pieces_of(run.column("text"), length), _ids(run)
            wanted = pieces.hashes(pieces.starts, pieces.counts)
            for kind, hashes in asked.items():
                hit, _ = _found(hashes, wanted)
                hit = hit[ids[pieces.texts[hit]] != _NO_DOC]
                starts, counts, texts = pieces.starts[hit], pieces.counts[hit], pieces.texts[hit]
                anchors = pieces.anchors[hit]
                if kind == _SPLIT:
                    anchors = np.repeat(anchors, counts)
                    (starts, texts), counts = pieces.windows(hit), np.ones(len(anchors), np.int64)
                made = pieces.hashes(starts, counts)
                one, most = _different(made, ids[texts], ids[texts])
                strings = pieces.strings(starts[one], counts[one]) if kind == _PIECE else None
                found[kind].append((made[one], ids[texts[one]], most, anchors[one], strings))
        tables = [_empty(_STRINGS)]
        for kind, each in found.items():
            if not each:
                continue
            *numbers, strings = zip(*each, strict=True)
            hashes, ids, most, anchors = map(np.concatenate, numbers)
            one, most = _different(hashes, ids, most)
            hashes, ids, anchors = hashes[one], ids[one], anchors[one]
            strings = pa.concat_arrays(strings).take(pa.array(one)) if kind == _PIECE else None
            bucket = _bucket(anchors if kind == _PIECE else hashes, buckets)
            marks = _cut_hash(anchors) | (most > ids)
            part = docs.column("part")[0].as_py()
            tables.append(_to_buckets(part, kind == _SPLIT, bucket, marks, hashes, ids, strings))
        return pa.concat_tables(tables)

    return work


def first_of_windows(strings: list[bytes], docs: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each string, a bit for each of its windows that a string of a smaller doc_id has too.

    Strings are different, have `length` to `length + 63` bytes, and come with the smallest doc_id
    that has them.
    """
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(SHARD_BYTES, sizes.sum(), SHARD_BYTES))
    cuts = np.unique([0, *cuts.tolist(), len(strings)])
    shards, string_of, place_of = [], [], []
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        data = np.frombuffer(b"".join(strings[begin:end]), dtype=np.uint8)
        made = bwt.transform(data, np.append(0, np.cumsum(sizes[begin:end])))
        rows = sizes[begin:end] + 1
        string_of.append(np.repeat(np.arange(begin, end), rows)[made.place])
        place_of.append(_ranges(np.zeros(end - begin, np.int64), rows)[made.place])
        shards.append(made)
    order, starts = bwt.merge(shards, length)
    string = np.concatenate(string_of)[order]
    place = np.concatenate(place_of)[order]
    least = np.minimum.reduceat(docs[string], starts)
    later = docs[string] > np.repeat(least, np.diff(np.append(starts, len(order))))
    later &= place + length <= sizes[string]
    bits = np.zeros(len(strings), dtype=np.uint64)
    np.bitwise_or.at(bits, string[later], np.uint64(1) << place[later].astype(np.uint64))
    return bits


def _strings_of(rows: pa.Table, counts: list[int]) -> pa.Array:
    """The strings that `_to_buckets` has put into rows."""
    sizes, texts = [], []
    for packed, count in zip(rows.column("strings").to_pylist(), counts, strict=True):
        size = int.from_bytes(packed[:8], "little")
        text = pa.decompress(packed[8:], decompressed_size=size, codec=_CODEC, asbytes=True)
        sizes.append(np.frombuffer(text, np.uint8, count))
        texts.append(text[count:])
    ends = np.cumsum(np.concatenate(sizes), dtype=np.int64)
    offsets = pa.py_buffer(np.append(0, ends).tobytes())
    buffers = [None, offsets, pa.py_buffer(b"".join(texts))]
    return pa.Array.from_buffers(pa.large_binary(), len(ends), buffers)


def _bits(rows: pa.Table, length: int, group_bytes: int) -> Iterator[pa.RecordBatch]:
    """Tells the parts of a bucket's strings which windows a smaller doc_id has in another string."""
    marks, hashes, docs, part = _in_bucket(rows)
    counts = [len(x) // 8 for x in rows.column("hashes").to_pylist()]
    coded = _strings_of(rows, counts).dictionary_encode()
    number = coded.indices.to_numpy()  # parts may have the same string where doc_ids repeat
    first = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(first, number, docs)
    anchor = np.empty(len(first), dtype=np.uint32)
    anchor[number] = marks >> np.uint32(4)
    order = np.argsort(anchor, kind="stable")
    at = _groups_of(anchor[order])
    times = np.diff(np.append(at, len(order)))
    order = order[np.repeat(times > 1, times)]
    strings = coded.dictionary.take(pa.array(order))
    sizes = np.diff(_bytes_of(strings)[1])
    at = _groups_of(anchor[order])
    before = np.repeat((np.cumsum(sizes) - sizes)[at], np.diff(np.append(at, len(order))))
    groups = _groups_of(before // group_bytes).tolist()
    bits = np.zeros(len(first), dtype=np.uint64)
    for begin, end in zip(groups, [*groups[1:], len(order)], strict=True):
        some = order[begin:end]
        each = strings.slice(begin, end - begin).to_pylist()
        bits[some] = first_of_windows(each, first[some], length)
    bits, first = bits[number], first[number]
    told = (bits > 0) & (first == docs)
    yield from _tell(_PIECE, part[told], hashes[told], first[told], bits[told])


def _compare(length: int, group_bytes: int):
    def work(bucket: pa.Table) -> Iterator[pa.RecordBatch]:
        alone = bucket.column("alone").to_numpy()
        pieces, windows = bucket.filter(pa.array(~alone)), bucket.filter(pa.array(alone))
        if pieces.num_rows:
            yield from _bits(pieces, length, group_bytes)
        if windows.num_rows:
            marks, hashes, docs, part = _in_bucket(windows)
            first, _ = _first(marks, hashes, docs)
            later = (first < docs) | (marks & np.uint32(1) > 0)
            yield from _tell(_WINDOW, part[later], hashes[later], first[later])

    return work


def _removed(run: pa.RecordBatch, told: list[tuple], length: int) -> tuple[Pieces, np.ndarray]:
    """Which bytes of a run of texts go."""
    pieces, ids = pieces_of(run.column("text"), length), _ids(run)
    marks = np.zeros(len(pieces.data) + 1, dtype=np.int32)

    def later(starts: np.ndarray, size: np.ndarray | int) -> None:
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + size, -1)

    wanted = pieces.hashes(pieces.starts, pieces.counts)
    hashes, first, bits = told[_PIECE]
    hit, at = _found(hashes, wanted)
    docs = ids[pieces.texts[hit]]
    whole = hit[docs > first[at]]
    later(pieces.starts[whole], pieces.counts[whole] + length - 1)
    some = (docs == first[at]) & (bits[at] != 0)
    begins, sets = pieces.starts[hit[some]], bits[at[some]]
    for i in range(PIECE_WINDOWS if len(begins) else 0):
        later(begins[(sets >> np.uint64(i)) & np.uint64(1) > 0] + i, length)
    split, _ = _found(told[_SPLIT][0], wanted)
    starts, texts = pieces.windows(split)
    hashes, first, _ = told[_WINDOW]
    hit, at = _found(hashes, pieces.hashes(starts, 1))
    later(starts[hit[ids[texts[hit]] > first[at]]], length)
    return pieces, np.cumsum(marks[:-1]) > 0


_KEPT = "doc_id bigint, n_bytes bigint, spans array<struct<begin: bigint, end: bigint>>, kept binary"


def _cut(length: int):
    spans_of = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def work(docs: pa.Table, told: pa.Table) -> pa.Table:
        cuts = [_told(told, kind) for kind in (_PIECE, _WINDOW, _SPLIT)]
        done = []
        for run in _runs(docs):
            pieces, gone = _removed(run, cuts, length)
            data, offsets = pieces.data, pieces.offsets
            edge = np.zeros(len(data) + 1, dtype=bool)
            edge[offsets] = True
            before = np.append(False, gone[:-1])
            after = np.append(gone[1:], False)
            begins = np.flatnonzero(gone & (~before | edge[:-1]))
            ends = np.flatnonzero(gone & (~after | edge[1:])) + 1
            text = np.searchsorted(offsets, begins, side="right") - 1
            spans = pa.StructArray.from_arrays(
                [pa.array(begins - offsets[text]), pa.array(ends - offsets[text])],
                fields=list(spans_of),
            )
            per_text = np.searchsorted(begins, offsets).astype(np.int32)
            stay = np.append(0, np.cumsum(~gone))
            kept = pa.Array.from_buffers(
                pa.binary(),
                run.num_rows,
                [
                    None,
                    pa.py_buffer(stay[offsets].astype(np.int32).tobytes()),
                    pa.py_buffer(data[~gone].tobytes()),
                ],
            )
            done.append(
                pa.table(
                    {
                        "doc_id": run.column("doc_id"),
                        "n_bytes": pa.array(np.diff(offsets)),
                        "spans": pa.ListArray.from_arrays(pa.array(per_text), spans),
                        "kept": kept,
                    }
                )
            )
        return pa.concat_tables(done)

    return work


def cut_repeats(
    docs: DataFrame, length: int = LENGTH, part_bytes: int = PART_BYTES, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Per document: `doc_id`, `n_bytes`, the `spans` that go (bytes of the text in UTF-8, maximal,
    in order) and the bytes `kept`.

    A byte goes if a string of `length` bytes (even, 20 to 64 more than `GRAM`) covers it that also
    begins somewhere in a document with a smaller `doc_id`. Texts are judged as they came, not as
    they are after cuts. Reads `doc_id` and `text`; other columns are not touched. A null text is
    empty, a text shorter than `length` stays. Rows that repeat a doc_id are one another's equals:
    none makes the other go, and each is returned. A null doc_id is neither smaller nor larger, so
    such a row stays whole and removes nothing. An empty table gives an empty result. A long text is
    worked on whole, in one task.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    table, parts = _parts(texts, part_bytes)
    by_part = table.groupBy("part")
    often, most = _often(HOT_PIECES), HOT_PARTS * HOT_PIECES
    anchors = _anchors(length, parts, often)
    anchors = table.mapInArrow(anchors, "bucket bigint, part bigint, cut binary")
    keys = "part bigint, bucket bigint, keys binary"
    shared = by_group(anchors, ["bucket"], _shared(often, most), keys)
    pieces = by_part.cogroup(shared.groupBy("part")).applyInArrow(_shared_pieces(length, parts), _STRINGS)
    # Both of these read one shuffle of the pieces.
    asked = by_group(pieces, ["bucket"], _ask(HOT_PIECES), _TOLD)
    told = by_group(pieces, ["bucket"], _tell_first(HOT_PIECES), _TOLD)
    strings = by_part.cogroup(asked.groupBy("part")).applyInArrow(_asked_strings(length, parts), _STRINGS)
    told = told.union(by_group(strings, ["bucket"], _compare(length, group_bytes), _TOLD))
    return by_part.cogroup(told.groupBy("part")).applyInArrow(_cut(length), _KEPT)


def _parts(texts: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    """Texts written as a table bucketed by `part`, a few parts for each task that reads them, a
    bucket for each part; the number of parts."""
    spark = texts.sparkSession
    task = F.spark_partition_id()
    sizes = texts.groupBy(task.alias("task")).agg(F.sum(F.octet_length("text")).alias("bytes"))
    sizes = {row.task: row.bytes or 0 for row in sizes.collect()}  # a row for each task
    total, tasks = sum(sizes.values()), max(sizes, default=0) + 1
    cut = max(1, -(-max(sizes.values(), default=0) // part_bytes))
    if cut > MOST_CUTS:  # few tasks have most of the text
        tasks, cut = -(-total // part_bytes), 1
        texts = texts.repartition(tasks)
    parts = tasks * cut
    # A part has a number that Spark puts into a bucket of its own.
    numbers = spark.range(32 * parts).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("at"))
    numbers = numbers.groupBy("at").agg(F.min("id").alias("part"))
    at = F.pmod(task, F.lit(tasks)) * cut + F.pmod(F.monotonically_increasing_id(), F.lit(cut))
    dealt = texts.withColumn("at", at)
    dealt = dealt.join(F.broadcast(numbers), "at", "left")  # as many rows as parts
    name = f"repeats_{uuid.uuid4().hex}"
    (
        dealt.select("doc_id", "text", F.coalesce("part", F.lit(0)).alias("part"))
        .write.option("path", scratch_folder(spark, "repeats"))
        .option("compression", "zstd")
        .bucketBy(parts, "part")
        .format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name), parts
