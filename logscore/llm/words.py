"""Words of many texts at once: positions and 64-bit hashes from the bytes of an Arrow column.

Texts are cut at bytes, never decoded. Word hashes are polynomials over the bytes with wrap-around
64-bit arithmetic, so a batch needs a few passes of numpy and no loop over words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in runs of about this many bytes; a longer text is a run of its own.
RUN_BYTES = 4 << 20

_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse
_STEP = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1


def _powers(base: int, count: int) -> np.ndarray:
    values = np.full(count, base & _MASK, dtype=np.uint64)
    values[0] = 1
    return np.cumprod(values, dtype=np.uint64)


class _Powers:
    """base ** exponent modulo 2 ** 64 for arrays of exponents."""

    def __init__(self, base: int):
        self.base = base
        self.low = _powers(base, _CHUNK)
        self.high = np.ones(1, dtype=np.uint64)

    def __call__(self, exponents: np.ndarray) -> np.ndarray:
        high = exponents >> 20
        most = int(high[-1]) + 1 if len(high) else 1  # exponents ascend
        if most > len(self.high):
            self.high = _powers(pow(self.base, _CHUNK, 1 << 64), most)
        return self.low[exponents & (_CHUNK - 1)] * self.high[high]


_tables: dict[str, _Powers] = {}


def _power(name: str) -> _Powers:
    """The power tables, made on first use in each process."""
    if not _tables:
        for key, base in (("base", _BASE), ("step", _STEP)):
            _tables[key] = _Powers(base)
            _tables[f"{key}_inverse"] = _Powers(pow(base, -1, 1 << 64))
    return _tables[name]


def _class_table(separators: str) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators.encode("latin-1"))] = False
    return table


def _span(first: int, last: int) -> str:
    return "".join(map(chr, range(first, last + 1)))


#: Bytes of words split by white space: `[^\x20\x09-\x0D]+`.
SPACED = _class_table(" " + _span(0x09, 0x0D))
#: Bytes of words of letters and digits: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
ALNUM = _class_table(_span(0, 0x2F) + _span(0x3A, 0x60) + _span(0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins and ends; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, pa.scalar("", column.type))
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        return data[:0], np.zeros(1, dtype=np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of a run of texts. `first[i]:first[i + 1]` are the words of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def of_word(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def window_hashes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of `size` words in a row by their first word; where the windows fit their text."""
        count = len(self.hashes) - size + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        index = np.arange(len(self.hashes), dtype=np.int64)
        sums = np.zeros(len(self.hashes) + 1, dtype=np.uint64)
        np.cumsum(self.hashes * _power("step")(index), out=sums[1:])
        back = _power("step_inverse")(index[:count])
        ends = self.first[1:]
        lasts = np.maximum(ends - size + 1, self.first[:-1])
        marks = np.zeros(len(self.hashes) + 1, dtype=np.int32)
        np.add.at(marks, self.first[:-1], 1)
        np.add.at(marks, lasts, -1)
        fits = np.cumsum(marks)[:count] > 0
        return mix((sums[size:] - sums[:count]) * back + np.uint64(size)), fits

    def text(self, first: int, last: int) -> bytes:
        """Words first to last - 1 with single spaces between."""
        return b" ".join(
            self.data[a:b].tobytes()
            for a, b in zip(self.starts[first:last], self.ends[first:last], strict=True)
        )


def words_of(column: pa.Array, kind: np.ndarray, lower: bool = True) -> Words:
    """Cut texts into words of the byte class `kind`; `lower` lower-cases A-Z first."""
    data, offsets = buffer_of(column)
    data = _LOWER[data] if lower else data
    size = len(data)
    inside = kind[data]
    edges = offsets[:-1][offsets[:-1] < size]
    before = np.zeros(size, dtype=bool)
    before[1:] = inside[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(size, dtype=bool)
    after[:-1] = inside[1:]
    after[edges[edges > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(starts), dtype=np.uint64)
    low = _power("base").low
    for begin in range(0, size, _CHUNK):
        end = min(begin + _CHUNK, size)
        values = np.where(inside[begin:end], data[begin:end].astype(np.uint64) + np.uint64(1), 0)
        values = values.astype(np.uint64) * low[: end - begin]
        shift = np.uint64(pow(_BASE, begin, 1 << 64))
        i, j = np.searchsorted(starts, (begin, end))
        head = (starts[i] if i < j else end) - begin
        if i and head:  # the rest of a word that began in an earlier chunk
            sums[i - 1 : i] += values[:head].sum(keepdims=True, dtype=np.uint64) * shift
        if i < j:
            sums[i:j] += np.add.reduceat(values, starts[i:j] - begin) * shift
    hashes = mix(sums * _power("base_inverse")(starts))
    return Words(data, starts, ends, np.searchsorted(starts, offsets), hashes)


def runs(batch: pa.RecordBatch, column: str, limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about `limit` bytes of text each."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    total = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def by_run(
    work: Callable[[pa.RecordBatch], pa.RecordBatch], column: str = "text", limit: int = RUN_BYTES
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for `mapInArrow` that applies `work` to each run."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in runs(batch, column, limit):
                yield work(run)

    return apply


class HashIndex:
    """Finds which of many hashes are in a given set; most are turned away by one bit."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        size = max(16, int(len(self.hashes) * 64).bit_length())
        self._mask = np.uint64((1 << size) - 1)
        low = self.hashes & self._mask
        self._bits = np.zeros(1 << (size - 3), dtype=np.uint8)  # eight to a byte
        np.bitwise_or.at(self._bits, low >> np.uint64(3), self._bit(low))

    @staticmethod
    def _bit(low: np.ndarray) -> np.ndarray:
        return np.uint8(1) << (low & np.uint64(7)).astype(np.uint8)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where in `hashes` a member stands."""
        low = hashes & self._mask
        maybe = np.flatnonzero(self._bits[low >> np.uint64(3)] & self._bit(low))
        if not len(maybe):
            return maybe
        found = np.searchsorted(self.hashes, hashes[maybe])
        found[found == len(self.hashes)] = 0
        return maybe[self.hashes[found] == hashes[maybe]]


def counts_by_text(words: Words, marked: np.ndarray) -> np.ndarray:
    """How many words of each text are marked."""
    sums = np.zeros(len(marked) + 1, dtype=np.int64)
    np.cumsum(marked, out=sums[1:])
    return sums[words.first[1:]] - sums[words.first[:-1]]
