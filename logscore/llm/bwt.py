"""Burrows-Wheeler transforms of shards of strings and their merge by interleave refinement.

A shard's transform comes from sorting its own suffixes. Shards are merged without sorting suffixes
again (Holt and McMillan 2014): an interleave of the shards that is sorted by the first d bytes of
the suffixes becomes one sorted by the first d + 1 when its rows are dealt stably by the byte before
each suffix, which the transforms hold. Where a run of equal prefixes splits, the common prefix with
the row before is that short; rows not split after `length` bytes have `length` bytes in common.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SYMBOL_BITS = 9  # a byte, or the end of a string, which sorts first
_FIRST = 7  # symbols that fit a 64-bit key


@dataclass
class Shard:
    """The transform of some strings. Row r is the r-th smallest suffix; `before` is the symbol in
    front of it (byte + 1; 0 in front of a whole string), `step` the row of the suffix with that
    symbol, `place` where the suffix begins in the shard's text, ends of strings included, and `ends`
    the rows of the empty suffixes, by string."""

    before: np.ndarray
    step: np.ndarray
    place: np.ndarray
    ends: np.ndarray


def with_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all strings with an end after each, and where the strings begin among them."""
    count = len(offsets) - 1
    begins = offsets[:-1] + np.arange(count)
    text = np.zeros(len(data) + count, dtype=np.uint16)
    inside = np.ones(len(text), dtype=bool)
    inside[offsets[1:] + np.arange(count)] = False
    text[inside] = data.astype(np.uint16) + 1
    return text, begins


def transform(data: np.ndarray, offsets: np.ndarray) -> Shard:
    """The transform of the strings `data[offsets[i]:offsets[i + 1]]`; none may be empty.

    Equal suffixes of different strings are in the order of the strings.
    """
    text, begins = with_ends(data, offsets)
    size = len(text)
    left = np.repeat(np.append(begins[1:], size), np.diff(offsets) + 1) - np.arange(size)
    key, alive = text.astype(np.int64), text != 0
    for i in range(1, _FIRST):
        symbol = np.zeros(size, dtype=np.int64)
        symbol[: max(size - i, 0)] = text[i:]
        symbol[~alive] = 0
        key = (key << _SYMBOL_BITS) | symbol
        alive &= symbol != 0
    done = _FIRST
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(size, dtype=np.int64)
        rank[order] = np.cumsum(np.append(True, ranked[1:] != ranked[:-1]))
        if done >= left.max(initial=0) or rank[order[-1]] == size:
            order = np.argsort(rank * size + np.arange(size))
            break
        further = np.zeros(size, dtype=np.int64)
        further[: max(size - done, 0)] = rank[done:]
        further[left <= done] = 0
        key = rank * (size + 1) + further
        done *= 2
    row = np.empty(size, dtype=np.int64)
    row[order] = np.arange(size)
    earlier = order - 1
    earlier[row[begins]] = 0
    before = text[earlier]
    before[row[begins]] = 0
    return Shard(before, row[earlier], order, row[np.append(begins[1:], size) - 1])


def merge(shards: list[Shard], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave shards by the first `length` (even) bytes of their suffixes.

    Returns the rows, numbered through all shards one after the other, in merged order, and the
    places in it at which a run of suffixes with `length` bytes in common begins. Suffixes that end
    earlier are runs of their own. Strings must have two bytes at least. Two bytes are refined at a
    time, by one stable sort of 16-bit numbers.
    """
    if length % 2:
        raise ValueError(f"length must be even, not {length}")
    sizes = np.cumsum([0, *(len(s.before) for s in shards)])
    before = np.concatenate([s.before for s in shards])
    step = np.concatenate([s.step + at for s, at in zip(shards, sizes, strict=False)])
    ends = np.concatenate([s.ends + at for s, at in zip(shards, sizes, strict=False)])
    if not len(before):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    symbols = np.unique(before)
    # 256 symbols and the end would need more than 16 bits for two; text in UTF-8 has fewer.
    wide = np.uint16 if len(symbols) <= 256 else np.uint32
    base = 256 if wide is np.uint16 else 512
    code = np.searchsorted(symbols, before).astype(wide)
    pair = code[step] * wide(base) + code
    pair[(code == 0) | (code[step] == 0)] = 0  # these go on as an end, which has its place already
    twice = step[step].astype(np.int32 if len(before) < 1 << 31 else np.int64)
    count = len(ends)
    end_pairs = code[ends] * wide(base)
    order, run = np.arange(len(before), dtype=twice.dtype), np.zeros(len(before), dtype=twice.dtype)
    end_rows, end_twice = ends.astype(twice.dtype), step[ends].astype(twice.dtype)
    end_runs = -1 - np.arange(count, dtype=twice.dtype)
    head = np.arange(count, dtype=twice.dtype)
    for _ in range(length // 2):
        pairs = np.concatenate([end_pairs, pair[order]])
        dealt = np.argsort(pairs, kind="stable")[2 * count :]
        pairs = pairs[dealt]
        runs = np.concatenate([end_runs, run])[dealt]
        order = np.concatenate([end_rows, np.concatenate([end_twice, twice[order]])[dealt]])
        new = np.append(True, (pairs[1:] != pairs[:-1]) | (runs[1:] != runs[:-1]))
        run = np.concatenate([head, np.cumsum(new, dtype=twice.dtype) + (count - 1)])
    starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    return order, starts
