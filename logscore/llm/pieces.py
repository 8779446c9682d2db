"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

The new words of a batch are put one after the other, and a suffix array of that text is built by
doubling. Every piece is looked up in it by binary search, all pieces at once; its range of suffixes
are its occurrences, the edges of a lattice. Edges are sorted by their place in the word and relaxed
from left to right, all words at once: an edge extends the segmentation that ends where it begins if
BPE would leave the two pieces side by side. BPE has one such segmentation for each prefix of a word,
so the result is that of merging, without merging.

Two pieces stay side by side if, undoing their merges from the last to the first, at no time the two
pieces at the border form a piece that would have been merged earlier.

Words begin with a space: no piece goes on past one. Pieces of spaces alone share one score, below
all others, so they are merged last, from left to right, in what the words have left of them. Encoded
words are kept in a bounded table of each process.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscore.llm.kept import Kept
from logscore.llm.words import by_run

SPACE = "▁"
#: Words of a generation of those that a process keeps.
KEPT_WORDS = 600_000
#: Pairs of pieces whose border was looked at lately.
KEPT_PAIRS = 1 << 20
#: Characters of new words that are indexed at once; a longer word is indexed alone.
BATCH_CHARS = 1 << 20

_NONE, _BEGIN, _UNKNOWN = -3, -2, -1
_NEVER = np.int64(1) << 40
_WORD = re.compile(f"{SPACE}?[^{SPACE}]+|{SPACE}")


class PieceModel:
    """The pieces of a model file; ranks order merges, single characters come before all."""

    def __init__(self, path: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        p = self.processor
        size = p.get_piece_size()
        self.pieces = [p.id_to_piece(i) for i in range(size)]
        special = [p.is_control(i) or p.is_unknown(i) or p.is_byte(i) for i in range(size)]
        normal = [i for i in range(size) if not special[i] and not p.is_unused(i)]
        if any(SPACE in self.pieces[i].lstrip(SPACE) for i in normal):
            raise ValueError("pieces that go on past a space are not supported")
        self.id_of = {self.pieces[i]: i for i in normal}
        self.spaces = {len(x): i for x, i in self.id_of.items() if not x.strip(SPACE)}
        blank = {i for n, i in self.spaces.items() if n > 1}
        merged = [i for i in normal if len(self.pieces[i]) > 1 and i not in blank]
        scores = {p.get_score(i) for i in merged}
        top = {p.get_score(i) for i in blank}
        if len(scores) < len(merged) or len(top) > 1 or scores and top and min(scores) < max(top):
            raise ValueError("pieces must have scores of their own, those of spaces the lowest")
        self.rank = np.full(size, -1, dtype=np.int64)
        merged.sort(key=lambda i: -p.get_score(i))
        self.rank[merged] = np.arange(len(merged))
        self.lengths = np.array([len(piece) for piece in self.pieces], dtype=np.int64)
        self.left = np.full(size, -1, dtype=np.int64)
        self.right = np.full(size, -1, dtype=np.int64)
        self._splits(merged)
        self.edges = np.array(
            [i for i in normal if len(self.pieces[i]) == 1 or self.left[i] >= 0], dtype=np.int64
        )
        # Characters of no piece are all alike; 0 ends a word.
        used = {ord(c) for i in self.edges.tolist() for c in self.pieces[i]}
        self.alphabet = np.array(sorted({0} | used), dtype=np.uint32)
        if len(self.alphabet) > 0xFFFC:
            raise ValueError("pieces of more than 65,532 different characters are not supported")
        self.symbol_of = {chr(c): i + 1 for i, c in enumerate(self.alphabet.tolist())}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if p.is_byte(i)}
        self.raw = [
            bytes([int(x[3:5], 16)]) if p.is_byte(i) else b"" if special[i]
            else x.replace(SPACE, " ").encode()
            for i, x in enumerate(self.pieces)
        ]
        self.raw[p.unk_id()] = " ⁇ ".encode()
        self.prefixed = p.normalize("a") == SPACE + "a"
        self.words = Kept(KEPT_WORDS)
        self._pair_keys = np.full(KEPT_PAIRS, -1, dtype=np.int64)
        self._pair_stays = np.zeros(KEPT_PAIRS, dtype=bool)

    def _splits(self, merged: list[int]) -> None:
        """The last merge of each piece, and all pairs that form a piece."""
        pairs: dict[int, int] = {}
        size = len(self.pieces)
        for i in merged:
            piece = self.pieces[i]
            for cut in range(1, len(piece)):
                a, b = self.id_of.get(piece[:cut]), self.id_of.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a * size + b] = i
        keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_keys, self.pair_piece = keys, np.array([pairs[k] for k in keys.tolist()])
        for i in merged:
            parts = [self.id_of.get(c) for c in self.pieces[i]]
            if None in parts:
                continue
            while len(parts) > 2:
                formed = [pairs.get(a * size + b) for a, b in zip(parts, parts[1:], strict=False)]
                if not any(formed):
                    break
                k = min((self.rank[x], k) for k, x in enumerate(formed) if x)[1]
                parts[k : k + 2] = [formed[k]]
            if len(parts) == 2 and pairs.get(parts[0] * size + parts[1]) == i:
                self.left[i], self.right[i] = parts

    def _stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves pieces a and b side by side."""
        stays = np.ones(len(a), dtype=bool)
        open_ = np.arange(len(a))
        limit = np.full(len(a), _NEVER)
        while len(open_):
            keys = a * len(self.pieces) + b
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            formed = np.where(
                self.pair_keys[at] == keys, self.rank[self.pair_piece[at]], _NEVER
            )
            refused = formed < limit
            stays[open_[refused]] = False
            on = ~refused & ((self.left[a] >= 0) | (self.left[b] >= 0))
            open_, a, b = open_[on], a[on], b[on]
            # Of the two, undo what was merged later; of equal ones the right one.
            undo_left = self.rank[a] > self.rank[b]
            limit = np.where(undo_left, self.rank[a], self.rank[b] + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return stays

    def stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * len(self.pieces) + b
        slot = (keys * 0x9E3779B1 >> 12) & (KEPT_PAIRS - 1)
        new = self._pair_keys[slot] != keys
        result = self._pair_stays[slot]
        if new.any():
            fresh, back = np.unique(keys[new], return_inverse=True)
            known = self._stays(fresh // len(self.pieces), fresh % len(self.pieces))
            result[new] = known[back]
            # Of new keys that meet in one slot one is kept, with its value.
            taken, first = np.unique(slot[new], return_index=True)
            self._pair_keys[taken] = keys[new][first]
            self._pair_stays[taken] = result[new][first]
        return result

    def _joined(self, ids: np.ndarray) -> np.ndarray:
        """Merge single spaces that stand side by side."""
        blank = np.flatnonzero(ids == self.spaces[1])
        if not (np.diff(blank) == 1).any():
            return ids
        parts, at = [], 0
        for run in np.split(blank, np.flatnonzero(np.diff(blank) != 1) + 1):
            parts += [ids[at : run[0]], np.array(self._spaces(len(run)), dtype="<u4")]
            at = run[-1] + 1
        return np.concatenate([*parts, ids[at:]])

    def _spaces(self, count: int) -> list[int]:
        """A run of spaces: the leftmost pair that forms a piece is merged first."""
        runs: list[int] = []
        for _ in range(count):
            runs.append(1)
            while len(runs) > 1 and runs[-2] + runs[-1] in self.spaces:
                runs[-2:] = [runs[-2] + runs[-1]]
        return [self.spaces[n] for n in runs]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The piece ids of each word."""
        text = "\0".join([*words, ""])
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bounds = np.cumsum([len(word) + 1 for word in words])
        starts = np.concatenate([[0], bounds[:-1]])
        symbols = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        symbols[self.alphabet[symbols] != points] = len(self.alphabet)
        place, piece = self._edges(symbols)
        # Single characters that are no piece
        single = np.zeros(len(points), dtype=bool)
        single[place[self.lengths[piece] == 1]] = True
        single[bounds - 1] = True
        unknown = np.flatnonzero(~single)
        place = np.concatenate([place, unknown])
        piece = np.concatenate([piece, np.full(len(unknown), _UNKNOWN)])
        lengths = np.where(piece == _UNKNOWN, 1, self.lengths[piece])
        # A word falls apart where no piece goes across; its parts are worked on side by side.
        reach = np.ones(len(points), dtype=np.int64)
        np.maximum.at(reach, place, lengths)
        reach += np.arange(len(points))
        apart = np.append(True, np.maximum.accumulate(reach)[:-1] <= np.arange(1, len(points)))
        del reach
        apart[bounds - 1] = False
        apart[starts] = True
        parts = np.flatnonzero(apart)
        first = np.searchsorted(parts, starts)
        last_of_word = np.repeat(bounds - 1, np.diff(np.append(first, len(parts))))
        ends = np.minimum(np.append(parts[1:], len(points)), last_of_word)
        offset = place - np.repeat(parts, np.diff(np.append(parts, len(points))))[place]
        order = np.argsort(offset, kind="stable")
        place, piece, lengths, offset = place[order], piece[order], lengths[order], offset[order]
        last = np.full(len(points) + 1, _NONE, dtype=np.int64)
        last[parts] = _BEGIN  # read in the first step, before a part that ends there writes it
        steps = np.searchsorted(offset, np.arange(offset[-1] + 2 if len(offset) else 1))
        for i, j in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
            before, own = last[place[i:j]], piece[i:j]
            good = before != _NONE
            check = np.flatnonzero((before >= 0) & (own >= 0))
            good[check] = self.stays(before[check], own[check])
            last[place[i:j][good] + lengths[i:j][good]] = own[good]
        return self._collect(text, first, parts, ends, last)

    def _edges(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and piece ids of all occurrences of pieces."""
        count = len(symbols)
        longest = int(self.lengths[self.edges].max())
        levels = -(-longest // 4)
        padded = np.zeros(count + 4 * levels + 4, dtype=np.uint64)
        padded[:count] = symbols + 1
        packed = np.zeros(count + 4 * levels, dtype=np.uint64)
        for k in range(4):
            packed = (packed << np.uint64(16)) | padded[k : k + len(packed)]
        suffixes = _suffixes(packed[:count], 4, longest)

        # Pieces whose characters all occur, as symbols
        occurs = np.zeros(len(self.alphabet) + 2, dtype=bool)
        occurs[symbols + 1] = True
        ids, keys = [], []
        for i in self.edges.tolist():
            row = [self.symbol_of[c] for c in self.pieces[i]]
            if all(occurs[x] for x in row):
                ids.append(i)
                keys.append(row + [0] * (4 * levels - len(row)))
        if not ids:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        table = np.array(keys, dtype=np.uint64)
        first = _search(packed, suffixes, _pack(table))
        end = _search(packed, suffixes, _pack(np.where(table == 0, np.uint64(0xFFFF), table)))
        ids, counts = np.array(ids), end - first
        index = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return suffixes[np.repeat(first, counts) + index], np.repeat(ids, counts)

    def _collect(
        self,
        text: str,
        first: np.ndarray,
        starts: np.ndarray,
        ends: np.ndarray,
        last: np.ndarray,
    ) -> list[list[int]]:
        """Read the pieces of all parts from their ends back; `first` are the first parts of words."""
        rows, found = [], []
        open_, at = np.flatnonzero(ends > starts), ends[ends > starts]
        while len(open_):
            own = last[at]
            if (own == _NONE).any():
                raise ValueError("a word without a segmentation")
            rows.append(open_)
            found.append(np.where(own == _UNKNOWN, -at, own))
            at = at - np.where(own == _UNKNOWN, 1, self.lengths[own])
            on = at > starts[open_]
            open_, at = open_[on], at[on]
        if not rows:
            return [[] for _ in first]
        row, piece = np.concatenate(rows[::-1]), np.concatenate(found[::-1])
        order = np.argsort(row, kind="stable")
        row, piece = row[order], piece[order]
        cuts = np.searchsorted(row, np.append(first, len(starts)))
        listed = piece.tolist()
        result = [listed[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for i in np.unique(np.searchsorted(first, row[piece < 0], side="right") - 1).tolist():
            ids = []
            for x in result[i]:  # a character that is no piece is spelled in bytes
                if x >= 0:
                    ids.append(x)
                    continue
                char = text[-x - 1].encode("utf-8", "surrogatepass")
                spelled = [self.bytes.get(byte) for byte in char]
                ids += [self.processor.unk_id()] if None in spelled else spelled
            result[i] = ids
        return result

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """The ids of each text; of a null none."""
        cut = [_WORD.findall(self.processor.normalize(text)) if text else [] for text in texts]
        self.words.turn()
        new = list(self.words.missing(set(chain.from_iterable(cut))))
        begin = size = 0
        for i, word in enumerate([*new, None]):
            if word is None or size + len(word) > BATCH_CHARS and i > begin:
                part = new[begin:i]
                for x, ids in zip(part, self.encode_words(part) if part else (), strict=True):
                    self.words[x] = np.array(ids, dtype="<u4").tobytes()
                begin, size = i, 0
            size += len(word or "") + 1
        known = self.words.__getitem__
        result = [np.frombuffer(b"".join(map(known, words)), dtype="<u4") for words in cut]
        return [self._joined(ids) for ids in result] if len(self.spaces) > 1 else result

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefixed and text.startswith(" ") else text


def _suffixes(packed: np.ndarray, sorted_by: int, wanted: int) -> np.ndarray:
    """Suffixes in the order of their first `wanted` symbols, by doubling."""
    rank = np.unique(packed, return_inverse=True)[1].astype(np.int64)
    while sorted_by < wanted:
        later = np.full(len(rank), -1, dtype=np.int64)
        later[: max(len(rank) - sorted_by, 0)] = rank[sorted_by:]
        rank = np.unique(rank * (len(rank) + 1) + later + 1, return_inverse=True)[1]
        sorted_by *= 2
    return np.argsort(rank, kind="stable")


def _pack(table: np.ndarray) -> list[np.ndarray]:
    result = []
    for level in range(0, table.shape[1], 4):
        value = np.zeros(len(table), dtype=np.uint64)
        for k in range(4):
            value = (value << np.uint64(16)) | table[:, level + k]
        result.append(value)
    return result


def _search(packed: np.ndarray, suffixes: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    """How many suffixes come before each key, by binary search for all keys at once."""
    low = np.zeros(len(keys[0]), dtype=np.int64)
    high = np.full(len(keys[0]), len(suffixes), dtype=np.int64)
    while (low < high).any():
        middle = (low + high) >> 1
        at = suffixes[np.minimum(middle, len(suffixes) - 1)]
        less, same = np.zeros(len(low), dtype=bool), np.ones(len(low), dtype=bool)
        for level, key in enumerate(keys):
            value = packed[at + 4 * level]
            less |= same & (value < key)
            same &= value == key
        open_ = low < high
        low, high = np.where(open_ & less, middle + 1, low), np.where(open_ & ~less, middle, high)
    return low


@lru_cache(maxsize=2)
def model_at(path: str) -> PieceModel:
    """Loaded once in each process."""
    return PieceModel(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `ids` (array<int>) of each row; a null or empty text has no ids.

    Reads `doc_id` and `text`; other columns are not touched. Repeated rows are all returned, with the
    same ids; there are no ties, as BPE has one segmentation. An empty table gives an empty result, a
    very long text is worked on alone.
    """

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        ids = model_at(path).encode(run.column("text").to_pylist())
        lengths = np.cumsum([0, *map(len, ids)], dtype=np.int32)
        values = np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32)
        arrays = [run.column("doc_id"), pa.ListArray.from_arrays(lengths, pa.array(values))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "ids"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(by_run(work), "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `text` of rows of `encode_documents`; null ids give an empty text."""

    def work(batches):
        model = model_at(path)
        for batch in batches:
            texts = [model.decode(np.array(x or (), int)) for x in batch.column("ids").to_pylist()]
            arrays = [batch.column("doc_id"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """`doc_id`, `n_pieces`, `ids_crc32` (of the ids as little-endian 32-bit numbers) and `same`,
    whether the ids decode to the text. A null counts as empty; otherwise as `encode_documents`."""

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        model, texts = model_at(path), run.column("text").to_pylist()
        ids = model.encode(texts)
        same = [model.decode(x) == text for x, text in zip(ids, texts, strict=True)]
        arrays = [
            run.column("doc_id"),
            pa.array(map(len, ids), pa.int64()),
            pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
            pa.array(same, pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays(
            arrays, names=["doc_id", "n_pieces", "ids_crc32", "same"]
        )

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id bigint, n_pieces bigint, ids_crc32 bigint, same boolean"
    return rows.mapInArrow(by_run(work), schema)
