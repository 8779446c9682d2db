"""Token ids in binary files with a minimal perfect hash index.

Files: one shard per range of doc_id, records in ascending doc_id order. A record is a header (doc_id
as int64, 1 if it is not null as uint8, number of ids as uint32), the ids as unsigned integers (16
bits if the vocabulary fits, else 32) and a newline byte; all little-endian. Spark's text writer
writes and commits the shards, so a task that runs again leaves no second copy.

Index: keys are dealt by hash into parts of about `KEYS_PER_PART`. Each part has a minimal perfect
hash (levels of bit arrays; a key's place is the first level where it stands alone, its slot the
number of bits before it) and by slot a 32-bit fingerprint, the shard, the byte offset, the ids
before it in the shard and its number of ids. A look-up reads one part and one slot.

A key is a doc_id and, where rows repeat an id, their number in file order from 0.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logscore.llm.stored import stored
from logscore.llm.words import buffer_of, by_run, mix
from logscore.session import scratch_folder

#: Text of one shard, about.
SHARD_BYTES = 16 << 20
KEYS_PER_PART = 100_000
#: Places of records that are broadcast, 32 bytes each.
BROADCAST_PLACES = 1_000_000
#: Bits of a level for each key that is left.
SPREAD = 2
#: Units that a process keeps with their ids, and bytes of the longest that is kept.
KEPT_UNITS = 400_000
KEPT_BYTES = 64

END_ID = 0
_HEADER = "<qBI"
_HEADER_BYTES = struct.calcsize(_HEADER)
_BLANK = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]"
#: White space before a space that white space or the end follows: there a cut could part a token.
_UNSAFE = f"{_BLANK} ({_BLANK}|$)"
#: White space beyond ASCII, and the bytes that characters of it may begin with.
_WIDE_BLANK = r"[\p{Z}\x{85}]"
_WIDE_FIRST = np.isin(np.arange(256), [0xC2, 0xE1, 0xE2, 0xE3])
#: White space of one byte other than the space and the line end.
_NARROW_BLANK = np.isin(np.arange(256), [0x09, *range(0x0B, 0x0E), *range(0x1C, 0x20)])
#: Marks that are cut from the word before them.
_MARKS = ".,;:!?"
_MARKED = r"\p{L}[.,;:!?]$"
_IS_MARK = np.isin(np.arange(256), list(_MARKS.encode()))
_IS_LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
_LINE_END = 0x0A
_UNITS_AT_ONCE = 512


class Units:
    """Units of text and their ids, in Arrow and numpy arrays; no Python object for each.

    When more than `limit` are kept, those that were not asked for again since the last time are
    forgotten, and where that leaves more than half, the older ones. Units of more than `KEPT_BYTES`
    bytes are not kept.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.units = pa.array([], pa.string())
        self.sizes = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")
        self.again = np.zeros(0, dtype=bool)

    def __len__(self) -> int:
        return len(self.units)

    def places(self, units: pa.Array) -> np.ndarray:
        """The number of each unit, or -1."""
        found = pc.fill_null(pc.index_in(units, value_set=self.units), -1).to_numpy()
        self.again[found[found >= 0]] = True
        return found.astype(np.int64)

    def add(self, units: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Keep new units with how many ids each has, and the ids."""
        short = pc.binary_length(units).to_numpy() <= KEPT_BYTES
        if not short.all():
            units, ids, sizes = units.filter(pa.array(short)), ids[np.repeat(short, sizes)], sizes[short]
        self.units = pa.concat_arrays([self.units, units])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])
        self.again = np.append(self.again, np.zeros(len(units), dtype=bool))
        if len(self) > self.limit:
            keep = np.flatnonzero(self.again)[-(self.limit // 2) :]
            starts = np.cumsum(self.sizes) - self.sizes
            self.units, self.ids = self.units.take(pa.array(keep)), self.ids[_ranges(starts[keep], self.sizes[keep])]
            self.sizes, self.again = self.sizes[keep], np.zeros(len(keep), dtype=bool)


class Encoder:
    """Encodes texts as the tokenizer does, but each word only once.

    Texts are cut before single spaces into words. The tokenizer's own pattern always begins a new
    token there, unless white space stands on both sides of a space; such texts are encoded whole.
    Words are cut into units. New units go to the tokenizer many at once, as one text, and its ids are
    dealt to the units by their lengths in bytes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        added = self.tokenizer.get_added_tokens_decoder()
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=np.int64)
        for token, i in vocabulary.items():  # a character of a byte-level token stands for a byte
            self.sizes[i] = len(token)
        for i, token in added.items():
            self.sizes[i] = len(token.content.encode())
        self.known = Units(KEPT_UNITS)
        self.marks = self._encoded(list(_MARKS))

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has, and the ids."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = [np.zeros(0, dtype="<u4"), *(np.array(x, dtype="<u4") for x in found)]
        return np.fromiter(map(len, found), np.int64, len(found)), np.concatenate(ids)

    def _encoded_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As `_encoded`, for units that begin with a space or a line end; many are encoded as one text."""
        data, offsets = buffer_of(units)
        sizes, ids = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype="<u4")]
        for begin in range(0, len(units), _UNITS_AT_ONCE):
            ends = offsets[begin + 1 : begin + 1 + _UNITS_AT_ONCE]
            text = data[offsets[begin] : ends[-1]].tobytes().decode()
            _, found = self._encoded([text])
            reached = np.cumsum(self.sizes[found]) + offsets[begin]
            cuts = np.searchsorted(reached, ends) + 1
            if len(found) == cuts[-1] and (reached[cuts - 1] == ends).all():
                counts = np.diff(cuts, prepend=0)
            else:
                counts, found = self._encoded(units.slice(begin, len(ends)).to_pylist())
            sizes.append(counts)
            ids.append(found)
        return np.concatenate(sizes), np.concatenate(ids)

    def _ids_of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different words that follow a space: where those of each begin, how many, and the ids.

        A word is cut before the line ends in it and before a mark that ends a part. Words with other
        white space, or at whose line ends more than one stands, are units whole; their names begin
        with the space. Other names do not: a unit that begins with a line end stands as it is, and all
        others follow a space.
        """
        odd = _odd_words(words)
        good, whole = words.filter(pa.array(~odd)), words.filter(pa.array(odd))
        counts, numbers, parts = _cut_words(good)
        names = pa.concat_arrays([parts, pc.binary_join_element_wise(" ", whole, "").cast(pa.string())])
        found = self.known.places(names)
        new = np.flatnonzero(found < 0)
        found[new] = len(self.known) + np.arange(len(new))
        joined, alone = (names.take(pa.array(x)) for x in (new[new < len(parts)], new[new >= len(parts)]))
        before = pc.if_else(pc.starts_with(joined, "\n"), "", " ")
        made = [
            self._encoded_units(pc.binary_join_element_wise(before, joined, "")),
            self._encoded(alone.to_pylist()),
        ]
        new_sizes, new_ids = (np.concatenate(x) for x in zip(*made, strict=True))
        sizes = np.concatenate([self.known.sizes, new_sizes, self.marks[0]])
        table = np.concatenate([self.known.ids, new_ids, self.marks[1]])
        self.known.add(pa.concat_arrays([joined, alone]), new_sizes, new_ids)
        # Marks are numbered behind the parts, and words that are units whole stand behind the others.
        marks = len(sizes) - len(_MARKS) + np.arange(len(_MARKS))
        numbers = np.append(np.append(found[: len(parts)], marks)[numbers], found[len(parts) :])
        starts = np.cumsum(sizes) - sizes
        bounds = np.cumsum(np.append(0, sizes[numbers]))
        bounds = bounds[np.cumsum(np.concatenate([[0], counts, np.ones(len(whole), dtype=np.int64)]))]
        order = np.append(np.flatnonzero(~odd), np.flatnonzero(odd))
        begins, lengths = np.empty((2, len(words)), dtype=np.int64)
        begins[order], lengths[order] = bounds[:-1], np.diff(bounds)
        return begins, lengths, table[_ranges(starts[numbers], sizes[numbers])]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; of a null none."""
        ids, counts = self.encode_column(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has; a null has none.

        Words are told apart by Arrow, and the ids of a word are copied to where it stands by numpy:
        Python touches no word by itself.
        """
        texts = pc.fill_null(texts, "")
        unsafe = pc.match_substring_regex(texts, _UNSAFE)
        whole = unsafe.to_numpy(zero_copy_only=False)
        words = pc.split_pattern(pc.if_else(unsafe, "", texts), " ")
        first = words.offsets.to_numpy().astype(np.int64)
        first -= first[0] if len(first) else 0
        flat = words.flatten()
        # The first word of a text has no space before it. It is no word like the others.
        heads = flat.take(pa.array(first[:-1])).to_pylist()
        rest = np.ones(len(flat), dtype=bool)
        rest[first[:-1]] = False
        coded = flat.filter(pa.array(rest)).dictionary_encode()
        begins, lengths, table = self._ids_of_words(coded.dictionary)
        # The heads are words behind the others.
        head_lengths, head_ids = self._encoded(heads)
        begins = np.append(begins, len(table) + np.cumsum(head_lengths) - head_lengths)
        lengths, table = np.append(lengths, head_lengths), np.append(table, head_ids)
        place = np.empty(len(flat), dtype=np.int32)
        place[rest] = coded.indices.to_numpy()
        place[first[:-1]] = len(coded.dictionary) + np.arange(len(heads))
        del words, flat, rest, coded
        lengths = lengths[place]
        ids = table[_ranges(begins[place], lengths)]
        bounds = np.cumsum(np.append(0, lengths))[first]
        if not whole.any():
            return ids, np.diff(bounds)
        wholes = self._encoded(texts.filter(unsafe).to_pylist())
        wholes = iter(np.split(wholes[1], np.cumsum(wholes[0])[:-1]))
        parts = [next(wholes) if whole[i] else ids[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        return np.concatenate(parts), np.array([len(part) for part in parts], dtype=np.int64)


def _odd_words(words: pa.Array) -> np.ndarray:
    """Which words are empty, have white space but line ends, or more than one where a line ends."""
    data, offsets = buffer_of(words)
    odd = np.diff(offsets) == 0
    line = data == _LINE_END
    bad = _NARROW_BLANK[data]
    bad[1:] |= line[1:] & line[:-1]
    edges = np.append(offsets[:-1][~odd], offsets[1:][~odd] - 1)
    bad[edges] |= line[edges]
    odd[np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1] = True
    maybe = np.unique(np.searchsorted(offsets, np.flatnonzero(_WIDE_FIRST[data]), side="right") - 1)
    wide = pc.match_substring_regex(words.take(pa.array(maybe)), _WIDE_BLANK)
    odd[maybe[wide.to_numpy(zero_copy_only=False)]] = True
    return odd


def _cut_words(words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Cut words that are not odd: how many units each has, the numbers of the units, and the units.

    Each mark is a unit, too, behind the others. Line ends stand at the beginning of units.
    """
    data, offsets = buffer_of(words)
    is_start = data == _LINE_END
    is_start[offsets[:-1]] = True
    starts = np.flatnonzero(is_start)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    last, before = data[ends - 1], data[ends - 2]
    marked = _IS_MARK[last] & (ends - starts > 1) & (_IS_LETTER[before] | (before >= 0x80))
    unsure = np.flatnonzero(marked & (before >= 0x80))
    if len(unsure):
        wide = _strings(data, np.append(starts, len(data))).take(pa.array(unsure))
        marked[unsure] = pc.match_substring_regex(wide, _MARKED).to_numpy(zero_copy_only=False)
    stays = np.ones(len(data), dtype=bool)
    stays[ends[marked] - 1] = False
    coded = _strings(data[stays], np.append(0, ends - np.cumsum(marked))).dictionary_encode()
    mark_numbers = np.zeros(256, dtype=np.int64)
    mark_numbers[list(_MARKS.encode())] = len(coded.dictionary) + np.arange(len(_MARKS))
    # Units stand in order, each with its mark behind it.
    at = np.cumsum(np.append(0, 1 + marked.astype(np.int64)))
    numbers = np.empty(int(at[-1]), dtype=np.int64)
    numbers[at[:-1]] = coded.indices.to_numpy()
    numbers[at[:-1][marked] + 1] = mark_numbers[last[marked]]
    counts = np.diff(at[np.searchsorted(starts, offsets)])
    return counts, numbers, coded.dictionary


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Texts that follow one another in `data`."""
    ends = pa.py_buffer(offsets.astype(np.int32))
    return pa.StringArray.from_buffers(len(offsets) - 1, ends, pa.py_buffer(np.ascontiguousarray(data)))


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] numbers, for all i."""
    before = np.cumsum(counts) - counts
    total = int(counts.sum())
    kind = np.int32 if max(total, starts.max(initial=0)) < 1 << 31 else np.int64
    found = np.repeat((starts - before).astype(kind), counts)
    found += np.arange(total, dtype=kind)
    return found


@lru_cache(maxsize=2)
def encoder_at(path: str) -> Encoder:
    return Encoder(path)


def _width(path: str) -> int:
    """Bytes of an id in the files."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    ids = [*content["model"]["vocab"].values(), *(x["id"] for x in content["added_tokens"])]
    return 2 if max(ids, default=0) < 1 << 16 else 4


@dataclass
class TokenStore:
    """Where the shards lie, bytes of an id, and what a scan of the shards found."""

    folder: str
    width: int
    records: DataFrame
    parts: int
    index: DataFrame


def write_shards(docs: DataFrame, tokenizer: str) -> str:
    """Encode all rows and write them in order of doc_id (nulls first); returns the folder."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    kind = np.dtype(f"<u{_width(tokenizer)}")
    end = np.array([END_ID], dtype=kind).tobytes()

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        records = []
        ids, counts = encoder_at(tokenizer).encode_column(run.column("text"))
        data, at = memoryview(ids.astype(kind).tobytes()), 0
        for doc_id, n in zip(run.column("doc_id").to_pylist(), counts.tolist(), strict=True):
            header = struct.pack(_HEADER, doc_id or 0, doc_id is not None, n + 1)
            records.append(b"".join((header, data[at : at + n * kind.itemsize], end)))
            at += n * kind.itemsize
        return pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["record"])

    folder = scratch_folder(docs.sparkSession, "token-shards")
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    records = ordered.mapInArrow(by_run(work), "record binary")
    records.select(F.col("record").cast("string")).write.text(folder)
    return folder


def _scan_shard(content: memoryview, width: int) -> Iterator[tuple]:
    """Records of a shard: id, number among equal ids, offset, ids before, ids."""
    at = before = repeat = 0
    last: tuple | None = None
    while at < len(content):
        doc_id, known, count = struct.unpack_from(_HEADER, content, at)
        doc_id = doc_id if known else None
        repeat = repeat + 1 if last == (doc_id,) else 0
        last = (doc_id,)
        yield doc_id, repeat, at, before, count
        before += count
        at += _HEADER_BYTES + count * width + 1


_RECORDS = "doc_id bigint, repeat bigint, shard int, at bigint, before bigint, n_tokens bigint"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The shards: their number and `content`."""
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("int").alias("shard")
    return spark.read.format("binaryFile").load(folder).select(number, "content")


def read_shards(spark: SparkSession, folder: str, width: int) -> DataFrame:
    """One row per record of the files."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _RECORDS.split(", ")]
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                rows = list(_scan_shard(memoryview(content.as_buffer()), width))
                columns = [list(x) for x in zip(*rows, strict=True)] or [[] for _ in range(5)]
                columns.insert(2, [shard] * len(rows))
                kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]
                arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return _files(spark, folder).mapInArrow(work, _RECORDS)


def _key_hash(ids: np.ndarray, repeats: np.ndarray, seed: int) -> np.ndarray:
    start = np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    return mix(mix(ids.astype(np.int64).view(np.uint64) + start) + repeats.view(np.uint64))


class PerfectHash:
    """A minimal perfect hash of distinct keys: slot numbers 0 to n - 1."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.ranks = np.cumsum(bits) - bits

    @classmethod
    def build(cls, ids: np.ndarray, repeats: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(ids):
            if len(sizes) > 200:
                raise ValueError("keys of an index must be distinct")
            size = max(8, SPREAD * len(ids))
            place = (_key_hash(ids, repeats, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = ~alone[place]
            ids, repeats = ids[left], repeats[left]
        return cls(sizes, np.concatenate([*levels, np.zeros(0, bool)]).astype(np.int64))

    def slots(self, ids: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key that was not among those built from, any slot or -1."""
        slots = np.full(len(ids), -1, dtype=np.int64)
        open_, base = np.arange(len(ids)), 0
        for level, size in enumerate(self.sizes):
            hashes = _key_hash(ids[open_], repeats[open_], level + 1)
            place = base + (hashes % np.uint64(size)).astype(np.int64)
            here = self.bits[place] > 0
            slots[open_[here]] = self.ranks[place[here]]
            open_, base = open_[~here], base + size
        return slots


def _fingerprints(ids: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    return (_key_hash(ids, repeats, 0) >> np.uint64(32)).astype(np.uint32)


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A null id is 0 with numbers below 0."""
    ids = table.column("doc_id").combine_chunks()
    repeats = table.column("repeat").to_numpy().astype(np.int64)
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy().astype(np.int64), np.where(null, -1 - repeats, repeats)


_ENTRY = np.dtype(
    [("finger", "<u4"), ("shard", "<i4"), ("at", "<i8"), ("before", "<i8"), ("n_tokens", "<u4")]
)
_FOUND = _RECORDS
_READ = "doc_id bigint, shard int, before bigint, n_tokens bigint, ids binary"
_DIGESTS = "doc_id bigint, shard int, before bigint, n_tokens bigint, ids_crc32 bigint"


def _part(parts: int):
    key = F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), "repeat")
    return F.pmod(key, F.lit(parts)).cast("int").alias("part")


def build_index(records: DataFrame, parts: int) -> DataFrame:
    """One row per part: level sizes, level bits and the slots' entries, as bytes."""

    def build(table: pa.Table) -> pa.Table:
        ids, repeats = _keys(table)
        made = PerfectHash.build(ids, repeats)
        entries = np.zeros(len(ids), dtype=_ENTRY)
        slots = made.slots(ids, repeats)
        entries["finger"][slots] = _fingerprints(ids, repeats)
        for name in ("shard", "at", "before", "n_tokens"):
            entries[name][slots] = table.column(name).to_numpy()
        return pa.table(
            {
                "part": pa.array([table.column("part")[0].as_py()], pa.int32()),
                "sizes": pa.array([made.sizes], pa.list_(pa.int64())),
                "bits": pa.array([np.packbits(made.bits.astype(bool)).tobytes()], pa.binary()),
                "entries": pa.array([entries.tobytes()], pa.binary()),
            }
        )

    dealt = records.select("doc_id", "repeat", "shard", "at", "before", "n_tokens", _part(parts))
    schema = "part int, sizes array<bigint>, bits binary, entries binary"
    return dealt.groupBy("part").applyInArrow(build, schema)


def look_up(keys: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """Where the record of each key (`doc_id`, `repeat`) lies; keys not in the index are left out
    (but one in 2^32, which its fingerprint does not tell apart)."""

    def find(wanted: pa.Table, part: pa.Table) -> pa.Table:
        if not wanted.num_rows or not part.num_rows:
            return pa.schema(
                [(n, pa.int32() if n == "shard" else pa.int64()) for n in names]
            ).empty_table()
        ids, repeats = _keys(wanted)
        sizes = part.column("sizes")[0].as_py()
        bits = np.frombuffer(part.column("bits")[0].as_py(), np.uint8)
        made = PerfectHash(sizes, np.unpackbits(bits)[: sum(sizes)].astype(np.int64))
        entries = np.frombuffer(part.column("entries")[0].as_py(), _ENTRY)
        slots = made.slots(ids, repeats)
        found = entries[slots]
        good = (slots >= 0) & (found["finger"] == _fingerprints(ids, repeats))
        result = wanted.select(["doc_id", "repeat"]).filter(pa.array(good))
        for name in names[2:]:
            kind = pa.int32() if name == "shard" else pa.int64()
            result = result.append_column(name, pa.array(found[name][good]).cast(kind))
        return result

    names = [x.split()[0] for x in _FOUND.split(", ")]
    dealt = keys.select("doc_id", "repeat", _part(parts))
    return dealt.groupBy("part").cogroup(index.groupBy("part")).applyInArrow(find, _FOUND)


def write_store(docs: DataFrame, tokenizer: str) -> TokenStore:
    """Write shards and index below the shared folder.

    Reads `doc_id` and `text`; other columns are not touched. A null or empty text has the end id alone; a null doc_id is a key
    like others and comes first; repeated ids are told apart by their number in file order (by text).
    A very long text is worked on alone. An empty table gives a store without records.
    """
    spark = docs.sparkSession
    width = _width(tokenizer)
    folder = write_shards(docs, tokenizer)
    records = stored(read_shards(spark, folder, width), "token-records")
    parts = max(1, -(-records.count() // KEYS_PER_PART))
    return TokenStore(
        folder, width, records, parts, stored(build_index(records, parts), "token-index")
    )


def _payloads(content: memoryview, places: dict, width: int) -> Iterator[tuple]:
    """`doc_id`, ids before, and the ids of the records at the given places of a shard."""
    fields = ("doc_id", "at", "before", "n_tokens")
    for doc_id, at, before, count in zip(*(places[x] for x in fields), strict=True):
        written, known, n = struct.unpack_from(_HEADER, content, at)
        if n != count or known != (doc_id is not None) or (known and written != doc_id):
            raise ValueError(f"the index and the file disagree about document {doc_id}")
        begin = at + _HEADER_BYTES
        yield doc_id, before, np.frombuffer(content, f"<u{width}", count, begin)


def _located(store: TokenStore, keys: DataFrame) -> DataFrame:
    """One row per shard with the places of the records that keys have in it."""
    located = look_up(keys, store.index, store.parts)
    place = F.struct("at", "doc_id", "before", "n_tokens")
    grouped = located.groupBy("shard").agg(F.sort_array(F.collect_list(place)).alias("places"))
    fields = {x: F.col(f"places.{x}") for x in ("doc_id", "at", "before", "n_tokens")}
    return stored(grouped.select("shard", *(c.alias(x) for x, c in fields.items())), "token-places")


def read_payloads(store: TokenStore, keys: DataFrame, digests: bool = False) -> DataFrame:
    """The records of keys (`doc_id`, `repeat`), read from the files at the places the index gives:
    `doc_id`, `shard`, ids `before` it in the shard, `n_tokens` and the `ids` as 32-bit integers, or
    instead of them their `ids_crc32`.

    Places are one row for each shard. Up to `BROADCAST_PLACES` they are broadcast: then files go from
    their scan to the task that reads the records. Beyond, files and places are shuffled by shard. In
    both cases a shard is read once for all keys in it.
    """
    spark, width = keys.sparkSession, store.width
    schema = _DIGESTS if digests else _READ
    names = [x.split()[0] for x in schema.split(", ")]
    last = pa.int64() if digests else pa.binary()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                content = memoryview(batch.column("content")[i].as_buffer())
                places = {x: batch.column(x)[i].as_py() for x in ("doc_id", "at", "before", "n_tokens")}
                shard = batch.column("shard")[i].as_py()
                rows = []
                for doc_id, before, ids in _payloads(content, places, width):
                    ids = ids.astype("<u4").tobytes()
                    rows.append((doc_id, shard, before, len(ids) // 4, zlib.crc32(ids) if digests else ids))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), last]
                columns = zip(*rows, strict=True)
                arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
                if arrays:
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    places = _located(store, keys)
    if (places.agg(F.sum(F.size("at"))).first()[0] or 0) <= BROADCAST_PLACES:
        places = F.broadcast(places)
    joined = _files(spark, store.folder).join(places, "shard")
    return joined.mapInArrow(work, schema)


def read_store(store: TokenStore, ids: DataFrame) -> DataFrame:
    """`doc_id`, `start`, `n_tokens` and `ids_crc32` of all records of the given doc_ids.

    Each doc_id goes through the index to the places of its records, and each record is read from its
    file there. Shard bases are summed over one row per shard.
    """
    counted = ids.groupBy("doc_id").agg(F.count("*").alias("times"))
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)).alias("repeat")
    read = read_payloads(store, counted.select("doc_id", numbers), digests=True)
    totals = store.records.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    joined = read.join(bases, "shard")
    start = (F.col("base") + F.col("before")).alias("start")
    return joined.select("doc_id", start, "n_tokens", "ids_crc32")


def fetch(spark: SparkSession, store: TokenStore, ids: list[int]) -> dict[int, np.ndarray]:
    """The ids of a few documents, of repeated ones the first."""
    keys = spark.createDataFrame([(i, 0) for i in ids], "doc_id bigint, repeat bigint")
    rows = read_payloads(store, keys).collect()
    return {row.doc_id: np.frombuffer(bytes(row.ids), "<u4") for row in rows}
