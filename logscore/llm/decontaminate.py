"""Benchmark decontamination: test n-grams as a broadcast hash set, scanned over training windows.

The windows of the benchmark (13 words; a shorter item is one window) are hashed on the driver and
broadcast as sorted arrays beside its words, about eight times its size. A benchmark above `PART_BYTES`
is worked on in parts of about that size, one pass over the documents each, and one after the other,
so that what is broadcast never grows with it. Hash hits are verified word by word. Documents are
never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscore.llm.stored import stored
from logscore.llm.words import ALNUM, HashIndex, Words, buffer_of, by_run, counts_by_text, words_of

WINDOW = 13
#: Text of the benchmark that is broadcast at once.
PART_BYTES = 32 << 20


class Windows:
    """The windows of some items: their words once, and by window size the sorted hashes with the
    word at which each window begins. About eight times as large as the texts, pickled."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        """Items without words have no window; an item without an id counts in no list of items."""
        self.ids = [item_id for item_id, _ in items]
        words = words_of(pa.array([text for _, text in items], pa.string()), ALNUM)
        counts = np.diff(words.first)
        self.first = words.first
        self.index: dict[int, HashIndex] = {}
        self._hashes: dict[int, np.ndarray] = {}
        self._begins: dict[int, np.ndarray] = {}
        for size in np.unique(np.minimum(counts[counts > 0], WINDOW)).tolist():
            hashes, fits = words.window_hashes(size)
            if size < WINDOW:  # whole items of that size
                begins = words.first[:-1][counts == size]
            else:
                begins = np.flatnonzero(fits)
            order = np.argsort(hashes[begins], kind="stable")
            self._begins[size] = begins[order].astype(np.int32 if len(hashes) < 1 << 31 else np.int64)
            self._hashes[size] = hashes[begins][order]
            self.index[size] = HashIndex(self._hashes[size])
        small = np.int32 if len(words.data) < 1 << 31 else np.int64
        starts, ends = words.starts.astype(small), words.ends.astype(small)
        self.words = Words(words.data, starts, ends, words.first, np.zeros(0, np.uint64))

    def items(self, hashes: np.ndarray, size: int, texts: Callable[[int], bytes]) -> list[set | None]:
        """For each hash the items that have the window `texts(i)`, None if it is no window."""
        known, begins = self._hashes[size], self._begins[size]
        low = np.searchsorted(known, hashes).tolist()
        high = np.searchsorted(known, hashes, side="right").tolist()
        found: list[set | None] = []
        for i, (a, b) in enumerate(zip(low, high, strict=True)):
            text = texts(i)
            same = [x for x in begins[a:b].tolist() if self.words.text(x, x + size) == text]
            owners = np.searchsorted(self.first, same, side="right") - 1
            named = {self.ids[x] for x in owners.tolist()} - {None}
            found.append(named if same else None)
        return found


def _parts(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // PART_BYTES)
    for part in range(parts):
        chosen = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part
        yield [tuple(row) for row in items.where(chosen).collect()]


def _find(words: Words, windows: Windows) -> tuple[np.ndarray, list[set[int]]]:
    """Which words are hit, and the items found in each text."""
    marks = np.zeros(len(words.hashes) + 1, dtype=np.int32)
    found: list[set[int]] = [set() for _ in words.first[1:]]
    for size, known in windows.index.items():
        hashes, fits = words.window_hashes(size)
        places = known.places(hashes)
        places = places[fits[places]]
        texts = np.searchsorted(words.first, places, side="right") - 1
        starts = places.tolist()
        owners = windows.items(
            hashes[places], size, lambda i, at=starts, n=size: words.text(at[i], at[i] + n)
        )
        for place, text, items in zip(starts, texts.tolist(), owners, strict=True):
            if items is not None:
                marks[place] += 1
                marks[place + size] -= 1
                found[text].update(items)
    return np.cumsum(marks[:-1]) > 0, found


def _spans(words: Words, hit: np.ndarray) -> list[list[tuple[int, int]]]:
    """Runs of hit words of each text: first word and the one after the last."""
    spans: list[list[tuple[int, int]]] = []
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        edges = np.flatnonzero(np.diff(hit[begin:end].astype(np.int8), prepend=0, append=0))
        spans.append(list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)))
    return spans


_SCANNED = (
    "doc_id bigint, n_words bigint, spans array<struct<first:bigint,end:bigint>>, "
    "items array<bigint>"
)
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _scan_run(windows: Windows, run: pa.RecordBatch) -> pa.RecordBatch:
    words = words_of(run.column("text"), ALNUM)
    hit, found = _find(words, windows)
    spans = [[{"first": a, "end": b} for a, b in text] for text in _spans(words, hit)]
    return pa.RecordBatch.from_arrays(
        [
            run.column("doc_id"),
            pa.array(np.diff(words.first), pa.int64()),
            pa.array(spans, _SPANS),
            pa.array([sorted(items) for items in found], pa.list_(pa.int64())),
        ],
        names=["doc_id", "n_words", "spans", "items"],
    )


def _mapped(docs: DataFrame, windows: Windows, work: Callable, schema) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    return docs.mapInArrow(by_run(lambda run: work(shared.value, run)), schema)


def scan(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: `n_words`, the spans of hit words, the items found in it.

    Reads `doc_id` and `text`, and `item_id` and `text` of the benchmark; other columns are not
    touched. A null or empty text has no words; an item without words has no window; an item with a
    null id hits but is in no list. Repeated rows are all returned, each with its result. An empty
    benchmark hits nothing, an empty table gives an empty result. A very long text is a run of its
    own.
    """
    rows = docs.select("doc_id", "text")
    parts = _parts(benchmark)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        return _mapped(rows, Windows(first), _scan_run, _SCANNED)
    # One pass for each part; the rows of a document are told apart by a number kept in a table.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "scan-rows")
    merged = _scan_parts(rows.select("row", "text"), [first, second], parts)
    return rows.select("row", "doc_id").join(merged, "row").drop("row")


def _scan_parts(rows: DataFrame, begun: list, parts: Iterator) -> DataFrame:
    """What `scan` gives, by `row`, for a benchmark in several parts."""
    rows = rows.select(F.col("row").alias("doc_id"), "text")
    # Each pass is written before the next part is broadcast.
    passes = [
        stored(_mapped(rows, Windows(part), _scan_run, _SCANNED), "scan-part")
        for part in chain(begun, parts)
    ]
    found = reduce(DataFrame.union, passes)
    merged = found.groupBy(F.col("doc_id").alias("row")).agg(
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.withColumn("spans", _merged_spans("spans"))


def _merged_spans(spans: str):
    """Spans as a sorted list in which no two touch."""

    def step(done, span):
        last = F.try_element_at(done, F.lit(-1))
        end = F.greatest(last["end"], span["end"])
        joined = F.struct(last["first"].alias("first"), end.alias("end"))
        kept = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        touches = F.coalesce(last["end"] >= span["first"], F.lit(False))
        joined = F.concat(kept, F.array(joined))
        return F.when(touches, joined).otherwise(F.concat(done, F.array(span)))

    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    return F.aggregate(F.array_sort(spans), none, step)


def digest(scanned: DataFrame) -> DataFrame:
    """`n_hit`, `n_items`, `items_sha256` and `contaminated` of what `scan` found."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["first"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    counted = scanned.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
    )
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return counted.withColumn("contaminated", contaminated)


def _without_spans(
    text: bytes, words: Words, first: int, spans: list[tuple[int, int]], base: int
) -> bytes:
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : words.starts[first + a] - base])
        at = words.ends[first + b - 1] - base
    return b"".join([*kept, text[at:]])


def _clean_run(how: str, windows: Windows, run: pa.RecordBatch) -> pa.RecordBatch:
    words = words_of(run.column("text"), ALNUM)
    hit, _ = _find(words, windows)
    n_hit = counts_by_text(words, hit)
    if how == "documents":
        return run.filter(pa.array(~((n_hit > 0) & (20 * n_hit >= np.diff(words.first)))))
    data, offsets = buffer_of(run.column("text"))
    texts = run.column("text").to_pylist()
    spans = _spans(words, hit)
    for i in np.flatnonzero(n_hit).tolist():
        whole = data[offsets[i] : offsets[i + 1]].tobytes()
        left = _without_spans(whole, words, int(words.first[i]), spans[i], int(offsets[i]))
        texts[i] = left.decode("utf-8", "replace")
    at = run.schema.get_field_index("text")
    return run.set_column(at, run.schema.field(at), pa.array(texts, run.column("text").type))


def _cut_run(run: pa.RecordBatch) -> pa.RecordBatch:
    """The rows in `whole` with their `spans` cut out of their text."""
    words = words_of(run.column("text"), ALNUM)
    data, offsets = buffer_of(run.column("text"))
    texts = run.column("text").to_pylist()
    for i, spans in enumerate(run.column("spans").to_pylist()):
        if spans:
            whole = data[offsets[i] : offsets[i + 1]].tobytes()
            pairs = [(span["first"], span["end"]) for span in spans]
            left = _without_spans(whole, words, int(words.first[i]), pairs, int(offsets[i]))
            texts[i] = left.decode("utf-8", "replace")
    rows = pa.RecordBatch.from_struct_array(run.column("whole"))
    at = rows.schema.get_field_index("text")
    return rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.column(at).type))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """`docs` without what it shares with the benchmark; all columns pass through.

    `remove="documents"` drops each document of which at least a twentieth of the words is hit;
    "spans" keeps all documents and cuts the hit words, with what stands between them, out of their
    text. Null and empty texts stay, whatever other columns there are and are named. An empty benchmark
    removes nothing, an empty table gives an empty result.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove!r}")
    parts = _parts(benchmark)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        return _mapped(docs, Windows(first), partial(_clean_run, remove), docs.schema)
    rows = docs.select(F.struct("*").alias("whole"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "scan-rows")
    merged = _scan_parts(rows.select("row", "whole.text"), [first, second], parts)
    if remove == "spans":  # cut once, when the hits of all parts are known
        cut = rows.join(merged.select("row", "spans"), "row", "left")
        cut = cut.select("whole", F.col("whole.text").alias("text"), "spans")
        return cut.mapInArrow(by_run(_cut_run), docs.schema)
    found = digest(merged.withColumn("doc_id", F.col("row"))).where("contaminated")
    found = found.select(F.col("doc_id").alias("row"))
    return rows.join(found, "row", "left_anti").select("whole.*")
