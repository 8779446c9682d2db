"""Language ID: prediction by partial matching over bytes.

Each language has a context tree of its training bytes: for the last 0 to 3 bytes, which byte came
next and how often. The code length of a byte is worked out as PPM does with escape method C and
exclusion: a context that has seen the byte codes it with n / (total + distinct); else it escapes
with distinct / (total + distinct) to the context that is one byte shorter, where the bytes already
ruled out do not count; below the empty context all bytes left are equally likely. Statistics are
frozen, so the code length depends on the last bytes alone. A text belongs to the language with the
shortest code.

Trees are sparse: sorted arrays of all contexts and of all (context, byte) pairs of the sample, none
left out. As every byte that a context has seen its shorter contexts have seen too, exclusion takes
one sum off a context for each context it is escaped to from, which is worked out when learning.
Contexts are counted by Spark over a bounded sample of labelled rows, whole texts, so the trees are no
larger than the sample. Texts are lower-cased. Prediction finds the different four bytes of a run of
texts, works out the code lengths of those not met before, and adds them up.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscore.llm.stored import stored
from logscore.llm.words import buffer_of, by_run

#: Bytes of context.
ORDER = 3
#: Labelled rows of each language to learn from, about.
ROWS_PER_LANGUAGE = 2000
#: Code lengths that a process keeps, by four bytes.
KEPT_CODES = 1_000_000
#: Code lengths that are worked out at once.
CODES_AT_ONCE = 1 << 15
#: Bytes of a text, however long, that are worked on at once.
CHUNK_BYTES = 1 << 20
#: Languages whose row counts are broadcast.
BROADCAST_LANGUAGES = 10_000
#: A language is left out when it has fewer labelled rows.
LEAST_ROWS = 1

UNKNOWN = "und"


@dataclass
class Level:
    """Contexts of one order in a language. A context is its bytes as a number; its pairs are the
    context, shifted, with the byte after it. `coded` is log2(total + distinct) and `escaped` the bits
    of the escape; `lower_coded` and `lower_escaped` the same of the context that is one byte shorter
    without the bytes this one has seen, `lower_any` whether it has others."""

    contexts: np.ndarray
    coded: np.ndarray
    escaped: np.ndarray
    lower_coded: np.ndarray
    lower_escaped: np.ndarray
    lower_any: np.ndarray
    pairs: np.ndarray
    log_counts: np.ndarray


def tree(codes: np.ndarray, counts: np.ndarray) -> list[Level]:
    """The levels of a language, shortest contexts first, from its four bytes and their counts."""
    levels: list[Level] = []
    below: tuple | None = None
    for order in range(ORDER + 1):
        pairs, at = np.unique(codes & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
        number = np.bincount(at, counts, len(pairs))
        contexts, of_pair = np.unique(pairs >> 8, return_inverse=True)
        total = np.bincount(of_pair, number, len(contexts))
        distinct = np.bincount(of_pair, minlength=len(contexts)).astype(float)
        left, left_distinct = np.zeros(len(contexts)), np.zeros(len(contexts))
        if below is not None:
            lower_pairs, lower_number, lower_contexts, lower_total, lower_distinct = below
            again = np.searchsorted(lower_pairs, pairs & ((1 << 8 * order) - 1))
            shorter = np.searchsorted(lower_contexts, contexts & ((1 << 8 * (order - 1)) - 1))
            left = lower_total[shorter] - np.bincount(of_pair, lower_number[again], len(contexts))
            left_distinct = lower_distinct[shorter] - distinct
        some = left_distinct > 0
        lower = np.where(some, left + left_distinct, 1)
        levels.append(
            Level(
                contexts, np.log2(total + distinct), np.log2((total + distinct) / distinct),
                np.log2(lower), np.log2(lower / np.where(some, left_distinct, 1)), some,
                pairs, np.log2(number),
            )
        )
        below = pairs, number, contexts, total, distinct
    return levels


def code_lengths(levels: list[Level], codes: np.ndarray) -> np.ndarray:
    """Bits of the last of each four bytes after the three before it."""
    bits = np.zeros(len(codes))
    open_ = np.arange(len(codes))
    above = np.full(len(codes), -1)  # the place of the next longer context among those of its order
    for order in range(ORDER, -1, -1):
        level = levels[order]
        if not len(level.contexts):
            continue
        code = codes[open_]
        context = (code >> 8) & ((1 << 8 * order) - 1)
        at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
        known = level.contexts[at] == context
        escaped_to = above[open_] >= 0
        longer = levels[order + 1] if order < ORDER else level
        i = np.where(escaped_to, above[open_], 0)
        coded = np.where(escaped_to, longer.lower_coded[i], level.coded[at])
        escape = np.where(escaped_to, longer.lower_escaped[i], level.escaped[at])
        asked = known & (~escaped_to | longer.lower_any[i])
        pair = code & ((1 << 8 * (order + 1)) - 1)
        place = np.minimum(np.searchsorted(level.pairs, pair), len(level.pairs) - 1)
        seen = asked & (level.pairs[place] == pair)
        bits[open_] += np.where(seen, coded - level.log_counts[place], np.where(asked, escape, 0))
        above[open_] = np.where(known, at, -1)
        open_ = open_[~seen]
    bits[open_] += np.log2(256 - len(levels[0].pairs))
    return bits


class Model:
    """The languages and their trees; keeps the code lengths that were asked for lately."""

    def __init__(self, languages: list[str], trees: list[list[Level]]):
        self.languages, self.trees = languages, trees
        self._codes = np.zeros(0, dtype=np.uint32)
        self._bits = np.zeros((0, len(trees)), dtype=np.float32)

    def __getstate__(self) -> tuple:
        return self.languages, self.trees

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Code lengths (codes x languages) of sorted different four bytes."""
        place = np.searchsorted(self._codes, codes)
        known = np.zeros(len(codes), dtype=bool)
        inside = place < len(self._codes)
        known[inside] = self._codes[place[inside]] == codes[inside]
        found = np.empty((len(codes), len(self.trees)), dtype=np.float32)
        found[known] = self._bits[place[known]]
        new = codes[~known]
        if len(new):
            made = np.empty((len(new), len(self.trees)), dtype=np.float32)
            for begin in range(0, len(new), CODES_AT_ONCE):
                part = new[begin : begin + CODES_AT_ONCE].astype(np.int64)
                for k, tree in enumerate(self.trees):
                    made[begin : begin + CODES_AT_ONCE, k] = code_lengths(tree, part)
            found[~known] = made
            if len(self._codes) + len(new) > KEPT_CODES:
                self._codes, self._bits = codes, found
            else:
                self._codes = np.insert(self._codes, place[~known], new)
                self._bits = np.insert(self._bits, place[~known], found[~known], axis=0)
        return found


def learning_rows(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """About that many rows of each language, chosen by a hash of the row."""
    labelled = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = stored(labelled.groupBy("lang").agg(F.count("*").alias("rows")), "language-counts")
    if counts.count() <= BROADCAST_LANGUAGES:  # else Spark shuffles the texts
        counts = F.broadcast(counts)
    share = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)) / float(1 << 20)
    chosen = labelled.join(counts.where(f"rows >= {LEAST_ROWS}"), "lang")
    return chosen.where(share * F.col("rows") < rows_per_language).select("lang", "text")


def _count_run(run: pa.RecordBatch) -> pa.RecordBatch:
    """How often each byte follows each three bytes, by language; 0 bytes stand before a text."""
    data, offsets = buffer_of(run.column("text"))
    langs = run.column("lang").dictionary_encode()
    codes = np.zeros(len(data), dtype=np.int64)
    for back in range(ORDER, -1, -1):
        codes = (codes << 8) | _before(data.astype(np.int64), offsets, back, 0)
    which = langs.indices.to_numpy(zero_copy_only=False)
    codes |= np.repeat(which.astype(np.int64), np.diff(offsets)) << 32
    found, counts = np.unique(codes, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [
            langs.dictionary.take(pa.array(found >> 32)),
            pa.array(found & 0xFFFFFFFF, pa.int64()),
            pa.array(counts, pa.int64()),
        ],
        names=["lang", "bytes", "n"],
    )


def _before(data: np.ndarray, offsets: np.ndarray, back: int, filler: int) -> np.ndarray:
    """The value `back` places before each one within its text, `filler` at the beginning."""
    if not back:
        return data
    moved = np.empty_like(data)
    moved[back:] = data[:-back] if back < len(data) else data[:0]
    moved[:back] = filler
    for step in range(back):
        places = offsets[:-1] + step
        moved[places[places < offsets[1:]]] = filler
    return moved


def count_contexts(rows: DataFrame) -> DataFrame:
    """`lang`, `bytes` (three bytes and the next one, as a number) and how often: `n`."""
    lowered = rows.select("lang", F.lower("text").alias("text"))
    found = lowered.mapInArrow(by_run(_count_run), "lang string, bytes bigint, n bigint")
    return found.groupBy("lang", "bytes").agg(F.sum("n").alias("n"))


def fit(rows: DataFrame) -> Model:
    """Learn from columns `lang` and `text`. The counts come to the driver; they are no more than the
    bytes of the rows, which `learning_rows` bounds."""
    table = count_contexts(rows).toPandas()
    languages = sorted(table["lang"].unique())
    parts = {lang: part for lang, part in table.groupby("lang")}
    trees = [
        tree(parts[lang]["bytes"].to_numpy(np.int64), parts[lang]["n"].to_numpy(float))
        for lang in languages
    ]
    return Model(languages, trees)


def _codes(data: np.ndarray, offsets: np.ndarray, begin: int, end: int) -> np.ndarray:
    """For bytes begin to end - 1 each with the three before it, as a number."""
    low = max(0, begin - ORDER)
    part = data[low:end].astype(np.uint32)
    offsets = np.clip(offsets - low, 0, end - low)
    codes = np.zeros(len(part), dtype=np.uint32)
    for back in range(ORDER, -1, -1):
        codes = (codes << np.uint32(8)) | _before(part, offsets, back, 0)
    return codes[begin - low :]


def _predict_run(model: Model, run: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
    """The language of each text and its share among equally likely languages."""
    data, offsets = buffer_of(run.column("_lower"))
    lettered = run.column("_letter").to_numpy(zero_copy_only=False).astype(bool)
    count = len(offsets) - 1
    if not model.languages:
        return pa.array([UNKNOWN] * count), pa.array([0.0] * count)
    totals = np.zeros((count, len(model.languages)))
    full = np.flatnonzero(np.diff(offsets))
    starts, ends = offsets[full], offsets[full + 1]
    for begin in range(0, len(data), CHUNK_BYTES):
        end = min(begin + CHUNK_BYTES, len(data))
        codes = _codes(data, offsets, begin, end)
        ordered = np.sort(codes)
        different = ordered[np.append(True, ordered[1:] != ordered[:-1])]
        rows, table = np.searchsorted(different, codes), model.bits(different)
        i, j = np.searchsorted(ends, begin, side="right"), np.searchsorted(starts, end)
        places = np.maximum(starts[i:j], begin) - begin
        for k in range(len(model.languages)):
            bits = np.ascontiguousarray(table[:, k])[rows]
            totals[full[i:j], k] += np.add.reduceat(bits, places, dtype=np.float64)
    best = totals.argmin(1)
    likely = np.exp2(np.maximum(totals.min(1, keepdims=True) - totals, -1000))
    scores = np.where(lettered, likely.max(1) / likely.sum(1), 0.0)
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    return pa.array(names[np.where(lettered, best, -1)], pa.string()), pa.array(scores)


def _marked(docs: DataFrame, *columns: Column) -> DataFrame:
    text = F.coalesce(F.lower("text"), F.lit(""))
    return docs.select(*columns, text.alias("_lower"), text.rlike("\\p{L}").alias("_letter"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: `doc_id`, `lang_pred`, `score` (0 to 1).

    Reads `doc_id` and `text` only. A null text, or one without a letter, is `und` with score 0;
    ties go to the first language by name; repeated rows are all returned with the same result; a
    model without languages answers `und`. Very long texts are worked on one at a time. An empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = _predict_run(shared.value, run)
        names = ["doc_id", "lang_pred", "score"]
        return pa.RecordBatch.from_arrays([run.column("doc_id"), lang, score], names=names)

    schema = "doc_id bigint, lang_pred string, score double"
    return _marked(docs, F.col("doc_id")).mapInArrow(by_run(work, "_lower"), schema)


def known_language(docs: DataFrame, model: Model, least_score: float = 0.5) -> DataFrame:
    """The rows whose language is known with at least that score; all columns pass through.

    Texts that are null or have no letter go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        lang, score = _predict_run(shared.value, run)
        sure = np.asarray(score) >= least_score
        known = np.array(lang.to_pylist(), dtype=object) != UNKNOWN
        return pa.RecordBatch.from_struct_array(run.column("row").filter(pa.array(sure & known)))

    whole = _marked(docs, F.struct("*").alias("row"))
    return whole.mapInArrow(by_run(work, "_lower"), docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
