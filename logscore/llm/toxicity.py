"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the vector of its spelling in lower case (if it was frequent enough to have one)
and, in each dimension, the largest value among its runs of three to five characters (bytes, ends
marked). Two gated recurrent units read a window of words from
both ends, attention weighs their states, and a logistic unit scores the pooled state. All
overlapping windows of a text are scored; the text's score is that of its highest window.

Labels are of texts, not of windows. Training starts with the windows that hold a text's most telling
words and then goes on with the highest windows of the model so far, of clean texts as well.

Training takes place on the driver over a bounded sample (`ROWS_PER_LABEL`, `LONGEST`); scoring is
one pass with the weights broadcast. Words that repeat within a run are put through the input layer
once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscore.llm.words import ALNUM, Words, by_run, words_of

#: Labelled rows of each label to learn from, about; texts above LONGEST bytes are not learnt from.
ROWS_PER_LABEL = 2000
LONGEST = 64_000
#: Words of a window, and words that one shares with the next.
WINDOW, OVERLAP = 32, 8
THRESHOLD = 0.7

HIDDEN = 8
WORD_DIMS = CHAR_DIMS = 8
ATTENTION = 8
#: Words with a vector of their own; a word must be in this many texts of the sample.
VOCABULARY, LEAST_TEXTS = 20_000, 3
RUNS, RUN_BITS = (3, 4, 5), 15

ROUNDS, EPOCHS, BATCH = 3, 3, 128
RATE, DECAY = 0.01, 0.02
#: Share of words that are read by their characters alone while training.
UNSEEN = 0.5

#: Windows that are scored at once, and text that is cut into words at once.
_TOGETHER, _RUN_BYTES = 4096, 2 << 20
#: Distinct words whose runs of characters are looked up at once.
_WORDS_TOGETHER = 10_000

Arrays = dict[str, np.ndarray]


@dataclass
class Model:
    vocabulary: np.ndarray  # sorted hashes; row i + 1 of the word vectors
    weights: Arrays


@dataclass
class Lexicon:
    """The distinct words of some texts: hashes, and buckets of their runs of characters, one word
    after the other."""

    hashes: np.ndarray
    grams: np.ndarray
    begins: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(np.append(self.begins, len(self.grams)))


def _lexicon(words: Words) -> tuple[Lexicon, np.ndarray]:
    """Distinct words, and which of them each word is."""
    hashes, first, which = np.unique(words.hashes, return_index=True, return_inverse=True)
    lengths = words.ends[first] - words.starts[first] + 2
    begins = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(first)), lengths)
    place = np.arange(len(owner)) - begins[owner]
    edge = (place == 0) | (place == lengths[owner] - 1)
    at = words.starts[first][owner] + place - 1
    marked = np.where(edge, 0, words.data[np.clip(at, 0, len(words.data) - 1)]).astype(np.uint32)
    grams, owners = [], []
    for size in RUNS:
        code = np.full(max(len(marked) - size + 1, 0), size, dtype=np.uint32)
        for k in range(size):
            code = code * np.uint32(0x01000193) ^ marked[k : k + len(code)]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - RUN_BITS)
        whole = place[: len(code)] + size <= lengths[owner[: len(code)]]
        grams.append(code[whole].astype(np.int32))
        owners.append(owner[: len(code)][whole])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    begins = np.searchsorted(owners[order], np.arange(len(first)))
    return Lexicon(hashes, np.concatenate(grams)[order], begins), which


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of words in all windows (windows x WINDOW, -1 beyond the text), and their text."""
    sizes = np.diff(first)
    step = WINDOW - OVERLAP
    counts = np.where(sizes > 0, np.maximum(1, -(-(sizes - OVERLAP) // step)), 0)
    texts = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = first[:-1][texts] + number * step
    places = begins[:, None] + np.arange(WINDOW)
    return np.where(places < first[1:][texts][:, None], places, -1), texts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


def _tanh(x: np.ndarray) -> np.ndarray:
    return 2 * _sigmoid(2 * x) - 1


def _rows(model: Model, hashes: np.ndarray) -> np.ndarray:
    """Rows of the word vectors; 0 for words without one."""
    at = np.searchsorted(model.vocabulary, hashes)
    at[at == len(model.vocabulary)] = 0
    known = len(model.vocabulary) > 0 and model.vocabulary[at] == hashes
    return np.where(known, at + 1, 0)


def _inputs(model: Model, lexicon: Lexicon, rows: np.ndarray) -> np.ndarray:
    w = model.weights
    if not len(rows):
        return np.zeros((0, WORD_DIMS + CHAR_DIMS), dtype=np.float32)
    result = np.empty((len(rows), WORD_DIMS + CHAR_DIMS), dtype=w["words"].dtype)
    result[:, :WORD_DIMS] = w["words"][rows]
    for begin in range(0, len(rows), _WORDS_TOGETHER):
        part = slice(begin, begin + _WORDS_TOGETHER)
        begins = lexicon.begins[part]
        end = begins[-1] + lexicon.counts()[part][-1]
        runs = w["chars"][lexicon.grams[begins[0] : end]]
        result[part, WORD_DIMS:] = np.maximum.reduceat(runs, begins - begins[0])
    return result


def _gates(w: Arrays, side: str, entered: np.ndarray, state: np.ndarray) -> tuple:
    """One step of a unit: gates z and r, candidate n, and the new state."""
    again = state @ w[f"{side}_again"]
    zr = _sigmoid(entered[:, : 2 * HIDDEN] + again[:, : 2 * HIDDEN])
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    n = _tanh(entered[:, 2 * HIDDEN :] + r * again[:, 2 * HIDDEN :])
    return z, r, n, again[:, 2 * HIDDEN :], (1 - z) * n + z * state


def _pool(w: Arrays, states: np.ndarray, mask: np.ndarray) -> tuple:
    """Attention weights and logit of states (windows x words x 2 HIDDEN)."""
    seen = _tanh(states @ w["look"] + w["look_bias"])
    energy = np.where(mask, seen @ w["care"], -1e9)
    share = np.exp(energy - energy.max(1, keepdims=True))
    share /= share.sum(1, keepdims=True)
    pooled = (share[:, :, None] * states).sum(1)
    return seen, share, pooled, pooled @ w["out"] + w["out_bias"][0]


def _score(model: Model, lexicon: Lexicon, which: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The logit of each window."""
    w = model.weights
    inputs = _inputs(model, lexicon, _rows(model, lexicon.hashes))
    entered = {s: inputs @ w[f"{s}_in"] + w[f"{s}_bias"] for s in ("left", "right")}
    result = np.zeros(len(places), dtype=np.float32)
    whole = places[:, -1] >= 0
    for numbers in (np.flatnonzero(whole), np.flatnonzero(~whole)):
        for begin in range(0, len(numbers), _TOGETHER):
            part = numbers[begin : begin + _TOGETHER]
            mask = places[part] >= 0
            ids = which[np.maximum(places[part], 0)].T.copy()
            states = np.zeros((len(part), WINDOW, 2 * HIDDEN), dtype=np.float32)
            for side in ("left", "right"):
                _read(w, side, entered[side], ids, mask, states)
            result[part] = _pool(w, states, mask)[-1]
    return result


def _read(
    w: Arrays, side: str, entered: np.ndarray, ids: np.ndarray, mask: np.ndarray, states: np.ndarray
) -> None:
    """Fill in the states of one unit; as `_gates`, with fewer copies."""
    gate_in = np.ascontiguousarray(entered[:, : 2 * HIDDEN])
    new_in = np.ascontiguousarray(entered[:, 2 * HIDDEN :])
    again = w[f"{side}_again"]
    gate_again = np.ascontiguousarray(again[:, : 2 * HIDDEN])
    new_again = np.ascontiguousarray(again[:, 2 * HIDDEN :])
    own = slice(0, HIDDEN) if side == "left" else slice(HIDDEN, None)
    order = range(WINDOW) if side == "left" else range(WINDOW - 1, -1, -1)
    state = np.zeros((len(mask), HIDDEN), dtype=np.float32)
    whole = mask.all()
    with np.errstate(over="ignore"):
        for t in order:
            gates = state @ gate_again
            gates += gate_in[ids[t]]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            new = state @ new_again
            new *= gates[:, HIDDEN:]
            new += new_in[ids[t]]
            new *= -2
            np.exp(new, out=new)
            new += 1
            np.divide(2, new, out=new)
            new -= 1
            state = state - new
            state *= gates[:, :HIDDEN]
            state += new
            if not whole:
                before = 0 if t == order[0] else states[:, t - 1 if side == "left" else t + 1, own]
                state = np.where(mask[:, t, None], state, before)
            states[:, t, own] = state


def _gradients(
    w: Arrays, inputs: np.ndarray, mask: np.ndarray, target: np.ndarray
) -> tuple[Arrays, np.ndarray]:
    """Of the mean cross-entropy, by weight; and by input (windows x words x dimensions)."""
    count = len(inputs)
    states = np.zeros((count, WINDOW, 2 * HIDDEN), dtype=np.float32)
    sides = (
        ("left", list(range(WINDOW)), slice(0, HIDDEN)),
        ("right", list(range(WINDOW - 1, -1, -1)), slice(HIDDEN, None)),
    )
    steps: dict[tuple[str, int], tuple] = {}
    for side, order, own in sides:
        state = np.zeros((count, HIDDEN), dtype=np.float32)
        entered = inputs @ w[f"{side}_in"] + w[f"{side}_bias"]
        for t in order:
            z, r, n, again, new = _gates(w, side, entered[:, t], state)
            steps[side, t] = (state, z, r, n, again)
            state = np.where(mask[:, t, None], new, state)
            states[:, t, own] = state
    seen, share, pooled, logit = _pool(w, states, mask)
    g: Arrays = {}
    d_logit = ((_sigmoid(logit) - target) / count).astype(np.float32)
    g["out"], g["out_bias"] = pooled.T @ d_logit, np.array([d_logit.sum()])
    d_pooled = d_logit[:, None] * w["out"]
    d_states = share[:, :, None] * d_pooled[:, None, :]
    d_share = (states * d_pooled[:, None, :]).sum(2)
    d_energy = share * (d_share - (share * d_share).sum(1, keepdims=True))
    g["care"] = np.einsum("nt,ntk->k", d_energy, seen)
    d_seen = d_energy[:, :, None] * w["care"] * (1 - seen**2)
    g["look"] = np.einsum("ntk,ntj->kj", states, d_seen)
    g["look_bias"] = d_seen.sum((0, 1))
    d_states += d_seen @ w["look"].T
    d_inputs = np.zeros_like(inputs)
    for side, order, own in sides:
        d_state = np.zeros((count, HIDDEN), dtype=np.float32)
        d_entered = np.zeros((count, WINDOW, 3 * HIDDEN), dtype=np.float32)
        d_again_sum = np.zeros_like(w[f"{side}_again"])
        for t in reversed(order):
            d_state = d_state + d_states[:, t, own]
            on = mask[:, t, None]
            state, z, r, n, again = steps[side, t]
            d_new = np.where(on, d_state, 0)
            d_n = d_new * (1 - z) * (1 - n**2)
            d_z = d_new * (state - n) * z * (1 - z)
            d_r = d_n * again * r * (1 - r)
            d_again = np.hstack([d_z, d_r, d_n * r])
            d_entered[:, t] = np.hstack([d_z, d_r, d_n])
            d_again_sum += state.T @ d_again
            d_state = np.where(on, d_new * z + d_again @ w[f"{side}_again"].T, d_state)
        flat = d_entered.reshape(-1, 3 * HIDDEN)
        g[f"{side}_again"] = d_again_sum
        g[f"{side}_in"] = inputs.reshape(-1, inputs.shape[2]).T @ flat
        g[f"{side}_bias"] = flat.sum(0)
        d_inputs += d_entered @ w[f"{side}_in"].T
    return g, d_inputs


def _telling(texts_with: np.ndarray, toxic_with: np.ndarray, texts: int, toxic: int) -> np.ndarray:
    """How far something speaks for toxic texts: log odds in standard errors."""
    a, b = toxic_with + 0.5, texts_with - toxic_with + 0.5
    odds = np.log(a / (toxic + 1)) - np.log(b / (texts - toxic + 1))
    return odds / np.sqrt(1 / a + 1 / b)


def _text_counts(items: np.ndarray, texts: np.ndarray, labels: np.ndarray, size: int) -> tuple:
    """In how many texts, and toxic texts, each item is."""
    pairs = np.unique(items * (len(labels) + 1) + texts)
    item, text = pairs // (len(labels) + 1), pairs % (len(labels) + 1)
    return np.bincount(item, minlength=size), np.bincount(item, labels[text], minlength=size)


def _gram_counts(
    lexicon: Lexicon, which: np.ndarray, first: np.ndarray, labels: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """`_text_counts` of runs of characters, one text at a time."""
    found, bad = np.zeros(1 << RUN_BITS), np.zeros(1 << RUN_BITS)
    counts = lexicon.counts()
    for text, label in enumerate(labels):
        own = np.unique(which[first[text] : first[text + 1]])
        repeat = counts[own]
        index = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        grams = np.unique(lexicon.grams[np.repeat(lexicon.begins[own], repeat) + index])
        found[grams] += 1
        bad[grams] += label
    return found, bad


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """A model of texts and their labels, 0 or 1; the same for the same texts in the same order."""
    rng = np.random.default_rng(seed)
    words = words_of(pa.array(texts, pa.string()), ALNUM)
    lexicon, which = _lexicon(words)
    target = np.array(labels, dtype=np.float64)
    places, owner = _windows(words.first)
    of_word = words.of_word()
    size = len(lexicon.hashes)

    found, bad = _text_counts(which, of_word, target, size)
    telling = _telling(found, bad, len(target), target.sum())
    order = np.lexsort((lexicon.hashes, -np.abs(telling)))
    kept = order[found[order] >= LEAST_TEXTS][:VOCABULARY]
    kept = kept[np.argsort(lexicon.hashes[kept])]
    gram_found, gram_bad = _gram_counts(lexicon, which, words.first, target)
    gram_telling = _telling(gram_found, gram_bad, len(target), target.sum())

    def drawn(*shape: int, spread: float = 0.3) -> np.ndarray:
        return rng.normal(0, spread, shape).astype(np.float32)

    dims = WORD_DIMS + CHAR_DIMS
    w: Arrays = {
        "words": drawn(len(kept) + 1, WORD_DIMS, spread=0.05),
        "chars": drawn(1 << RUN_BITS, CHAR_DIMS, spread=0.05),
        "look": drawn(2 * HIDDEN, ATTENTION),
        "look_bias": np.zeros(ATTENTION, np.float32),
        "care": drawn(ATTENTION),
        "out": drawn(2 * HIDDEN),
        "out_bias": np.zeros(1, np.float32),
    }
    w["words"][1:, 0] = np.clip(telling[kept] / 2, -3, 3)
    w["chars"][:, 0] = np.clip(gram_telling / 2, -3, 3)
    for side in ("left", "right"):
        w[f"{side}_in"] = drawn(dims, 3 * HIDDEN)
        w[f"{side}_again"] = drawn(HIDDEN, 3 * HIDDEN)
        w[f"{side}_bias"] = np.zeros(3 * HIDDEN, np.float32)
    model = Model(lexicon.hashes[kept], w)
    if not len(places) or target.min() == target.max():
        w["out"][:] = 0
        w["out_bias"][:] = 4.0 if len(target) and target.min() == 1 else -4.0
        return model

    word_telling = np.where(found >= LEAST_TEXTS, telling, 0)
    if size:
        spelled = np.maximum.reduceat(gram_telling[lexicon.grams], lexicon.begins)
        word_telling = np.maximum(word_telling, spelled)
    first = np.where(places >= 0, word_telling[which[np.maximum(places, 0)]], -99).max(1)
    moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in w.items()}
    rows = _rows(model, lexicon.hashes)
    done = 0
    for round_ in range(ROUNDS):
        scores = first if round_ == 0 else _score(model, lexicon, which, places)
        chosen, wanted = _chosen(scores, owner, target, rng)
        for _ in range(EPOCHS):
            for batch in np.array_split(rng.permutation(len(chosen)), -(-len(chosen) // BATCH)):
                done += 1
                part = places[chosen[batch]]
                _step(model, lexicon, rows, which, part, wanted[batch], moments, done, rng)
    return model


def _chosen(
    scores: np.ndarray, owner: np.ndarray, target: np.ndarray, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """Windows to learn from: each text's highest, and as many others of clean texts; toxic windows
    repeat until they are about a third."""
    order = np.lexsort((scores, owner))
    last = np.append(owner[order][1:] != owner[order][:-1], True)
    best = order[last]
    toxic = best[target[owner[best]] == 1]
    clean = best[target[owner[best]] == 0]
    others = np.flatnonzero(target[owner] == 0)
    others = rng.choice(others, min(len(others), len(clean)), replace=False)
    clean = np.concatenate([clean, others])
    times = max(1, len(clean) // max(1, 2 * len(toxic)))
    chosen = np.concatenate([np.repeat(toxic, times), clean])
    return chosen, np.repeat([1.0, 0.0], [times * len(toxic), len(clean)])


def _step(
    model: Model,
    lexicon: Lexicon,
    rows: np.ndarray,
    which: np.ndarray,
    places: np.ndarray,
    target: np.ndarray,
    moments: dict,
    done: int,
    rng: np.random.Generator,
) -> None:
    """One batch: gradients and a step of Adam."""
    w, mask = model.weights, places >= 0
    ids, back = np.unique(which[np.maximum(places, 0)], return_inverse=True)
    back = back.reshape(places.shape)
    counts = lexicon.counts()[ids]
    begins = np.cumsum(counts) - counts
    index = np.arange(counts.sum()) - np.repeat(begins, counts)
    part = Lexicon(
        lexicon.hashes[ids], lexicon.grams[np.repeat(lexicon.begins[ids], counts) + index], begins
    )
    own = np.where(rng.random(len(ids)) < UNSEEN, 0, rows[ids])
    inputs = _inputs(model, part, own)
    g, d_inputs = _gradients(w, inputs[back], mask, target)
    d_word = np.zeros_like(inputs)
    np.add.at(d_word, back, d_inputs)
    g["words"], g["chars"] = np.zeros_like(w["words"]), np.zeros_like(w["chars"])
    np.add.at(g["words"], own, d_word[:, :WORD_DIMS])
    largest = w["chars"][part.grams] == np.repeat(inputs[:, WORD_DIMS:], counts, axis=0)
    d_gram = np.repeat(d_word[:, WORD_DIMS:], counts, axis=0) * largest
    np.add.at(g["chars"], part.grams, d_gram)
    for name, gradient in g.items():
        mean, square = moments[name]
        mean += 0.1 * (gradient - mean)
        square += 0.001 * (gradient**2 - square)
        change = (mean / (1 - 0.9**done)) / (np.sqrt(square / (1 - 0.999**done)) + 1e-8)
        w[name] -= (RATE * (change + DECAY * w[name])).astype(np.float32)


def learning_rows(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_LABEL) -> DataFrame:
    """About that many labelled texts of each label, chosen by a hash of the id.

    The ids are drawn from the labels, so what is broadcast to the documents is a sample of about
    `2 * rows` ids whatever their number. Labels of documents that may not be learnt from must be
    left out by the caller.
    """
    known = labels.where("toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = known.groupBy("toxic").agg(F.count("*").alias("count"))  # two rows
    share = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.join(F.broadcast(counts), "toxic").where(share * F.col("count") < rows)
    short = docs.where(f"octet_length(text) <= {LONGEST}").select("doc_id", "text")
    return short.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id")


def fit(rows: DataFrame) -> Model:
    """A model of columns `doc_id`, `text` and `toxic`: a bounded sample, in order of the id."""
    table = rows.toPandas().sort_values(["doc_id", "text"])
    return train(table["text"].tolist(), table["toxic"].astype(int).tolist())


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: `doc_id`, `score` (0 to 1), `predicted` (1 from the threshold on).

    Reads `doc_id` and `text`; other columns are not touched. A null text, or one without words, has
    score 0. Repeated rows get the same score, and so do texts that tie; a score of just `threshold` is
    predicted toxic; a very long text is worked on alone, a few thousand windows at a time; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(run.column("text"), ALNUM)
        scores = np.zeros(run.num_rows)
        if len(words.hashes):
            lexicon, which = _lexicon(words)
            places, owner = _windows(words.first)
            logits = _score(shared.value, lexicon, which, places)
            highest = np.full(run.num_rows, -np.inf)
            np.maximum.at(highest, owner, logits)
            scores = np.where(np.diff(words.first) > 0, _sigmoid(highest), 0.0)
        predicted = pa.array((scores >= threshold).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [run.column("doc_id"), pa.array(scores), predicted],
            names=["doc_id", "score", "predicted"],
        )

    schema = "doc_id bigint, score double, predicted int"
    return docs.select("doc_id", "text").mapInArrow(by_run(work, limit=_RUN_BYTES), schema)
