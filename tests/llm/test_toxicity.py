from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from logscore.llm import toxicity
from logscore.llm.words import ALNUM, words_of
from tests.llm.helpers import documents, rows_of


def texts(seed: int, count: int) -> tuple[list[str], list[int]]:
    rng = random.Random(seed)
    made, labels = [], []
    for i in range(count):
        words = ["".join(rng.choice("aeiou") + rng.choice("bcdfg") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 120))]
        bad = i % 3 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["Villain", "rotten", f"scumxy{rng.choice('abcde')}u"])
        made.append(" ".join(words))
        labels.append(int(bad))
    return made, labels


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*texts(1, 700))


def test_learns_words_and_spellings(spark, model):
    given, labels = texts(2, 90)
    found = {r.doc_id: r for r in toxicity.score(documents(spark, given, "1 AS score"), model).collect()}
    right = sum(found[i].predicted == label for i, label in enumerate(labels))
    assert right >= 85
    assert all(r.predicted == int(r.score >= toxicity.THRESHOLD) and 0 <= r.score <= 1 for r in found.values())


def test_edge_cases(spark, model):
    long = "aba " * 30_000 + "villain" + " aba" * 30_000
    rows = [(1, None), (2, ""), (3, "?! "), (4, "villain"), (4, "villain"), (5, long)]
    docs = documents(spark, rows)
    found = rows_of(toxicity.score(docs, model), "doc_id", "predicted")
    assert found == [(1, 0), (2, 0), (3, 0), (4, 1), (4, 1), (5, 1)]
    assert toxicity.score(docs.where("false"), model).collect() == []


def test_windows_overlap_and_cover():
    first = np.array([0, 0, 5, 5 + 32, 37 + 33, 70 + 100])
    places, owner = toxicity._windows(first)
    for text, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        rows = places[owner == text]
        seen = {p for row in rows for p in row if p >= 0}
        assert seen == set(range(a, b))
        for x, y in zip(rows, rows[1:], strict=False):
            assert len(set(x) & set(y) - {-1}) == toxicity.OVERLAP or -1 in y
    assert (owner == 1).sum() == 1 and (owner == 2).sum() == 1 and (owner == 3).sum() == 2


def test_gradients_against_differences(model):
    rng = np.random.default_rng(1)
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    inputs = rng.normal(size=(3, toxicity.WINDOW, toxicity.WORD_DIMS + toxicity.CHAR_DIMS))
    mask = np.ones((3, toxicity.WINDOW), dtype=bool)
    mask[1, 4:] = False
    target = np.array([1.0, 0, 1])
    g, d_inputs = toxicity._gradients(w, inputs, mask, target)

    def loss() -> float:
        states = np.zeros((3, toxicity.WINDOW, 2 * toxicity.HIDDEN))
        for side in ("left", "right"):
            entered = inputs.reshape(-1, inputs.shape[2]) @ w[f"{side}_in"] + w[f"{side}_bias"]
            ids = np.arange(3 * toxicity.WINDOW).reshape(3, -1).T
            toxicity._read(w, side, entered, ids, mask, states)
        p = toxicity._sigmoid(toxicity._pool(w, states, mask)[-1])
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

    for name in ("left_in", "right_again", "left_bias", "look", "care", "out", "look_bias", "right_in"):
        flat, own = w[name].reshape(-1), np.asarray(g[name]).reshape(-1)
        for i in rng.choice(flat.size, min(5, flat.size), replace=False):
            before = flat[i]
            flat[i] = before + 1e-4
            up = loss()
            flat[i] = before - 1e-4
            down = loss()
            flat[i] = before
            assert own[i] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=1e-5), name
    before = inputs[0, 3, 2]
    inputs[0, 3, 2] = before + 1e-4
    up = loss()
    inputs[0, 3, 2] = before - 1e-4
    assert d_inputs[0, 3, 2] == pytest.approx((up - loss()) / 2e-4, rel=2e-2, abs=1e-5)


def test_runs_of_characters_belong_to_their_word():
    lexicon, which = toxicity._lexicon(words_of(pa.array(["ab abc ab", None]), ALNUM))
    assert len(lexicon.hashes) == 2 and which.tolist()[0] == which.tolist()[2]
    assert sorted(lexicon.counts().tolist()) == [3, 6]


@pytest.mark.parametrize(("given", "labels"), [([], []), (["a b"], [0]), ([""], [1])])
def test_little_to_learn_from(spark, given, labels):
    model = toxicity.train(given, labels)
    assert rows_of(toxicity.score(documents(spark, ["a"]), model), "predicted") == [(int(labels == [1]),)]


def test_sample_is_of_labelled_rows(spark):
    docs = documents(spark, ["a", None, "c", "d" * (toxicity.LONGEST + 1), "e"])
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, 1), (3, 0), (4, 0), (2, None)], "doc_id bigint, toxic int")
    assert rows_of(toxicity.learning_rows(docs, labels), "doc_id", "toxic") == [(0, 1), (4, 0)]


def test_learning_draws_about_two_thousand_of_each_label(spark):
    docs = spark.range(8000).selectExpr("id AS doc_id", "'some text' AS text")
    labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS toxic")
    counts = toxicity.learning_rows(docs, labels).groupBy("toxic").count().collect()
    assert len(counts) == 2 and all(1800 < row["count"] < 2200 for row in counts)
