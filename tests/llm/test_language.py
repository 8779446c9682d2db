from __future__ import annotations

import math

import numpy as np
import pytest

from logscore.llm import language
from tests.llm.helpers import documents, rows_of


def brute_bits(training: list[bytes], text: bytes) -> float:
    """Code length by counting in dictionaries."""
    events = []
    for t in training:
        padded = b"\0" * language.ORDER + t
        events += [padded[i : i + 4] for i in range(len(t))]
    counts: dict[bytes, dict[int, int]] = {}
    for e in events:
        for order in range(language.ORDER + 1):
            c = counts.setdefault(e[3 - order : 3], {})
            c[e[3]] = c.get(e[3], 0) + 1
    bits, padded = 0.0, b"\0" * language.ORDER + text
    for i, byte in enumerate(text):
        out: set[int] = set()
        for order in range(language.ORDER, -1, -1):
            c = counts.get(padded[i + 3 - order : i + 3], {})
            left = {s: n for s, n in c.items() if s not in out}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if byte in left:
                bits -= math.log2(left[byte] / total)
                break
            bits -= math.log2(len(left) / total)
            out |= set(left)
        else:
            bits += math.log2(256 - len(out))
    return bits


TRAINING = {"aa": ["abab abba baab", "abba ab"], "bb": ["cdcd dccd dc", "cd dc cdd", "xyz"]}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(lang, text) for lang, texts in TRAINING.items() for text in texts]
    return language.fit(spark.createDataFrame(rows, "lang string, text string"))


def test_code_lengths_against_brute_force(spark, model):
    texts = ["abba", "cd dc", "xyzzy", "q", "ab cd ab cd", "é"]
    expected = []
    for text in texts:
        bits = [brute_bits([t.encode() for t in TRAINING[lang]], text.encode()) for lang in ("aa", "bb")]
        expected.append((("aa", "bb")[int(bits[1] < bits[0])], 1 / (1 + 2 ** -abs(bits[0] - bits[1]))))
    found = {r.doc_id: r for r in language.identify(documents(spark, texts), model).collect()}
    for i, (lang, score) in enumerate(expected):
        assert found[i].lang_pred == lang
        assert found[i].score == pytest.approx(score, abs=1e-4)


def test_probabilities_sum_to_one(model):
    for context in (b"\0\0\0", b"abb", b"xyz", b"qqq", b"qab", b"\0dc"):
        codes = (int.from_bytes(context, "big") << 8) + np.arange(256)
        for tree in model.trees:
            assert np.exp2(-language.code_lengths(tree, codes)).sum() == pytest.approx(1)


def test_many_contexts_and_languages():
    """Every context counts, however many there are: 100 languages and 30,000 contexts of three."""
    rng = np.random.default_rng(4)
    texts = [rng.integers(1, 256, 600).astype(np.uint8).tobytes() for _ in range(100)]
    trees = []
    for text in texts:
        padded = b"\0" * 3 + text
        codes = [int.from_bytes(padded[i : i + 4], "big") for i in range(len(text))]
        found, counts = np.unique(np.array(codes), return_counts=True)
        trees.append(language.tree(found, counts.astype(float)))
    assert sum(len(tree[3].contexts) for tree in trees) > 30_000
    for i in rng.integers(0, 100, 6):
        probe = texts[i][:40] + texts[(i + 1) % 100][:20]
        padded = b"\0" * 3 + probe
        codes = np.array([int.from_bytes(padded[k : k + 4], "big") for k in range(len(probe))])
        for tree, text in ((trees[i], texts[i]), (trees[(i + 1) % 100], texts[(i + 1) % 100])):
            bits = language.code_lengths(tree, codes).sum()
            assert bits == pytest.approx(brute_bits([text], probe))


def test_kept_code_lengths(monkeypatch):
    monkeypatch.setattr(language, "KEPT_CODES", 50)
    rng = np.random.default_rng(5)
    codes = np.unique(rng.integers(0, 1 << 16, 300))
    model = language.Model(["x"], [language.tree(codes, np.ones(len(codes)))])
    for _ in range(20):
        asked = np.unique(rng.integers(0, 1 << 16, rng.integers(1, 40))).astype(np.uint32)
        wanted = language.code_lengths(model.trees[0], asked.astype(np.int64))
        assert model.bits(asked)[:, 0] == pytest.approx(wanted, rel=1e-6)


def test_texts_without_letters(spark, model):
    docs = documents(spark, [None, "", "12 ?!", "ab", "ab", "AB" * 5000], "1 AS score")
    rows = rows_of(language.identify(docs, model), "doc_id", "lang_pred")
    assert rows == [(0, "und"), (1, "und"), (2, "und"), (3, "aa"), (4, "aa"), (5, "aa")]
    known = language.known_language(docs, model)
    assert known.columns == docs.columns
    assert rows_of(known, "doc_id") == [(3,), (4,), (5,)]
    assert language.identify(docs.where("false"), model).collect() == []


def test_chunks_do_not_change_results(spark, model, monkeypatch):
    texts = ["abba ab cd", "c", "", "dc cd" * 7, "ab"]
    whole = rows_of(language.identify(documents(spark, texts), model), "doc_id", "lang_pred", "score")
    import pyarrow as pa

    monkeypatch.setattr(language, "CHUNK_BYTES", 3)
    columns = [pa.array(texts), pa.array([True, True, False, True, True])]
    run = pa.RecordBatch.from_arrays(columns, ["_lower", "_letter"])
    langs, scores = language._predict_run(model, run)
    assert langs.to_pylist() == [row[1] for row in whole]
    assert scores.to_pylist() == pytest.approx([row[2] for row in whole], abs=1e-6)


def test_nothing_to_learn_from(spark):
    empty = documents(spark, [(1, None, "en", "a"), (2, "x", None, "a")])
    model = language.fit(language.learning_rows(empty))
    assert rows_of(language.identify(documents(spark, ["abc"]), model), "lang_pred", "score") == [("und", 0.0)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(language.learning_rows(docs.where(~language.held_out())))
    test = docs.where(language.held_out())
    found = language.identify(test, model).join(test.select("doc_id", "lang"), "doc_id")
    right, total = found.selectExpr("sum(int(lang = lang_pred))", "count(*)").first()
    assert right / total > 0.98
