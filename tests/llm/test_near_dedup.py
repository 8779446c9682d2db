from __future__ import annotations

import random

import pytest

from logscore.llm import components as graph
from logscore.llm import near_dedup
from logscore.llm.components import components
from tests.llm.helpers import SPACED, documents, lower, rows_of


def brute(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets = []
    for _, text in rows:
        w = SPACED.findall(lower(text))
        whole = {tuple(w)} if w else set()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else whole)
    root = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            both = len(x & y)
            if both and 100 * both >= 75 * len(x | y):
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {r: min(rows[k][0] for k, q in enumerate(root) if q == r) for r in root}
    return {row[0]: (len(sets[i]), least[root[i]]) for i, row in enumerate(rows)}


def family(rng: random.Random, size: int, edits: int, words: int = 60) -> list[str]:
    base = [rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(words)]
    made = []
    for _ in range(size):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"z{rng.randint(0, 9999)}"
        made.append(" ".join(copy))
    return made


@pytest.mark.parametrize("block", [4, 256])
def test_against_all_pairs(spark, monkeypatch, block):
    """Families with links, near misses and chains; blocks of four make many meet."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(block)
    texts = [t for edits in (1, 3, 4) for t in family(rng, 25, edits)]
    texts += ["", None, " \n", "One two", "one TWO", "one  two three", "x " * 3000, "x " * 2900]
    rng.shuffle(texts)
    result = near_dedup.near_duplicates(documents(spark, texts, "1 AS node")).collect()
    expected = brute(list(enumerate(texts)))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in result} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in result)


def test_repeated_and_null_ids(spark):
    text = "one two three four five six"
    rows = [(7, text), (7, text), (None, text), (3, text), (None, "alone"), (5, None), (5, "alone")]
    found = near_dedup.near_duplicates(documents(spark, rows))
    assert rows_of(found, "doc_id", "n_shingles", "component_id", "kept") == sorted(
        [
            (7, 2, 3, False), (7, 2, 3, False), (None, 2, 3, False), (3, 2, 3, True),
            (None, 1, 5, False), (5, 0, 5, True), (5, 1, 5, True),
        ],
        key=repr,
    )


def test_kept_rows_pass_all_columns(spark):
    text = "one two three four five six"
    docs = documents(spark, [text, text, None, "other"], "9 AS component_id")
    kept = near_dedup.kept_rows(docs)
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "component_id") == [(0, 9), (2, 9), (3, 9)]


def test_empty_table(spark):
    assert near_dedup.near_duplicates(documents(spark, []).where("false")).collect() == []


def test_estimate_is_near_the_truth():
    rng = random.Random(5)
    base = [str(rng.random()) for _ in range(400)]
    other = base[:300] + [str(rng.random()) for _ in range(100)]
    import numpy as np
    import pyarrow as pa

    from logscore.llm.words import SPACED as KIND
    from logscore.llm.words import words_of

    sets = list(near_dedup.shingle_sets(words_of(pa.array([" ".join(base), " ".join(other)]), KIND)))
    packed = near_dedup._packed(near_dedup._minima(sets))
    x = packed[0] ^ packed[1]
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    different = np.bitwise_count(x & np.uint64(near_dedup._NIBBLES)).sum()
    estimate = ((1 - different / near_dedup.MINIMA) - 1 / 16) / (1 - 1 / 16)
    true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    assert abs(estimate - true) < near_dedup.SLACK / 2


@pytest.mark.parametrize("per_task", [8, 200_000])
def test_components(spark, monkeypatch, per_task):
    """In one task, and in several with stars between."""
    monkeypatch.setattr(graph, "PAIRS_PER_TASK", per_task)
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5), (7, None)]
    pairs = spark.createDataFrame(chain, "a int, b int")
    found = {r.node: r.root for r in components(pairs, "a", "b").collect()}
    assert found == dict.fromkeys(range(41), 0) | {100: 100, 101: 100}
    assert components(pairs.where("false"), "a", "b").collect() == []
