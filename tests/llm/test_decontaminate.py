from __future__ import annotations

import hashlib
import random

import pytest

from logscore.llm import decontaminate
from tests.llm.helpers import ALNUM, documents, lower, rows_of

ITEMS = "item_id bigint, text string, n_words int"


def brute(docs: list, items: list) -> list[tuple]:
    windows: dict[tuple, set] = {}
    for item_id, text in items:
        w = ALNUM.findall(lower(text))
        size = min(13, len(w))
        for i in range(len(w) - size + 1) if w else ():
            windows.setdefault(tuple(w[i : i + size]), set()).add(item_id)
    result = []
    for doc_id, text in enumerate(docs):
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for window, ids in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= ids - {None}
        ids = ",".join(sorted(map(str, found)))
        digest = hashlib.sha256(ids.encode()).hexdigest()
        bad = bool(hit) and 20 * len(hit) >= len(w)
        result.append((doc_id, len(w), len(hit), len(found), digest, bad))
    return sorted(result, key=repr)


def tables(seed: int) -> tuple[list, list]:
    rng = random.Random(seed)

    def words(n: int) -> str:
        return " ".join(rng.choice(["The", "a-b", "é", "x1", "go!", "\n"]) + rng.choice("abc") for _ in range(n))

    items = [(i % 18, words(rng.choice([1, 3, 12, 13, 14, 40]))) for i in range(20)]
    items += [(50, ""), (51, None), (None, "null id item"), (52, "!!")]
    docs = [words(rng.randint(0, 80)) for _ in range(20)] + ["", None, "a null ID item."]
    docs += [f"{words(30)} {items[i][1]} {words(500)}" for i in range(6)]
    docs += [f"{items[5][1]} {items[5][1]}", items[0][1]]
    return docs, items


@pytest.mark.parametrize("part_bytes", [1 << 20, 200])
def test_against_brute_force(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(decontaminate, "PART_BYTES", part_bytes)
    docs, items = tables(3)
    benchmark = spark.createDataFrame([(*x, 0) for x in items], ITEMS)
    scanned = decontaminate.scan(documents(spark, docs, "1 AS spans"), benchmark)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = brute(docs, items)
    assert rows_of(decontaminate.digest(scanned), *names) == expected
    given = documents(spark, docs, "'q' AS contaminated")
    left = decontaminate.decontaminate(given, benchmark)
    assert left.columns == given.columns
    assert {r.doc_id for r in left.collect()} == {r[0] for r in expected if not r[-1]}


def test_spans_are_cut_out(spark):
    item = "Alpha beta gamma delta"
    benchmark = spark.createDataFrame([(1, item, 4)], ITEMS)
    texts = ["Keep. ALPHA, beta -- gamma (delta)! Stay", item, None, "Größe alpha beta gamma delta é"]
    left = decontaminate.decontaminate(documents(spark, texts), benchmark, remove="spans")
    assert rows_of(left, "doc_id", "text") == [
        (0, "Keep. )! Stay"), (1, ""), (2, None), (3, "Größe  é"),
    ]


def test_spans_of_all_parts_are_cut_at_once(spark, monkeypatch):
    """Hits of items in different parts overlap; words that a cut brings together are no hit."""
    monkeypatch.setattr(decontaminate, "PART_BYTES", 1)
    items = ["alpha beta gamma delta", "gamma delta epsilon zeta", "start stop"]
    benchmark = spark.createDataFrame([(i, x, 4) for i, x in enumerate(items)], ITEMS)
    texts = ["Start alpha beta gamma delta epsilon zeta stop", "none", None, "gamma delta epsilon zeta x"]
    given = documents(spark, texts)
    left = decontaminate.decontaminate(given, benchmark, remove="spans")
    assert left.columns == given.columns
    assert rows_of(left, "doc_id", "text") == [(0, "Start  stop"), (1, "none"), (2, None), (3, " x")]


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], ITEMS)
    docs = documents(spark, ["a b", "a b"])
    scanned = decontaminate.digest(decontaminate.scan(docs, benchmark))
    assert rows_of(scanned, "n_words", "n_hit", "contaminated") == [(2, 0, False)] * 2
    assert decontaminate.decontaminate(docs, benchmark).count() == 2
    assert decontaminate.scan(docs.where("false"), benchmark).collect() == []
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, benchmark, remove="words")
