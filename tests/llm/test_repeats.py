from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from logscore.llm import bwt, repeats
from tests.llm.helpers import documents


def brute(rows: list[tuple], length: int) -> list[tuple]:
    least: dict[bytes, int] = defaultdict(lambda: 1 << 62)
    texts = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    for doc_id, text in texts:
        for i in range(len(text) - length + 1) if doc_id is not None else ():
            window = text[i : i + length]
            least[window] = min(least[window], doc_id)
    result = []
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1) if doc_id is not None else ():
            if least[text[i : i + length]] < doc_id:
                gone[i : i + length] = b"\1" * length
        runs = bytes(gone).split(b"\0")
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        result.append((doc_id, len(text), sum(gone), sum(1 for r in runs if r), kept))
    return sorted(result, key=repr)


def found(df) -> list[tuple]:
    rows = df.collect()
    for row in rows:
        assert all(a.end < b.begin for a, b in zip(row.spans[:-1], row.spans[1:], strict=True))
    return sorted(
        (
            (r.doc_id, r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), bytes(r.kept))
            for r in rows
        ),
        key=repr,
    )


@pytest.mark.parametrize("seed", range(4))
def test_merge_against_sorting(seed):
    rng = random.Random(seed)
    for length in (2, 6, 10):
        strings = [
            bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randint(2, 30))) for _ in range(60)
        ]
        strings += strings[:9]
        shards, where = [], []
        for part in (strings[i::4] for i in range(4)):
            data = np.frombuffer(b"".join(part), np.uint8)
            shards.append(bwt.transform(data, np.cumsum([0, *map(len, part)])))
            suffixes = [x[i:] for x in part for i in range(len(x) + 1)]
            where += [suffixes[k] for k in shards[-1].place]
        order, starts = bwt.merge(shards, length)
        merged = [where[r] for r in order]
        assert sorted(order) == list(range(len(where)))
        assert [s[:length] for s in merged] == sorted(s[:length] for s in merged)
        runs = zip(merged[1:], merged[:-1], strict=True)
        new = [len(a) < length or a[:length] != b[:length] for a, b in runs]
        assert starts.tolist() == [0, *(i + 1 for i, x in enumerate(new) if x)]


def texts(seed: int) -> list:
    rng = random.Random(seed)
    words = [rng.choice("abcdé") * rng.randint(1, 7) for _ in range(40)]
    passages = [" ".join(rng.choices(words, k=rng.randint(10, 60))) for _ in range(8)]
    made = []
    for _ in range(60):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(3)]
        made.append(parts[0] + rng.choice(passages) + parts[1] + rng.choice(["", *passages]) + parts[2])
    made += [made[3], made[4], None, "", "short", "ab" * 900, "ab" * 700, "ba" * 30, "x" * 49, "x" * 50]
    made += ["x" * 50, "y" * 3000, "\0" * 60, "\0" * 61, "é" * 25, "aé" * 40]
    rng.shuffle(made)
    return made


@pytest.mark.parametrize("hot", [0, 1, 4096])
def test_against_all_windows(spark, monkeypatch, hot):
    """With every shared anchor split by window, some of them, or none."""
    monkeypatch.setattr(repeats, "HOT_PARTS", {0: 0, 1: 3, 4096: 256}[hot])
    monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
    rows = list(enumerate(texts(hot)))
    result = repeats.cut_repeats(documents(spark, rows, "1 AS part"))
    assert found(result) == brute(rows, 50)


@pytest.mark.parametrize("part_bytes", [1000, 10])
def test_many_parts(spark, part_bytes):
    """Each task's texts in several parts, and texts dealt anew because it would be too many."""
    rows = list(enumerate(texts(5)))
    result = repeats.cut_repeats(documents(spark, rows), part_bytes=part_bytes, group_bytes=500)
    assert found(result) == brute(rows, 50)


def test_many_pieces_of_one_anchor(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_PIECES", 3)
    rng = random.Random(9)
    line = "A LINE THAT VERY MANY OF THE TEXTS HAVE IN THEM"
    words = [f"{i}x" for i in range(60)]
    rows = [
        (i, " ".join(rng.choices(words, k=9)) + line + " ".join(rng.choices(words, k=3)))
        for i in range(200)
    ]
    rows += [(200 + i, rows[i][1][20:]) for i in range(20)]
    assert found(repeats.cut_repeats(documents(spark, rows))) == brute(rows, 50)


def test_repeated_and_null_ids(spark):
    text = "a passage that is longer than fifty bytes and stands here more than once"
    rows = [(7, text), (7, text), (7, text + "!"), (None, text), (9, "x" + text), (None, text), (8, None)]
    assert found(repeats.cut_repeats(documents(spark, rows))) == brute(rows, 50)


def shuffled(df) -> int:
    """Bytes that the shuffles of a query have written; one that is read twice counts once."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "ShuffleExchangeExec":
            total += node.metrics().get("shuffleBytesWritten").get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_text_that_many_parts_have_is_not_sent_by_each(spark):
    """Shuffles stay below the text, though all parts share most of it in other surroundings."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(4000)]
    passage = " ".join(words)
    rows = [(i, f"{' '.join(rng.choices(words, k=20))} {passage}") for i in range(24)]
    result = repeats.cut_repeats(documents(spark, rows), part_bytes=64 << 10)
    assert shuffled(result) < sum(len(text) for _, text in rows)
    kept = {r.doc_id: len(r.kept) for r in result.collect()}
    assert kept[0] == len(rows[0][1]) and all(kept[i] <= 130 for i in range(1, 24))


def test_far_ids_in_many_parts(spark, monkeypatch):
    """Ids that need all their bits, the same ones in several parts, some anchors split by window."""
    monkeypatch.setattr(repeats, "HOT_PIECES", 2)
    rng = random.Random(6)
    ids = [-(1 << 61), -7, 0, 3, 1 << 40, 1 << 61]
    rows = [(rng.choice(ids), text) for text in texts(6)]
    result = repeats.cut_repeats(documents(spark, rows), part_bytes=3000)
    assert found(result) == brute(rows, 50)


def test_empty_table(spark):
    assert repeats.cut_repeats(documents(spark, []).where("false")).collect() == []
