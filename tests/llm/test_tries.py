from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logscore.llm import tries
from logscore.llm.scan import running
from tests.llm.helpers import SPACED, rows_of

TURNS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)


def brute(rows: list[tuple]) -> list[tuple]:
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv_id].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [t[-1] for t in sorted(x)] for c, x in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
    nodes = defaultdict(set)
    for c, x in rebuilt.items():
        for d in range(len(x) + 1):
            nodes[x[:d]].add(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for x in nodes:
        if x:
            children[x[:-1]] += 1
    for x, members in nodes.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] += x not in children
            saved[x[:d]] += (len(members) - 1) * len(SPACED.findall(x[-1][1])) if x else 0
    return sorted(
        (
            (
                min(members), len(x), min(nodes[x[:-1]]) if x else None, len(members), children[x],
                leaves[x], saved[x],
                hashlib.sha256(
                    ",".join(str(c) for c in sorted(members) if rebuilt[c] == x).encode()
                ).hexdigest(),
            )
            for x, members in nodes.items()
        ),
        key=repr,
    )


def conversations(spark, rows: list[tuple], parts: int = 4):
    return spark.createDataFrame(rows, TURNS).repartition(parts)


def talk(rng: random.Random, count: int, most: int) -> list[tuple]:
    lines = ["Hello there", "yes", "no  it\tis", "", None, "é ü", "a b c d e"]
    rows = []
    for _ in range(count):
        c, n = rng.randint(0, 90), rng.randint(1, most)
        for i in range(n):
            turn = rng.choice([i, i, i, None, 0])
            rows.append((c, turn, rng.choice(["user", "bot", None, "", "1:"]), rng.choice(lines[: 2 + i])))
    return rows


@pytest.mark.parametrize("band", [2, 3, 16])
def test_against_brute_force(spark, band):
    rng = random.Random(band)
    rows = talk(rng, 60, 9) + [(None, 1, "user", "no conversation"), (100, 0, "user", "x")]
    rows += [(120 + i, t, "user", "same") for i in range(30) for t in range(20)]
    df = conversations(spark, rows).withColumn("depth", F.lit("clash")).withColumn("member", F.lit(1))
    assert rows_of(tries.trie(df, band), *COLUMNS) == brute(rows)


def test_deep_conversation_and_repeats(spark):
    """One conversation holds most rows, a good part of them the same row."""
    rows = [(7, i // 3, "user", f"line {i % 5}") for i in range(400)] + [(7, 5, "bot", "again")] * 300
    rows += [(8, i, "user", "line 0") for i in range(5)] + [(0, 0, "user", "line 0")]
    assert rows_of(tries.trie(conversations(spark, rows), 4), *COLUMNS) == brute(rows)


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(tries, "IDS_PER_ROW", 7)
    rows = [(c, 0, "user", "the same first and only turn") for c in range(-30, 500)]
    assert rows_of(tries.trie(conversations(spark, rows)), *COLUMNS) == brute_signed(rows)


def brute_signed(rows: list[tuple]) -> list[tuple]:
    """As `brute`, with the sign of c % 20 that SQL gives it."""
    shift = {c: (c % 20 if c >= 0 else -(-c % 20)) for c, *_ in rows}
    text = (rows[0][2], rows[0][3])
    full = [
        c for c in shift
        if zlib.crc32(str(c).encode()) % 4 == 0 or (c - shift[c]) in shift
    ]
    rest = sorted(set(shift) - set(full))

    def digest(ids):
        return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()

    words = len(SPACED.findall(text[1]))
    saved = (len(full) - 1) * words
    return sorted(
        [
            (min(shift), 0, None, len(shift), 1, 1, saved, digest(rest)),
            (min(full), 1, min(shift), len(full), 0, 1, saved, digest(full)),
        ],
        key=repr,
    )


def test_empty_table(spark):
    assert tries.trie(conversations(spark, [])).collect() == []


def test_running_over_one_key(spark):
    """One key lies in several tasks; rows that repeat are numbered too."""
    df = spark.range(1000, numPartitions=7).selectExpr("1L AS key", "id % 3 AS at", "id AS x")
    rows = running(df, "key", ["at"], number="n", xors=["x"]).collect()
    assert sorted(r.n for r in rows) == list(range(1, 1001))
    assert [r["at"] for r in sorted(rows, key=lambda r: r.n)] == sorted(r["at"] for r in rows)
    total = 0
    for i in range(1000):
        total ^= i
    assert max(rows, key=lambda r: r.n).x == total
