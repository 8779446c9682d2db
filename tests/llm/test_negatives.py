from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from logscore.llm import negatives
from tests.llm.helpers import rows_of

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows: list[tuple]) -> list[tuple]:
    kept = {}
    for vec_id, vector, label in rows:
        if label is not None and vector is not None:
            if all(x is not None and math.isfinite(x) for x in vector):
                v = [math.floor(256 * float(np.float32(x))) for x in vector]
                kept[vec_id, label, tuple(v)] = None
    found = []
    for a, label, v in kept:
        if a % 10:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, w, strict=False)), b, other) for b, other, w in kept if b != a
        ]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:5]:
            fits = sorted(
                (s, b) for s, b, other in scored if other != label and -80 * p <= -100 * s <= -100 * p
            )
            for rank, (s, b) in enumerate(fits[:5], 1):
                found.append((a, positive, rank, b, -p, -s))
    return sorted(found, key=repr)


def mined(spark, rows: list[tuple]) -> list[tuple]:
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("norm", F.lit("clash"))
    return rows_of(negatives.mine(negatives.integer_vectors(df), F.col("vec_id") % 10 == 0), *COLUMNS)


def vectors(seed: int, count: int, width: int, copies: int = 0) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for i in range(count):
        v = centres[rng.integers(6)] * rng.uniform(0.1, 2) + 0.2 * rng.normal(size=width)
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(4))))
    rows += [(count + i, rows[0][1], i % 4) for i in range(copies)]
    return rows


@pytest.mark.parametrize("seed,width", [(1, 3), (2, 16), (3, 1)])
def test_against_brute_force(spark, monkeypatch, seed, width):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "CHUNK_BYTES", 8 * width * 20)
    rows = vectors(seed, 300, width, copies=100)
    assert mined(spark, rows) == brute(rows)


def test_nulls_zeros_ragged_and_repeats(spark):
    rows = vectors(5, 60, 4)
    rows += [(60, None, 1), (61, [1.0, None], 1), (62, [math.nan, 1.0], 1), (63, [math.inf], 1)]
    rows += [(64, [1.0, 2.0], None), (70, [0.0, 0.0], 1), (71, [], 2), (80, [0.5], 3), (81, [0.5] * 9, 3)]
    rows += [rows[0], rows[1], rows[10], (10, [0.1, 0.2], 2), (20, rows[20][1], 3)]
    assert mined(spark, rows) == brute(rows)


def test_large_numbers(spark):
    rows = [(i, [float(i * 9000 - 400000), 900000.0, 0.5 * i], i % 3) for i in range(40)]
    rows += [(40, [3e38, 1.0, 1.0], 1)]  # beyond 64-bit scores
    assert mined(spark, rows) == brute(rows[:-1])


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_bounds_hold_and_pass_most_rows_over():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 32))
    x = centres[rng.integers(8, size=2000)] + 0.1 * rng.normal(size=(2000, 32))
    units = x / np.linalg.norm(x, axis=1)[:, None]
    directions = centres / np.linalg.norm(centres, axis=1)[:, None]
    angles = np.arccos(np.clip(units @ directions.T, -1, 1))
    least, most = negatives.cosine_bounds(angles, angles, angles[:100])
    cosine = units[:100] @ units.T
    assert (least <= cosine + 1e-12).all() and (cosine <= most + 1e-12).all()
    assert (most < 0.8).mean() > 0.8
