"""Files that are one JSON object, read in byte ranges, against the whole text parsed at once."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from logscore.sources.features import read_features
from logscore.sources.json_object import json_members

NASTY = ["plain", "}", "{", '"', "\\", '\\"}', ",", "[,]", "}}{{", "é ü", "\n", '{"a": 1}', "", "\\\\"]


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of the given size, one to a task."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}

    def of(size):
        for key in keys:
            spark.conf.set(key, str(size))

    yield of
    for key, value in before.items():
        spark.conf.set(key, value)


def value(rng, depth=0):
    kind = rng.randint(0, 6 if depth < 3 else 3)
    if kind <= 1:
        return rng.choice(NASTY) + rng.choice(NASTY)
    if kind <= 3:
        return rng.choice([None, True, 12, -1.5])
    if kind == 4:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(NASTY): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def members(spark, path):
    rows = json_members(spark, str(path)).orderBy("file", "member").collect()
    return [r.text for r in rows]


@pytest.mark.parametrize("size", [7, 40, 300, 1 << 20])
@pytest.mark.parametrize("seed", range(3))
def test_members_against_the_whole_text(spark, small_ranges, tmp_path, size, seed):
    rng = random.Random(seed)
    wanted = {f"{rng.choice(NASTY)}{i}": value(rng) for i in range(25)}
    path = tmp_path / "f.json"
    path.write_text(json.dumps(wanted, indent=rng.choice([None, 1]), ensure_ascii=False) + "\n " * seed)
    small_ranges(size)
    found = members(spark, path)
    assert [next(iter(json.loads("{" + m + "}").items())) for m in found] == list(wanted.items())


def test_many_tasks_read_a_file(spark, small_ranges, tmp_path):
    path = tmp_path / "f.json"
    path.write_text(json.dumps({f"user{i}": {"version": f"v{i}"} for i in range(400)}))
    small_ranges(500)
    plan = spark.read.option("lineSep", "}").text(str(path)).select(F.spark_partition_id())
    assert plan.distinct().count() > 10
    rows = read_features(spark, str(path), "json_object").select("user_id", "version").collect()
    assert {r.user_id: r.version for r in rows} == {f"user{i}": f"v{i}" for i in range(400)}


@pytest.mark.parametrize("size", [5, 1 << 20])
@pytest.mark.parametrize(
    "text",
    [
        '{"a": {"version": "1"}', '{"a": {"version": "1"}\n', '{"a": {"version": "1"}}}',
        'x{"a": {"version": "1"}}', '{"a": {"version": "1"}} x', '{"a": {"version": "1"},}',
        '{"a": {"version": "1"} "b": {}}', '{"a": {"version": "1"}, "b": {oops}}', '[{"a": 1}]',
        '{"a": {"version": "1}}', '{"a": {"version": "1"}}{"b": {}}', '"text"', "12", "",
    ],
)
def test_files_that_are_no_object_give_no_rows(spark, small_ranges, tmp_path, text, size):
    path = tmp_path / "f.json"
    path.write_text(text)
    with pytest.raises(ValueError):
        json.loads(text) if not text.startswith(("[", '"', "12")) else json.loads("no object")
    small_ranges(size)
    assert read_features(spark, str(path), "json_object").count() == 0


def test_last_of_a_repeated_user_counts(spark, small_ranges, tmp_path):
    path = tmp_path / "f.json"
    path.write_text('{"a": {"version": "1"}, "b": {"version": "2"}, "a": {"version": "3"}, "c": 7 }\n')
    for size in (6, 1 << 20):
        small_ranges(size)
        rows = read_features(spark, str(path), "json_object").collect()
        assert sorted((r.user_id, r.version) for r in rows) == [("a", "3"), ("b", "2")]
