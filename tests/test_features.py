from __future__ import annotations

import json

import pytest

from logscore.operators import features as ops
from logscore.operators.scoring import login_features
from logscore.sources.features import FEATURES_SCHEMA, no_features, read_features

SAMPLE = {
    "ann": {
        "version": "2025-07-01",
        "ip_address_profile": {"frequent_ips": ["172.16.4.9"], "risk_score": 0.25},
        "user_agent_profile": {"common_agents": ["Lynx/2.9"], "device_type": "tablet"},
        "country_code_profile": {"common_countries": ["NZ"], "travel_freq": 0},
    },
    "bob": {
        "version": "2025-07-02",
        "ip_address_profile": {"frequent_ips": ["172.16.8.1"], "risk_score": 0.7},
        "user_agent_profile": {"common_agents": ["wget/1.2"], "device_type": "server"},
        "country_code_profile": {"common_countries": ["CL"], "travel_freq": 4},
    },
    "bare": {},
    "partial": {"ip_address_profile": {"risk_score": 0.9}},
    "odd": {"version": "1", "ip_address_profile": {"risk_score": "high"}},
}


@pytest.fixture
def sample(spark, tmp_path):
    path = tmp_path / "features.json"
    path.write_text(json.dumps(SAMPLE, indent=1))
    return read_features(spark, str(path), "json_object")


def rows_for(spark, *users):
    rows = [(user, f"e{n}") for n, user in enumerate(users)]
    return spark.createDataFrame(rows, "user_id string, event_id string")


def test_object_file(spark, sample):
    assert sample.schema.names == FEATURES_SCHEMA.names
    rows = {r.user_id: r for r in sample.collect()}
    assert rows.keys() == SAMPLE.keys()
    assert rows["ann"].ip_address_profile.risk_score == 0.25
    assert rows["ann"].country_code_profile.travel_freq == 0.0
    assert rows["bob"].country_code_profile.common_countries == ["CL"]
    assert rows["bare"].version is None and rows["bare"].ip_address_profile is None
    # A number that is none is missing, and spares its neighbours.
    assert rows["odd"].ip_address_profile.risk_score is None and rows["odd"].version == "1"


def test_of_a_user_given_twice_the_last_counts(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text('{"a":{"version":"1"},"b":{"version":"2"},"a":{"version":"3"},"c":null}')
    rows = read_features(spark, str(path), "json_object").select("user_id", "version").collect()
    assert sorted(map(tuple, rows)) == [("a", "3"), ("b", "2")]


@pytest.mark.parametrize("layout", ["json_object", "json_lines", "parquet"])
def test_missing_file_gives_no_features(spark, tmp_path, layout):
    empty = read_features(spark, str(tmp_path / "none"), layout)
    assert empty.count() == 0
    assert empty.schema.names == FEATURES_SCHEMA.names


@pytest.mark.parametrize("text", ["", "{", "rest", "[1]", "{}"])
def test_unreadable_file_gives_no_features(spark, tmp_path, text):
    path = tmp_path / "f.json"
    path.write_text(text)
    assert read_features(spark, str(path), "json_object").count() == 0


def test_tables_at_scale(spark, sample, tmp_path):
    expected = sorted(map(str, sample.collect()))
    sample.write.parquet(str(tmp_path / "parquet"))
    sample.write.json(str(tmp_path / "lines"))
    for layout, name in (("parquet", "parquet"), ("json_lines", "lines")):
        back = read_features(spark, str(tmp_path / name), layout)
        assert sorted(map(str, back.collect())) == expected


def test_vector_of_one_user(sample):
    assert ops.feature_vector(sample, "bob").first().version == "2025-07-02"
    assert ops.feature_vector(sample, "unknown").count() == 0


def test_distinct_users(spark):
    rows = rows_for(spark, "a", "b", "a", None, "")
    assert sorted(r.user_id for r in ops.distinct_users(rows).collect()) == ["a", "b"]
    assert ops.distinct_users(rows.drop("user_id")).count() == 0


@pytest.mark.parametrize("salt", [1, 4])
def test_lookup_keeps_unknown_users(spark, sample, salt):
    rows = rows_for(spark, "ann", "unknown", "ann", "bare", "partial")
    got = ops.lookup(rows, sample, login_features(), salt=salt).orderBy("event_id").collect()
    assert [(r.user_id, r.has_features, r.risk_score, r.travel_freq) for r in got] == [
        ("ann", True, 0.25, 0.0),
        ("unknown", False, None, None),
        ("ann", True, 0.25, 0.0),
        ("bare", True, None, None),
        ("partial", True, 0.9, None),
    ]
    assert got[0].__fields__ == ["user_id", "event_id", "risk_score", "travel_freq", "has_features"]


@pytest.mark.parametrize("salt", [1, 4])
def test_lookup_skips_unknown_users_and_empty_vectors(spark, sample, salt):
    rows = rows_for(spark, "ann", "unknown", "bare", "partial")
    got = ops.lookup(rows, sample, login_features(), unknown_users="skip", salt=salt)
    assert sorted(r.user_id for r in got.collect()) == ["ann", "partial"]
    dropped = ops.without_features(rows, sample)
    assert sorted(r.user_id for r in dropped.collect()) == ["bare", "unknown"]


def test_whole_vector(spark, sample):
    got = ops.lookup(rows_for(spark, "bob"), sample).first()
    assert got.user_agent_profile.device_type == "server"


def test_empty_table(spark):
    rows = rows_for(spark, "ann")
    assert ops.lookup(rows, no_features(spark), login_features()).first().has_features is False
    assert ops.lookup(rows, no_features(spark), unknown_users="skip").count() == 0


def test_rows_without_a_user_do_not_meet(spark, sample):
    """Their join key differs from row to row; they stay, or go, as before."""
    rows = rows_for(spark, *["", None] * 20, "ann")
    keys = rows.select(ops._match_key(rows).alias("k")).distinct()
    assert keys.count() == 41
    assert ops.lookup(rows, sample).where("has_features").count() == 1
    assert ops.lookup(rows, sample, unknown_users="skip").count() == 1
    assert ops.without_features(rows, sample).count() == 40


def test_latest_row_of_a_user(spark, tmp_path):
    path = str(tmp_path / "f")
    lines = ['{"user_id":"a","version":"2"}', '{"user_id":"a","version":"10"}', '{"user_id":"b"}']
    spark.createDataFrame([(x,) for x in [*lines, lines[0]]], "value string").write.text(path)
    assert read_features(spark, path, "json_lines").count() == 4
    latest = read_features(spark, path, "json_lines", latest_by="version")
    assert sorted((r.user_id, r.version) for r in latest.collect()) == [("a", "2"), ("b", None)]


def test_features_dealt_once_need_no_exchange(spark, sample):
    kept = ops.by_user(spark.createDataFrame(sample.collect(), sample.schema))
    kept.count()
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        joined = ops.lookup(rows_for(spark, "ann"), kept, login_features())
        plan = joined._jdf.queryExecution().executedPlan().toString()
        joined.collect()
    finally:
        spark.conf.unset(threshold)
        kept.unpersist()
    above_cache = plan.split("InMemoryTableScan")
    assert plan.count("Exchange hashpartitioning") - plan.split("InMemoryRelation")[-1].count("Exchange") == 1
    assert len(above_cache) == 2


def test_only_the_wanted_leaves_are_read(spark, sample, tmp_path):
    path = str(tmp_path / "parquet")
    sample.write.parquet(path)
    features = read_features(spark, path)
    plan = ops.lookup(rows_for(spark, "ann"), features, login_features())._jdf.queryExecution()
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan.executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert (
        "ReadSchema: struct<user_id:string,ip_address_profile:struct<risk_score:double>,"
        "country_code_profile:struct<travel_freq:double>>" in text
    )
