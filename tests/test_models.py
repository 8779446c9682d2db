from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from logscore import (
    EXFIL,
    LOGIN,
    LoginAnomaly,
    PandasModel,
    find_schema,
    login_anomaly_pandas,
    score_messages,
    sink_records,
)
from logscore.functions.identity import event_time, uniform_of
from logscore.operators.envelope import EVENT_COLUMNS, envelope, model_name
from logscore.operators.scoring import base_score, known, reason
from logscore.sources.features import FEATURES_SCHEMA, no_features


def message(number, user, **changes):
    return {
        "event_id": f"{number:08x}-0000-4000-8000-000000000000",
        "log_type": "login",
        "ip_address": f"10.0.0.{number}",
        "event_timestamp": "2024-02-10T00:00:00Z",
        "user_id": user,
        "country_code": "US",
    } | changes


def raw(spark, *messages):
    return spark.createDataFrame([(json.dumps(m),) for m in messages], "value string")


def feature(user, risk=None, freq=None, empty=False):
    if empty:
        return (user, None, None, None, None)
    return (user, "1", ([], risk), ([], "api"), ([], freq))


@pytest.fixture(scope="module")
def features(spark):
    rows = [
        feature("abc", 0.1, 0.0),
        feature("def", 0.8, 5.0),
        feature("hot", 0.9, 0.0),
        feature("far", 0.1, 5.0),
        feature("half", 0.5, 0.0),
        feature("blank", empty=True),
    ]
    return spark.createDataFrame(rows, FEATURES_SCHEMA)


# user -> (base score, reason)
EXPECTED = {
    "abc": (0.15, "unusual_country"),
    "def": (1.0, "high_risk_ip"),
    "hot": (1.0, "high_risk_ip"),
    "far": (0.9, "unusual_country"),
    "half": (0.75, "unusual_country"),
    "blank": (0.0, "unusual_country"),
    "unknown": (0.0, "unusual_country"),
}
MODELS = {"columns": LoginAnomaly, "pandas": login_anomaly_pandas}


@pytest.mark.parametrize("make", MODELS.values(), ids=MODELS)
def test_base_score_and_reason(spark, features, make):
    messages = raw(spark, *(message(n, user) for n, user in enumerate(EXPECTED)))
    events = score_messages(messages, LOGIN, features, make(threshold=0.0)).collect()
    assert {e.user_id: e.data.reason for e in events} == {u: r for u, (_, r) in EXPECTED.items()}
    for event in events:
        assert event.data.base_score == pytest.approx(EXPECTED[event.user_id][0])
        assert 0.0 <= event.score < 1.0
        assert event.data.country_code == "US" and event.data.user_agent is None
        assert event.model_id == "loginanomaly"


@pytest.mark.parametrize("make", MODELS.values(), ids=MODELS)
def test_unknown_users_skipped(spark, features, make):
    messages = raw(spark, *(message(n, user) for n, user in enumerate(EXPECTED)))
    events = score_messages(
        messages, LOGIN, features, make(threshold=0.0), unknown_users="skip"
    ).collect()
    assert {e.user_id for e in events} == EXPECTED.keys() - {"blank", "unknown"}


@pytest.mark.parametrize("make", MODELS.values(), ids=MODELS)
@pytest.mark.parametrize("policy", ["pydantic", "lenient", "strict"])
def test_messages_without_a_user_make_no_event(spark, features, make, policy):
    messages = raw(spark, message(1, ""), message(2, None), message(3, "abc"))
    events = score_messages(messages, LOGIN, features, make(threshold=0.0), policy=policy)
    assert [e.user_id for e in events.collect()] == ["abc"]


def test_threshold_is_inclusive(spark, features):
    messages = raw(spark, message(1, "abc"))
    exact = messages.select(uniform_of(F.lit(message(1, "abc")["event_id"]))).first()[0]
    for threshold, expected in ((exact, 1), (exact + 1e-9, 0), (0, 1)):
        events = score_messages(messages, LOGIN, features, LoginAnomaly(threshold=threshold))
        assert events.count() == expected


def test_default_threshold_keeps_about_half(spark):
    messages = raw(spark, *(message(n, "u") for n in range(1000)))
    events = score_messages(messages, LOGIN, no_features(spark), LoginAnomaly())
    scores = [e.score for e in events.collect()]
    assert 430 < len(scores) < 570 and min(scores) >= 0.5


def test_random_scores_differ_between_runs(spark, features):
    messages = raw(spark, *(message(n, "abc") for n in range(50)))

    def scores(model):
        rows = score_messages(messages, LOGIN, features, model).collect()
        return sorted(e.score for e in rows)

    assert scores(LoginAnomaly()) == scores(LoginAnomaly())
    drawn = scores(LoginAnomaly(score="rand"))
    assert drawn != scores(LoginAnomaly(score="rand"))
    assert all(0.5 <= s < 1 for s in drawn)
    with pytest.raises(ValueError, match="score"):
        scores(LoginAnomaly(score="dice"))


def test_score_of_the_callers_own(spark, features):
    own = F.when(F.col("log_type") == "login", base_score(known("risk_score"), known("travel_freq")))
    messages = raw(spark, message(1, "abc"), message(2, "def"), message(3, "def", log_type="x"))
    events = score_messages(messages, LOGIN, features, LoginAnomaly(score=own)).collect()
    assert [(e.user_id, e.score) for e in events] == [("def", 1.0)]


def test_any_python_over_batches(spark, features):
    def longest_agent(frame):
        frame = frame[frame["device_type"] == "api"]
        return frame.assign(score=frame["user_agent"].str.len() / 10.0, note="seen")

    model = PandasModel(
        longest_agent,
        adds="score double, note string",
        data=("note", "ip_address"),
        model_id="agents",
        features=lambda: {"device_type": F.col("user_agent_profile.device_type")},
    )
    messages = raw(
        spark, message(1, "abc", user_agent="curl"), message(2, "unknown", user_agent="x")
    )
    events = score_messages(messages, LOGIN, features, model).collect()
    assert [(e.user_id, e.score, e.data.asDict(), e.model_id) for e in events] == [
        ("abc", 0.4, {"note": "seen", "ip_address": "10.0.0.1"}, "agents")
    ]


UUID4 = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}")


def test_ids(spark, features):
    messages = raw(spark, message(1, "abc"), message(2, "abc"))

    def ids(**options):
        model = LoginAnomaly(threshold=0.0)
        rows = score_messages(messages, LOGIN, features, model, **options).collect()
        assert all(UUID4.fullmatch(e.event_id) for e in rows)
        return {e.event_id for e in rows}

    assert ids() == ids() and len(ids()) == 2
    assert not ids(ids="random") & ids(ids="random")
    with pytest.raises(ValueError, match="ids"):
        ids(ids="none")


def test_messages_told_apart_by_their_place(spark, features):
    rows = [(json.dumps(message(1, "abc")), "t", n) for n in range(3)]
    messages = spark.createDataFrame(rows, "value string, topic string, offset long")
    model = LoginAnomaly(threshold=0.0)
    place = dict(key=("topic", "offset"), carry=("offset",))
    events = score_messages(messages, LOGIN, features, model, **place).collect()
    assert {(e.source_event_id, e.offset) for e in events} == {("t:0", 0), ("t:1", 1), ("t:2", 2)}
    assert len({e.event_id for e in events}) == 3 and len({e.score for e in events}) == 3


@pytest.mark.parametrize("make", MODELS.values(), ids=MODELS)
def test_login_rule_over_another_schema(spark, features, make):
    upload = message(1, "def", file_size=5, destination="host-1")
    events = score_messages(raw(spark, upload), EXFIL, features, make(threshold=0.0)).collect()
    assert [(e.user_id, e.data.ip_address, e.data.user_agent, e.data.reason) for e in events] == [
        ("def", "10.0.0.1", None, "high_risk_ip")
    ]
    assert events[0].data.country_code is None


@pytest.mark.parametrize("make", MODELS.values(), ids=MODELS)
def test_unknown_schema_makes_no_events(spark, features, make):
    messages = raw(spark, message(1, "abc"))
    events = score_messages(messages, find_schema({}, "none"), features, make(threshold=0.0))
    assert events.count() == 0
    known = score_messages(messages, LOGIN, features, make(threshold=0.0))
    assert events.schema.names == known.schema.names


def test_key_must_exist(spark, features):
    with pytest.raises(ValueError, match="offset"):
        score_messages(raw(spark, message(1, "abc")), LOGIN, features, LoginAnomaly(), key=("offset",))


def test_carried_columns_must_not_be_the_events_own(spark, features):
    messages = raw(spark, message(1, "abc")).withColumn("timestamp", F.current_timestamp())
    with pytest.raises(ValueError, match="timestamp"):
        score_messages(messages, LOGIN, features, LoginAnomaly(), carry=("timestamp",))


@pytest.mark.parametrize(
    ("zone", "pattern"),
    [
        ("utc", r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z"),
        ("local", r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}"),
        ("offset", r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+05:30"),
    ],
)
def test_event_time(spark, zone, pattern):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        text, hours = spark.range(1).select(
            event_time(zone),
            (F.unix_timestamp(F.substring(event_time("local"), 1, 19), "yyyy-MM-dd'T'HH:mm:ss")
             - F.unix_timestamp(F.substring(event_time("utc"), 1, 19), "yyyy-MM-dd'T'HH:mm:ss")) / 3600,
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert re.fullmatch(pattern, text)
    assert hours == 5.5
    with pytest.raises(ValueError, match="zone"):
        event_time("moon")


def test_model_name(spark):
    names = spark.createDataFrame([("m",), ("",), (None,)], "m string").select(model_name(F.col("m")))
    assert [r[0] for r in names.collect()] == ["m", "unknown_model", "unknown_model"]
    assert spark.range(1).select(model_name(None), model_name("x")).first()[:] == ("unknown_model", "x")


def test_records(spark, features):
    messages = raw(spark, message(1, "def"))
    events = score_messages(messages, LOGIN, features, LoginAnomaly(threshold=0.0), as_of="then")
    record = sink_records(events).first()
    assert record.__fields__ == ["value"]
    text = json.loads(record.value)
    event = events.first()
    assert list(text) == list(EVENT_COLUMNS)
    assert text == {c: event[c] for c in EVENT_COLUMNS if c != "data"} | {
        "data": {
            "ip_address": "10.0.0.1",
            "country_code": "US",
            "user_agent": None,
            "reason": "high_risk_ip",
            "base_score": 1.0,
        }
    }
    keyed = sink_records(events, key=True).first()
    assert (keyed.key, keyed.value) == (event.event_id, record.value)


def test_missing_data_becomes_an_empty_object(spark):
    scored = spark.sql(
        "SELECT 'u' AS user_id, 0.5D AS score, 's' AS source_event_id,"
        " CAST(NULL AS STRUCT<a: STRING>) AS data"
    )
    text = sink_records(envelope(scored, None, as_of="t")).first().value
    assert json.loads(text)["data"] == {} and json.loads(text)["model_id"] == "unknown_model"


def test_models_with_different_data_share_a_sink(spark, features):
    messages = raw(spark, message(1, "def"))
    login = score_messages(messages, LOGIN, features, LoginAnomaly(threshold=0.0))
    other = envelope(
        spark.sql("SELECT 'u' user_id, 1D score, 's' source_event_id, named_struct('z', 1) data"),
        "other",
    )
    records = sink_records(login).unionByName(sink_records(other))
    assert sorted(len(json.loads(r.value)["data"]) for r in records.collect()) == [1, 5]


def test_reason_is_strictly_above(spark):
    rows = spark.createDataFrame([(0.5,), (0.5000001,)], "risk double").select(reason(F.col("risk")))
    assert [r[0] for r in rows.collect()] == ["unusual_country", "high_risk_ip"]


def test_empty_batch(spark, features):
    empty = raw(spark, message(1, "abc")).limit(0)
    for make in MODELS.values():
        assert score_messages(empty, LOGIN, features, make()).count() == 0
