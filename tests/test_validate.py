from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from logscore import EXFIL, LOGIN, Schema, batch_counts, check, find_schema, load_schemas
from logscore import rejected_rows, valid_rows
from logscore.functions.coercion import POLICIES

FULL = {
    "event_id": "6f1c2b9e-58d0-4a77-9c3e-2f4d1e0b7a65",
    "log_type": "signin",
    "ip_address": "172.16.4.9",
    "event_timestamp": "2025-07-01T12:30:00Z",
    "user_id": "ann",
    "user_agent": "Lynx/2.9",
    "country_code": "NZ",
}


def raw(spark, *messages):
    rows = [(n, json.dumps(m)) for n, m in enumerate(messages)]
    return spark.createDataFrame(rows, "n int, value string")


def without(*names, **changes):
    return {k: v for k, v in FULL.items() if k not in names} | changes


@pytest.mark.parametrize("policy", POLICIES)
def test_full_message(spark, policy):
    row = valid_rows(raw(spark, FULL), LOGIN, policy).first()
    assert row.asDict() == {"n": 0} | FULL


def test_an_id_that_is_no_uuid(spark):
    message = raw(spark, FULL | {"event_id": "abc-123"})
    assert valid_rows(message, LOGIN, "pydantic").count() == 0
    assert valid_rows(message, LOGIN, "lenient").count() == 1
    assert valid_rows(message, LOGIN, "strict").count() == 1


@pytest.mark.parametrize("policy", POLICIES)
def test_optional_fields_may_be_absent(spark, policy):
    row = valid_rows(raw(spark, without("user_agent", "country_code")), LOGIN, policy).first()
    assert (row.user_agent, row.country_code) == (None, None)


@pytest.mark.parametrize("policy", POLICIES)
def test_reasons_name_the_first_failing_rule(spark, policy):
    messages = raw(
        spark,
        {"log_type": "login"},
        without("user_id", ip_address=None),
        without("user_id"),
        FULL | {"user_id": None},
        FULL,
    )
    got = {r.n: r.reject_reason for r in check(messages, LOGIN, policy).collect()}
    assert got == {
        0: "missing required field: event_id",
        1: "missing required field: ip_address",
        2: "missing required field: user_id",
        3: "missing required field: user_id",
        4: None,
    }


def test_missing_fields_come_before_wrong_types(spark):
    messages = raw(spark, without("user_id", log_type=5), FULL | {"user_agent": 1, "log_type": 2})
    got = [r.reject_reason for r in rejected_rows(messages, LOGIN).orderBy("n").collect()]
    assert got == ["missing required field: user_id", "field log_type: not acceptable as str"]


@pytest.mark.parametrize("policy", POLICIES)
def test_valid_and_rejected_rows_split_the_input(spark, policy):
    messages = raw(spark, FULL, {}, FULL | {"user_id": 7}, [1], None, FULL | {"user_agent": None})
    flagged = {r.n: r for r in check(messages, LOGIN, policy).collect()}
    valid = {r.n: r for r in valid_rows(messages, LOGIN, policy).collect()}
    rejected = {r.n: r for r in rejected_rows(messages, LOGIN, policy).collect()}
    assert valid.keys() | rejected.keys() == set(range(6))
    assert not valid.keys() & rejected.keys()
    for n, row in flagged.items():
        if n in valid:
            assert row.reject_reason is None
            assert all(row[c] == valid[n][c] for c in LOGIN.fields)
        else:
            assert row.reject_reason == rejected[n].reject_reason
            assert row.value == rejected[n].value
            assert all(row[c] is None for c in LOGIN.fields)


def test_extra_fields_are_dropped_or_kept_whole(spark):
    messages = raw(spark, FULL | {"session": {"id": [1, 2]}})
    assert valid_rows(messages, LOGIN).columns == ["n", *LOGIN.fields]
    kept = valid_rows(messages, LOGIN, "strict", keep_raw=True)
    assert json.loads(kept.select(F.to_json("raw")).first()[0])["session"] == {"id": [1, 2]}


@pytest.mark.parametrize("policy", POLICIES)
def test_required_name_outside_the_fields(spark, policy):
    schema = Schema("s", {"a": "str"}, ("a", "b"))
    messages = raw(spark, {"a": "x"}, {"a": "x", "b": 1}, {"a": "x", "b": None})
    got = [r.n for r in valid_rows(messages, schema, policy).collect()]
    # Strict asks only that the name is there.
    assert got == ([1, 2] if policy == "strict" else [1])
    assert valid_rows(messages, schema, policy).columns == ["n", "a"]


def test_unknown_schema_rejects_everything(spark):
    schema = find_schema({LOGIN.name: LOGIN}, "other")
    messages = raw(spark, FULL, {})
    assert valid_rows(messages, schema).count() == 0
    for rows in (check(messages, schema), rejected_rows(messages, schema)):
        assert {r.reject_reason for r in rows.collect()} == {"schema not found: other"}
        assert rows.count() == 2
    assert find_schema({LOGIN.name: LOGIN}, LOGIN.name) is LOGIN


def test_empty_input(spark):
    empty = raw(spark, FULL).limit(0)
    assert valid_rows(empty, LOGIN).count() == 0
    assert check(empty, LOGIN).count() == 0


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="policy"):
        check(raw(spark, FULL), LOGIN, "loose")


def test_exfil_message(spark):
    message = without("user_agent", "country_code", file_size=10, destination="host-1")
    row = valid_rows(raw(spark, message), EXFIL).first()
    assert (row.file_size, row.destination) == (10, "host-1")


def test_batch_counts(spark):
    rows = [(0, json.dumps(FULL)), (0, "{}"), (1, "rest"), (2, json.dumps(FULL))]
    flagged = check(spark.createDataFrame(rows, "batch_id long, value string"), LOGIN)
    got = {tuple(r) for r in batch_counts(flagged, flagged.where("reject_reason IS NULL AND batch_id = 0")).collect()}
    assert got == {(0, 2, 1, 1, 1), (1, 1, 1, 0, 0), (2, 1, 0, 1, 0)}


def test_schema_files(tmp_path):
    definition = {"name": "T", "fields": {"user_id": "str"}, "required": ["user_id"]}
    (tmp_path / "t.json").write_text(json.dumps(definition))
    (tmp_path / "bare.json").write_text("{}")
    (tmp_path / "note.txt").write_text("{")
    schemas = load_schemas(tmp_path)
    assert schemas == {
        "t": Schema("t", {"user_id": "str"}, ("user_id",)),
        "bare": Schema("bare"),
    }
    (tmp_path / "broken.json").write_text("{")
    with pytest.raises(ValueError):
        load_schemas(tmp_path)
    assert load_schemas(tmp_path, on_error="skip") == schemas


def test_missing_schema_folder_gives_no_schemas(tmp_path):
    assert load_schemas(tmp_path / "none") == {}


def test_keep_raw_never_loses_a_message(spark):
    """Numbers that are none, and keys given twice when the session does not allow them."""
    texts = ['{"a":"x","n":NaN}', '{"a":"x","o":{"k":1,"k":2}}', '{"a":"x"}']
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    setting = "spark.sql.variant.allowDuplicateKeys"
    for allowed in ("true", "false"):
        spark.conf.set(setting, allowed)
        try:
            kept = valid_rows(messages, Schema("s", {"a": "str"}), "pydantic", keep_raw=True)
            assert kept.where("raw IS NULL").count() == 0 and kept.count() == 3
        finally:
            spark.conf.set(setting, "true")


def test_columns_named_like_our_own(spark):
    schema = Schema("s", {"message": "str"})
    rows = spark.createDataFrame([('{"message":"x"}', 1, 2)], "value string, is_object int, n int")
    assert valid_rows(rows, schema).first().asDict() == {"is_object": 1, "n": 2, "message": "x"}
    for taken in ("reject_reason", "_message", "_is_object"):
        with pytest.raises(ValueError, match="rename"):
            check(rows.withColumn(taken, F.lit(1)), schema)
    with pytest.raises(ValueError, match="rename"):
        valid_rows(rows, Schema("s", {"reject_reason": "str"}))
