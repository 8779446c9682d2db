from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from logscore import LOGIN, Schema, check, valid_rows
from logscore.operators.decode import decode, is_json

A = Schema("a", {"a": "int", "b": "str"}, ("a",))

# Text, then what the reader that rejects trailing text and the one that ignores it say:
# None for a message, else the reason.
BAD, NO_OBJECT = "malformed JSON", "not a JSON object"
TEXTS = [
    ('{"a":1}', None, None),
    (' \t{"a":1}\r\n ', None, None),
    ('{"a":1} rest', BAD, None),
    ('{"a":1}{"a":2}', BAD, None),
    ('{"a":1},{"a":2}', BAD, None),
    ('{"a":1}]', BAD, None),
    ('{"a":1}],"z":[1', BAD, None),
    ('{"a":1}}', BAD, None),
    ('{"a":1}]}', BAD, None),
    ('{"a":1', BAD, BAD),
    ('{"a":1,}', BAD, BAD),
    ("{'a':1}", BAD, BAD),
    ("{a:1}", BAD, BAD),
    ('{"a":01}', BAD, BAD),
    ('{"a":1,"b":"\t"}', BAD, BAD),
    ('// note\n{"a":1}', BAD, BAD),
    ("", BAD, BAD),
    ("  ", BAD, BAD),
    ("rest", BAD, BAD),
    ("1,2", BAD, BAD),
    ("1]", BAD, BAD),
    ('[{"a":1}]', NO_OBJECT, NO_OBJECT),
    ("[]", NO_OBJECT, NO_OBJECT),
    ("null", NO_OBJECT, NO_OBJECT),
    ("12", NO_OBJECT, NO_OBJECT),
    ('"text"', NO_OBJECT, NO_OBJECT),
    (" true ", NO_OBJECT, NO_OBJECT),
    (None, BAD, BAD),
    # Of a key given twice the last one counts, inside values too.
    ('{"a":"x","a":1}', None, None),
    ('{"a":1,"c":{"k":1,"k":2}}', None, None),
]


@pytest.mark.parametrize(("policy", "column"), [("lenient", 1), ("pydantic", 1), ("strict", 2)])
def test_texts(spark, policy, column):
    rows = [(n, case[0]) for n, case in enumerate(TEXTS)]
    raw = spark.createDataFrame(rows, "n int, value string")
    got = {TEXTS[r.n][0]: r.reject_reason for r in check(raw, A, policy).collect()}
    assert got == {case[0]: case[column] for case in TEXTS}
    valid = {TEXTS[r.n][0] for r in valid_rows(raw, A, policy).collect()}
    assert valid == {case[0] for case in TEXTS if case[column] is None}


def test_empty_objects_and_odd_ends(spark):
    texts = {
        "{}": True,
        " { } ": True,
        "{\n\t}\r\n": True,
        "{}}": False,
        "{{}": False,
        "{},{}": False,
        '{"b":{}': False,
        '{"b":"}': False,
        '{"b":"{}': False,
        '{"b":"\\}': False,
        '{"b":"é}"}': True,
        '{"b":"{"}': True,
        '{"b":{}}': True,
        '{"b":[]} ': True,
        "}": False,
    }
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    schema = Schema("b", {"b": "str"})
    got = {r.value: r.reject_reason is None for r in check(raw, schema, "lenient").collect()}
    assert got == texts


def test_is_json(spark):
    rows = [(n, case[0]) for n, case in enumerate(TEXTS)]
    raw = spark.createDataFrame(rows, "n int, value string")
    good = {TEXTS[r.n][0] for r in raw.where(is_json()).collect()}
    assert good == {case[0] for case in TEXTS if case[1] != BAD}


def test_last_of_a_repeated_key_and_numbers_that_are_none(spark):
    raw = spark.createDataFrame(
        [('{"f":1.0,"f":2.5}',), ('{"f":NaN}',), ('{"f":-Infinity}',), ('{"g":NaN}',)],
        "value string",
    )
    schema = Schema("f", {"f": "float"})
    assert [str(r.f) for r in valid_rows(raw, schema, "pydantic").collect()] == [
        "2.5", "nan", "-inf", "None",
    ]
    for policy in ("lenient", "strict"):
        assert [r.f for r in valid_rows(raw, schema, policy).collect()] == [2.5]


def test_absent_null_and_wrong_type_stay_apart(spark):
    raw = spark.createDataFrame([('{"a":null,"b":{"c":[1]}}',)], "value string")
    row = decode(raw, ["a", "b", "c"]).select(
        "_is_object",
        F.is_variant_null("_message.a").alias("a_null"),
        F.schema_of_variant("_message.b").alias("b"),
        F.col("_message.c").isNull().alias("c_absent"),
    )
    assert tuple(row.first()) == (True, True, "OBJECT<c: ARRAY<BIGINT>>", True)


def test_repeated_key_inside_a_field_never_passes_for_an_absent_field(spark):
    """With the session setting off such a value cannot be built; the message is then rejected."""
    raw = spark.createDataFrame([('{"a":1,"b":{"k":1,"k":2}}',)], "value string")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        for policy in ("pydantic", "lenient", "strict"):
            reasons = [r.reject_reason for r in check(raw, A, policy).collect()]
            assert reasons == ["malformed JSON"]
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    assert [r.b for r in valid_rows(raw, A, "lenient").collect()] == ['{"k":2}']


def test_bytes(spark):
    raw = spark.createDataFrame(
        [(bytearray(b'{"a":1,"b":"\xc3\xa9"}'),), (bytearray(b'{"a":2,"b":"\xff"}'),)],
        "value binary",
    )
    assert [(r.a, r.b) for r in valid_rows(raw, A, "pydantic").collect()] == [(1, "é")]
    assert [(r.a, r.b) for r in valid_rows(raw, A, "lenient").collect()] == [(1, "é"), (2, "�")]
    assert [r.reject_reason for r in check(raw, A, "pydantic").collect()] == [
        None, "malformed JSON",
    ]


def test_messages_of_any_length_are_read_whole(spark):
    text = "x" * 300_000
    raw = spark.createDataFrame([('{"a":1,"b":"' + text + '"}',)], "value string")
    assert valid_rows(raw, A).first().b == text


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("policy", ["pydantic", "lenient", "strict"])
def test_each_message_is_parsed_once(spark, policy):
    raw = spark.createDataFrame([("{}",)], "value string")
    text = plan(valid_rows(raw, LOGIN, policy))
    assert text.count("from_json") == 1
    assert "parse_json" not in text
