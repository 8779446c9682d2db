"""What the plans look like, and that one very active user does not sit in one task."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from logscore import (
    EXFIL,
    LOGIN,
    LoginAnomaly,
    check,
    login_anomaly_pandas,
    rejected_rows,
    score_messages,
    valid_rows,
)
from logscore.plans.queries import flat_events
from logscore.sources.features import open_by_user, read_features, save_by_user
from logscore.sources.tables import raw_login, user_features

FOLDER = "/root/testdata/sf0.01"
AS_OF = "2024-02-01T00:00:00.000000Z"


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Messages as text and features as a table; every third message is of user 1."""
    folder = tmp_path_factory.mktemp("stored")
    hot = F.regexp_replace("value", '"user_id":"[0-9]+"', '"user_id":"1"')
    raw = raw_login(spark, FOLDER).withColumn(
        "value", F.when(F.col("offset") % 3 == 0, hot).otherwise(F.col("value"))
    )
    raw.select("value").repartition(8).write.text(str(folder / "messages"))
    user_features(spark, FOLDER).write.parquet(str(folder / "features"))
    return (
        spark.read.text(str(folder / "messages")),
        read_features(spark, str(folder / "features")),
    )


def test_bucketed_features_are_not_shuffled(spark, stored, tmp_path):
    """Neither in the session that wrote them nor in one that only knows the files."""
    raw, features = stored
    path = str(tmp_path / "by_user")
    written = save_by_user(features, "features_by_user", 6, path)
    opened = open_by_user(spark, "features_opened", 6, path)
    expected = sorted(map(str, features.collect()))
    for table in (written, opened):
        assert sorted(map(str, table.collect())) == expected
        with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
            events = score_messages(raw, LOGIN, table, LoginAnomaly(), as_of=AS_OF)
            plan = query(events).executedPlan().toString()
            assert "SortMergeJoin" in plan and "Bucketed: true" in plan
            # One shuffle, of the messages, by the buckets of the table.
            assert plan.count("Exchange ") == 1 and "hashpartitioning(user_id" in plan
            assert "6)" in re.search(r"Exchange hashpartitioning\((.*)", plan)[1]
            joined = sorted(map(str, events.collect()))
        plain = score_messages(raw, LOGIN, features, LoginAnomaly(), as_of=AS_OF)
        assert joined == sorted(map(str, plain.collect()))
    spark.sql("DROP TABLE features_by_user")
    spark.sql("DROP TABLE features_opened")


def query(df):
    return df._jdf.queryExecution()


def events(stored, model=None, **options):
    raw, features = stored
    return score_messages(raw, LOGIN, features, model or LoginAnomaly(), as_of=AS_OF, **options)


def rows(df):
    return sorted(map(str, flat_events(df).collect()))


@pytest.mark.parametrize("unknown_users", ["score", "skip"])
def test_scored_before_the_lookup_and_parsed_once(spark, stored, unknown_users):
    plan = query(events(stored, unknown_users=unknown_users)).optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert plan.count("parse_json") == 0
    lines = plan.splitlines()
    join = next(n for n, line in enumerate(lines) if " Join " in line or line.startswith("+- Join"))
    threshold = next(n for n, line in enumerate(lines) if ">= 0.5" in line)
    assert threshold > join


def test_check_parses_once(spark, stored):
    plan = query(check(stored[0], LOGIN).where("reject_reason IS NULL")).optimizedPlan().toString()
    # The second one looks at texts that hold no message.
    assert plan.count("StructField(event_id,VariantType") == 1


def test_small_features_cause_no_shuffle(spark, stored):
    plan = query(events(stored)).executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


@pytest.mark.parametrize("model", [LoginAnomaly(), login_anomaly_pandas()], ids=["columns", "pandas"])
def test_large_features_cause_one_shuffle_per_side(spark, stored, model):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = query(events(stored, model)).executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert "SortMergeJoin" in plan


def test_only_what_the_event_needs_is_shuffled(spark, stored):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__debug__maxToStringFields="100",
    ):
        plan = query(events(stored)).executedPlan().toString()
        assert "log_type" not in plan.split("SortMergeJoin")[0]
        sides = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert all("user_id" in line for line in sides)


@pytest.mark.parametrize("unknown_users", ["score", "skip"])
def test_hot_user_is_split_at_run_time(spark, stored, unknown_users):
    expected = rows(events(stored, unknown_users=unknown_users))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    ):
        df = flat_events(events(stored, unknown_users=unknown_users))
        got = sorted(map(str, df.collect()))
        assert "SortMergeJoin(skew=true)" in query(df).executedPlan().toString()
    assert got == expected


@pytest.mark.parametrize("unknown_users", ["score", "skip"])
def test_hot_user_is_spread_by_salt(spark, stored, unknown_users):
    """Without run-time splitting: the largest task holds a small share of the hot user's rows."""
    plain = events(stored, unknown_users=unknown_users)
    hot = plain.where("user_id = '1'").count()
    assert hot > plain.count() / 4

    def largest_task(df):
        hot_rows = df.where("user_id = '1'").groupBy(F.spark_partition_id()).count()
        return hot_rows.agg(F.max("count")).first()[0]

    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
        spark__sql__shuffle__partitions="32",
    ):
        salted = events(stored, unknown_users=unknown_users, salt=16)
        assert largest_task(events(stored, unknown_users=unknown_users)) == hot
        assert largest_task(salted) < hot / 2
        assert rows(salted) == rows(plain)


def test_batch_counts_are_summed_before_the_shuffle(spark, stored):
    from logscore import batch_counts

    flagged = check(raw_login(spark, FOLDER), LOGIN)
    plan = query(batch_counts(flagged)).executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning(batch_id")
    assert "partial_count" in plan[shuffle:]
    assert "partial_count" not in plan[:shuffle]


@pytest.mark.parametrize("policy", ["pydantic", "lenient", "strict"])
def test_generated_methods_stay_small_enough_to_be_compiled(spark, stored, policy):
    """The JVM only interprets methods above 8,000 bytes."""
    raw, _ = stored
    with settings(spark, spark__sql__adaptive__enabled="false"):
        for df in (
            valid_rows(raw, LOGIN, policy),
            valid_rows(raw, EXFIL, policy),
            check(raw, LOGIN, policy),
            rejected_rows(raw, LOGIN, policy),
            events(stored, policy=policy),
            events(stored, policy=policy, unknown_users="skip", counters=True),
        ):
            explain = spark._jvm.PythonSQLUtils.explainString(query(df), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", explain)]
            assert max(sizes, default=0) < 8000
