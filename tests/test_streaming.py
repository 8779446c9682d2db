from __future__ import annotations

import json
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from logscore import LOGIN, LoginAnomaly, PandasModel, deliver, score_messages, start_scoring
from logscore.operators.scoring import MODEL_ERROR, _isolated, login_anomaly_pandas
from logscore.operators.validate import valid_rows
from logscore.plans.queries import flat_events
from logscore.sources.raw import broker_options, read_messages, stream_messages
from logscore.sources.tables import raw_login, user_features
from logscore.streaming.sinks import Batch, broker_writer, file_writer

FOLDER = "/root/testdata/sf0.001"
AS_OF = "2024-02-01T00:00:00.000000Z"
NOW = {"availableNow": True}


def rows(df):
    return sorted(map(str, df.collect()))


def counted(query):
    """Batches, messages fetched and dropped, and events produced, by the progress reports."""
    metrics = [p.observedMetrics for p in query.recentProgress if p.observedMetrics]
    return (
        len(metrics),
        sum(m["messages"].fetched for m in metrics),
        sum(m["messages"].dropped for m in metrics),
        sum(m["events"].produced for m in metrics),
    )


@pytest.fixture(scope="module")
def features(spark):
    return user_features(spark, FOLDER)


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    """The messages as text files in three parts."""
    folder = tmp_path_factory.mktemp("messages")
    raw = raw_login(spark, FOLDER)
    for part in range(3):
        raw.where(F.col("batch_id") % 3 == part).select("value").coalesce(1).write.text(
            str(folder / f"part{part}")
        )
    return folder


def stream_of(spark, folder, pattern="part*"):
    return stream_messages(spark, "text", {"maxFilesPerTrigger": "1"}, f"{folder}/{pattern}")


@pytest.fixture(scope="module")
def batch_events(spark, features):
    events = score_messages(
        raw_login(spark, FOLDER), LOGIN, features, LoginAnomaly(), as_of=AS_OF
    )
    return rows(flat_events(events))


def test_stream_into_a_table_equals_the_batch(spark, messages, features, batch_events, tmp_path):
    events = score_messages(
        stream_of(spark, messages), LOGIN, features, LoginAnomaly(), as_of=AS_OF, counters=True
    )
    query = (
        events.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    assert rows(flat_events(spark.read.parquet(str(tmp_path / "out")))) == batch_events
    assert counted(query) == (3, 1000, 90, len(batch_events))


def start(spark, raw, features, model, tmp_path, **changes):
    settings = {
        "checkpoint": str(tmp_path / "checkpoint"),
        "write": file_writer(str(tmp_path / "out")),
        "trigger": NOW,
        "options": {"as_of": AS_OF},
        "delivery": {"first_wait": 0.0},
    }
    query = start_scoring(raw, LOGIN, features, model, **(settings | changes))
    query.awaitTermination()
    return query


@pytest.mark.parametrize("salt", [1, 4])
def test_stream_through_the_sinks_equals_the_batch(
    spark, messages, features, batch_events, tmp_path, salt
):
    options = {"as_of": AS_OF, "salt": salt}
    raw = stream_of(spark, messages)
    query = start(spark, raw, features, LoginAnomaly(), tmp_path, options=options)
    assert counted(query) == (3, 1000, 90, len(batch_events))
    assert rows(flat_events(spark.read.parquet(str(tmp_path / "out")))) == batch_events


def test_restart_goes_on_where_it_stopped(spark, messages, features, batch_events, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()

    def arrive(part):
        for path in (messages / f"part{part}").glob("*.txt"):
            (incoming / f"{part}-{path.name}").write_bytes(path.read_bytes())

    def run():
        raw = stream_messages(spark, "text", {}, str(incoming))
        start(spark, raw, features, LoginAnomaly(), tmp_path)
        return rows(flat_events(spark.read.parquet(str(tmp_path / "out"))))

    arrive(0)
    first = run()
    assert 0 < len(first) < len(batch_events)
    assert run() == first
    arrive(1)
    arrive(2)
    assert run() == batch_events


def test_replayed_batch_has_the_same_ids(spark, messages, features, tmp_path):
    for name in ("a", "b"):
        folder = tmp_path / name
        folder.mkdir()
        start(spark, stream_of(spark, messages), features, LoginAnomaly(), folder)
    a, b = (spark.read.parquet(str(tmp_path / n / "out")).select("event_id") for n in "ab")
    assert rows(a) == rows(b)


class Sink:
    """Fails a number of times, then keeps what it gets."""

    def __init__(self, failures=0):
        self.failures, self.calls, self.kept = failures, 0, []

    def __call__(self, events, batch=None):
        self.calls += 1
        if self.calls <= self.failures:
            raise OSError("sink is down")
        self.kept += events.collect()


@pytest.fixture
def events(spark):
    return spark.createDataFrame([(1,), (2,)], "n int")


@pytest.mark.parametrize("failures", [0, 1, 2])
def test_retries_until_sent(events, failures):
    main, dead = Sink(failures), Sink()
    assert deliver(events, main, dead, first_wait=0.0) == "sent"
    assert main.calls == failures + 1 and len(main.kept) == 2 and dead.calls == 0


def test_dead_letter_after_the_last_attempt(events):
    main, dead = Sink(3), Sink()
    assert deliver(events, main, dead, first_wait=0.0) == "dead_letter"
    assert main.calls == 3 and sorted(r.n for r in dead.kept) == [1, 2]


def test_waits_double(events, monkeypatch):
    waits = []
    # Only here: threads of finished streams sleep too.
    monkeypatch.setattr("logscore.streaming.sinks.time", SimpleNamespace(sleep=waits.append))
    deliver(events, Sink(9), Sink())
    assert waits == [0.1, 0.2]


def test_both_sinks_down(events):
    assert deliver(events, Sink(9), Sink(9), first_wait=0.0, on_lost="log") == "lost"
    assert deliver(events, Sink(9), first_wait=0.0, on_lost="log") == "lost"
    with pytest.raises(OSError):
        deliver(events, Sink(9), Sink(9), first_wait=0.0)


def test_events_are_computed_once_for_all_attempts(spark):
    drawn = spark.range(20).select(F.rand().alias("r"))
    seen = []

    def write(events, batch):
        seen.append(rows(events))
        raise OSError

    deliver(drawn, write, lambda events, batch: seen.append(rows(events)), first_wait=0.0)
    assert len(seen) == 4 and all(s == seen[0] for s in seen)


def test_only_its_own_cache_is_dropped(spark):
    kept, plain = spark.range(2).persist(), spark.range(3)
    deliver(kept, Sink())
    deliver(plain, Sink())
    assert kept.is_cached and not plain.is_cached
    kept.unpersist()


def test_a_batch_that_cannot_be_computed_is_no_matter_of_the_sinks(spark):
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).alias("e"))
    main, dead = Sink(), Sink()
    with pytest.raises(Exception, match="broken"):
        deliver(broken, main, dead, first_wait=0.0)
    assert main.calls == dead.calls == 0
    assert not broken.is_cached


def test_stream_sends_failed_batches_to_the_dead_letters(
    spark, messages, features, batch_events, tmp_path
):
    good = file_writer(str(tmp_path / "out"))
    sent = []

    def write(batch, which):
        # The second batch never gets through.
        if len(sent) == 1:
            raise OSError("sink is down")
        good(batch, which)
        sent.append(batch)

    dead = file_writer(str(tmp_path / "dead"))

    def write_dead(batch, which):
        sent.append(batch)
        dead(batch, which)

    start(
        spark, stream_of(spark, messages), features, LoginAnomaly(), tmp_path,
        write=write, write_dead_letter=write_dead,
    )
    out, dead_rows = (flat_events(spark.read.parquet(str(tmp_path / n))) for n in ("out", "dead"))
    assert dead_rows.count() > 0
    assert sorted(rows(out) + rows(dead_rows)) == batch_events


def failing_model(user):
    def rule(frame):
        if (frame["user_id"] == user).any():
            raise ValueError("model is broken")
        return frame.assign(score=1.0)

    return PandasModel(rule, adds="score double", data=("ip_address",), model_id="broken")


def test_failing_model_stops_the_stream(spark, messages, features, tmp_path):
    from pyspark.errors import StreamingQueryException

    with pytest.raises(StreamingQueryException):
        start(spark, stream_of(spark, messages), features, failing_model("1"), tmp_path)


def test_failing_model_contained(spark, features, tmp_path):
    """The batch the model fails on is set aside whole, the others go through."""
    incoming = tmp_path / "incoming"
    raw = raw_login(spark, FOLDER)
    for name, chosen in (("a", "batch_id = 0"), ("b", "batch_id = 1"), ("c", "batch_id = 2")):
        part = raw.where(chosen)
        if name != "b":
            part = part.where(~F.col("value").contains('"user_id":"1"'))
        part.select("value").coalesce(1).write.mode("append").text(str(incoming))
    raw_stream = stream_messages(spark, "text", {"maxFilesPerTrigger": "1"}, str(incoming))
    aside = []
    start(
        spark, raw_stream, features, failing_model("1"), tmp_path,
        contain_failures=True, write_failed=lambda batch, which: aside.extend(batch.collect()),
    )
    assert sorted(r.value for r in aside) == sorted(
        r.value for r in raw.where("batch_id = 1").collect()
    )
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_failing_messages_contained(spark, messages, features, batch_events, tmp_path):
    """Only the messages that the model fails on are set aside, as they came, with the error."""
    login, aside, reports = login_anomaly_pandas(), [], []

    def rule(frame):
        bad = frame["user_id"].isin(["1", "2"])
        if bad.any():
            raise ValueError(f"cannot score {sorted(set(frame['user_id'][bad]))[0]}")
        return login.function(frame)

    start(
        spark, stream_of(spark, messages), features, replace(login, function=rule), tmp_path,
        contain_failures="message", on_batch=reports.append,
        write_failed=lambda batch, which: aside.extend(batch.collect()),
    )
    sent = flat_events(spark.read.parquet(str(tmp_path / "out")))
    expected = [e for e in batch_events if "user_id='1'" not in e and "user_id='2'" not in e]
    assert rows(sent) == expected and len(expected) < len(batch_events)
    valid = valid_rows(raw_login(spark, FOLDER), LOGIN).where("user_id IN ('1', '2')")
    valid = sorted((r.event_id, f"ValueError: cannot score {r.user_id}") for r in valid.collect())
    assert sorted((json.loads(r.value)["event_id"], r.model_error) for r in aside) == valid
    assert sum(r.produced for r in reports) == len(expected)


@pytest.mark.parametrize("bad", [(), (0,), (9,), (3, 4), tuple(range(10))])
def test_isolating_model_keeps_order_and_calls_little(bad):
    import pandas as pd

    calls = []

    def function(frame):
        calls.append(len(frame))
        if frame["n"].isin(bad).any():
            raise KeyError("bad")
        return frame[frame["n"] != 5].assign(score=frame["n"] / 10)

    done = list(_isolated(function, ["score"])(pd.DataFrame({"n": range(10)})))
    assert [n for part in done for n in part["n"]] == [n for n in range(10) if n != 5 or n in bad]
    failed = [n for p in done for n, e in zip(p["n"], p[MODEL_ERROR], strict=True) if e]
    assert failed == list(bad)
    assert len(calls) <= 1 + 8 * len(bad)
    (empty,) = _isolated(function, ["score"])(pd.DataFrame({"n": []}))
    assert len(empty) == 0


def test_containment_needs_a_sink_for_what_failed(spark, messages, features, tmp_path):
    with pytest.raises(ValueError, match="write_failed"):
        start(
            spark, stream_of(spark, messages), features, LoginAnomaly(), tmp_path,
            contain_failures=True,
        )


def test_text_sink(spark, tmp_path):
    features, raw = user_features(spark, FOLDER), raw_login(spark, FOLDER)
    events = score_messages(raw, LOGIN, features, LoginAnomaly(), as_of=AS_OF)
    assert deliver(events, file_writer(str(tmp_path / "out"), "text")) == "sent"
    assert read_messages(spark, "text", {}, str(tmp_path / "out")).count() == events.count()


def test_broker_options():
    assert broker_options("host:9092", "logs") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "logs",
        "startingOffsets": "earliest",
    }
    more = broker_options("host:9092", "logs", start="latest", per_batch=100, min_partitions=64)
    assert more["startingOffsets"] == "latest"
    assert more["maxOffsetsPerTrigger"] == "100" and more["minPartitions"] == "64"


def test_broker_writer_sets_servers_topic_and_options(spark, features, monkeypatch):
    """No connector here: what would be handed to it is looked at instead."""
    from pyspark.sql.readwriter import DataFrameWriter

    seen = {}

    def save(self):
        seen["columns"] = None

    monkeypatch.setattr(DataFrameWriter, "format", lambda self, name: seen.update(format=name) or self)
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: seen.update(o) or self)
    monkeypatch.setattr(DataFrameWriter, "save", save)
    events = score_messages(raw_login(spark, FOLDER), LOGIN, features, LoginAnomaly())
    broker_writer("host:9092", "events", {"kafka.acks": "all"}, key=True)(events, Batch())
    assert seen == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "topic": "events",
        "kafka.acks": "all",
        "columns": None,
    }


class Picky(Sink):
    """Refuses batches that hold a refused number."""

    def __init__(self, *refused):
        super().__init__()
        self.refused = set(refused)

    def __call__(self, events, batch=None):
        self.calls += 1
        found = events.collect()
        if self.refused & {r.n for r in found}:
            raise OSError("refused")
        self.kept += found


def test_only_what_is_refused_goes_to_the_dead_letters(spark):
    events = spark.range(300).toDF("n")
    main, dead = Picky(17, 230), Sink()
    assert deliver(events, main, dead, first_wait=0.0, part_by="n") == "dead_letter"
    assert sorted(r.n for r in dead.kept) == [17, 230]
    assert sorted(r.n for r in main.kept) == [n for n in range(300) if n not in (17, 230)]


def test_refused_events_in_each_first_part_are_found(spark):
    """Good events are sent although every part of the first cut is refused."""
    place = F.pmod(F.xxhash64("n"), F.lit(16)).alias("part")
    events = spark.range(120).toDF("n")
    first = events.groupBy(place).agg(F.min("n").alias("n")).collect()
    refused = [r.n for r in first]
    assert len(refused) == 16
    main, dead = Picky(*refused), Sink()
    assert deliver(events, main, dead, first_wait=0.0, part_by="n") == "dead_letter"
    assert sorted(r.n for r in dead.kept) == sorted(refused)
    assert sorted(r.n for r in main.kept) == [n for n in range(120) if n not in refused]


def test_a_dead_sink_is_found_by_single_events(spark):
    main, dead = Sink(10_000), Sink()
    assert deliver(spark.range(400).toDF("n"), main, dead, first_wait=0.0, part_by="n") == "dead_letter"
    assert sorted(r.n for r in dead.kept) == list(range(400))
    assert main.calls < 100


def test_repeatable_batches_are_written_at_once(spark):
    """Nothing is computed before the first write; after a failure the rows are kept."""
    main = Sink(1)
    assert deliver(spark.range(5), main, Sink(), first_wait=0.0, repeatable=True) == "sent"
    assert main.calls == 2 and len(main.kept) == 5
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).alias("e"))

    def write(events, batch):
        events.collect()

    dead = Sink()
    with pytest.raises(Exception, match="broken"):
        deliver(broken, write, dead, first_wait=0.0, repeatable=True)
    assert dead.calls == 0


def test_a_replayed_batch_replaces_what_it_wrote(spark, tmp_path):
    write, folder = file_writer(str(tmp_path / "out")), str(tmp_path / "out")
    for batch in (Batch(1, "3"), Batch(1, "a"), Batch(2), Batch(1), Batch(1)):
        write(spark.range(4), batch)
    assert spark.read.parquet(folder).groupBy("batch_id").count().orderBy("batch_id").collect() == [
        (1, 4), (2, 4),
    ]


def test_reports_count_real_events(spark, messages, features, batch_events, tmp_path):
    reports, rejects = [], str(tmp_path / "rejects")
    query = start(
        spark, stream_of(spark, messages), features, LoginAnomaly(), tmp_path,
        write_rejected=file_writer(rejects), on_batch=reports.append,
    )
    assert [r.batch_id for r in reports] == [0, 1, 2]
    assert sum(r.fetched for r in reports) == 1000 and sum(r.dropped for r in reports) == 90
    assert sum(r.produced for r in reports) == len(batch_events)
    assert rows(flat_events(spark.read.parquet(str(tmp_path / "out")))) == batch_events
    assert spark.read.parquet(rejects).where("reject_reason IS NULL").count() == 0
    assert spark.read.parquet(rejects).count() == 90
    metrics = [p.observedMetrics["messages"] for p in query.recentProgress if p.observedMetrics]
    assert sum(m.fetched for m in metrics) == 1000 and sum(m.dropped for m in metrics) == 90


def test_errors_that_are_not_the_models_stop_the_stream(spark, messages, features, tmp_path):
    from pyspark.errors import StreamingQueryException

    aside = []
    lost = features.where(F.assert_true(F.lit(True)).isNull())

    class Broken(LoginAnomaly):
        def process(self, rows):
            raise OSError("an executor was lost")

    with pytest.raises(StreamingQueryException):
        start(
            spark, stream_of(spark, messages), lost, Broken(), tmp_path,
            contain_failures=True, write_failed=lambda batch, which: aside.append(which),
        )
    assert not aside
