"""Sinks that answer for each event."""

from __future__ import annotations

import json
import sys
from types import ModuleType

import pytest
from pyspark.sql import functions as F

from logscore.streaming.each import EachEvent, broker_each, send_all
from logscore.streaming.sinks import Refused, deliver


class Sender:
    """Refuses some keys, a number of times; notes what it got in a file of its own."""

    def __init__(self, folder, place, refuses, times=99):
        self.log = open(f"{folder}/{place.partition}-{place.attempt}.log", "a")
        self.refuses, self.times, self.calls = refuses, times, 0

    def send(self, records):
        self.calls += 1
        refused = {i for i, (key, _) in enumerate(records) if key and self.refuses(key)}
        refused = refused if self.calls <= self.times else set()
        for i, (key, value) in enumerate(records):
            if i not in refused:
                self.log.write(json.dumps([key, value]) + "\n")
        return {i: f"refused {records[i][0]}" for i in refused}

    def close(self):
        self.log.close()


def received(folder):
    lines = [x for p in folder.glob("*.log") for x in p.read_text().splitlines()]
    return sorted(json.loads(line)[0] for line in lines)


def events_of(spark, count, parts=4):
    made = spark.range(count, numPartitions=parts).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit("u").alias("user_id"),
        F.lit("m").alias("model_id"),
        F.lit("t").alias("timestamp"),
        F.lit(0.5).alias("score"),
        F.struct(F.lit("x").alias("a")).alias("data"),
        F.col("id").cast("string").alias("source_event_id"),
    )
    return made


def sink(folder, refuses, times=99, **more):
    path = str(folder)
    return EachEvent(lambda place: Sender(path, place, refuses, times), **more)


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_only_refused_events_go_to_the_dead_letters(spark, tmp_path):
    dead = []
    outcome = deliver(
        events_of(spark, 500),
        sink(tmp_path, lambda key: key in ("17", "230"), rows_per_send=7),
        lambda events, batch: dead.extend(events.collect()),
        first_wait=0.0,
    )
    assert outcome == "dead_letter"
    assert sorted((r.event_id, r.refused_because) for r in dead) == [
        ("17", "refused 17"), ("230", "refused 230"),
    ]
    assert received(tmp_path) == sorted(str(n) for n in range(500) if n not in (17, 230))


def test_events_refused_once_are_sent_again_and_only_they(spark, tmp_path):
    sent = []
    outcome = deliver(
        events_of(spark, 60, 2),
        sink(tmp_path, lambda key: key.endswith("7"), times=1),
        first_wait=0.0,
        write_sent=lambda events, batch: sent.extend(ids(events)),
    )
    assert outcome == "sent"
    assert received(tmp_path) == sorted(map(str, range(60))) == sorted(sent)


def test_a_million_events_one_in_4096_refused(spark):
    """One pass over the batch: the number of jobs does not grow with that of refused events."""

    class Picky:
        def send(self, records):
            return {i: "no" for i, (key, _) in enumerate(records) if int(key) % 4096 == 0}

        def close(self):
            pass

    spark.sparkContext.setJobGroup("a million", "")
    dead = []
    outcome = deliver(
        events_of(spark, 1_000_000, 8),
        EachEvent(lambda place: Picky()),
        lambda events, batch: dead.extend(ids(events)),
        first_wait=0.0,
    )
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("a million")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert outcome == "dead_letter"
    assert sorted(map(int, dead)) == list(range(0, 1_000_000, 4096))
    assert len(jobs) <= 5


def test_a_sink_that_is_down(spark, tmp_path):
    def connect(place):
        raise ConnectionError("nobody there")

    events, dead = events_of(spark, 9), sink(tmp_path, lambda key: False)
    assert deliver(events, EachEvent(connect), dead, first_wait=0.0) == "dead_letter"
    assert received(tmp_path) == sorted(map(str, range(9)))
    assert deliver(events, EachEvent(connect), first_wait=0.0, on_lost="log") == "lost"
    with pytest.raises(Refused, match="nobody there"):
        deliver(events, EachEvent(connect), EachEvent(connect), first_wait=0.0)


def test_empty_batch_opens_no_connection(spark):
    def connect(place):
        raise AssertionError("not needed")

    assert deliver(events_of(spark, 0), EachEvent(connect), first_wait=0.0) == "sent"


def test_waits_double(monkeypatch):
    waits = []
    monkeypatch.setattr("logscore.streaming.each.time.sleep", waits.append)

    class Down:
        def send(self, records):
            raise OSError("down")

    assert send_all(Down(), [("a", "1"), ("b", "2")]) == {0: "OSError: down", 1: "OSError: down"}
    assert waits == [0.1, 0.2]


def test_broker_sender(monkeypatch):
    """No client here: a module in its place that answers as the client does."""

    class Producer:
        def __init__(self, options):
            self.options, self.waiting, self.full = options, [], True

        def produce(self, topic, value, key, on_delivery):
            if self.full:
                self.full = False
                raise BufferError
            if value == "long":
                raise ValueError("too large")
            self.waiting.append((key, on_delivery))

        def poll(self, seconds):
            pass

        def flush(self):
            for key, answered in self.waiting:
                if key != "silent":
                    answered("not leader" if key == "bad" else None, None)
            self.waiting = []

    client = ModuleType("confluent_kafka")
    client.Producer = Producer
    monkeypatch.setitem(sys.modules, "confluent_kafka", client)
    sender = broker_each("host:9092", "scored", {"linger.ms": "5"}).connect(None)
    assert sender.producer.options == {
        "bootstrap.servers": "host:9092", "acks": "all", "linger.ms": "5",
    }
    records = [("good", "1"), ("bad", "2"), ("x", "long"), ("silent", "3")]
    assert sender.send(records) == {1: "not leader", 2: "ValueError: too large", 3: "no answer"}
    sender.close()
