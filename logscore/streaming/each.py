"""Sending events one by one from the tasks, with an answer for each.

A sink that answers for each event, as a message broker does, needs no search for what it refused: a
task opens one connection, sends its events, tries those that were refused again after a wait and hands
back the ones that stay refused. That is one pass over the batch, however many are refused, and
nothing goes through the driver.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscore.operators.envelope import sink_records

# Attempts per event and the first wait in seconds, doubled after each failure.
ATTEMPTS = 3
FIRST_WAIT = 0.1
#: Events that are handed to a sender at a time.
ROWS_PER_SEND = 2000

#: Column with the answer to an event that no attempt got through.
REFUSED = "refused_because"


@dataclass(frozen=True)
class Place:
    """Where a sender runs: the micro-batch (None outside of streams), the task and its attempt."""

    batch_id: int | None
    partition: int
    attempt: int


class Sender(Protocol):
    """A connection of one task.

    `send` gets records (`key`, `value`) and returns the error of each that was not taken, by its
    place in the list; it returns only when all are answered. An error it raises counts for all.
    """

    def send(self, records: list[tuple[str | None, str]]) -> Mapping[int, str]: ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class EachEvent:
    """A sink that answers for each event; give it to `deliver` or `start_scoring` as `write` or
    `write_dead_letter`.

    `connect` is called in the tasks, once in each. As a retried task sends its events again, delivery
    is at least once; with stable ids a receiver can tell.
    """

    connect: Callable[[Place], Sender]
    key: bool = True
    rows_per_send: int = ROWS_PER_SEND

    def acknowledged(
        self,
        events: DataFrame,
        batch_id: int | None = None,
        attempts: int = ATTEMPTS,
        first_wait: float = FIRST_WAIT,
    ) -> DataFrame:
        """Sends the events when it is computed: the events with `refused_because`, NULL if taken."""
        if REFUSED in events.columns:
            events = events.drop(REFUSED)
        records = sink_records(events, key=self.key, beside=True)
        sent = T.StructType([*events.schema.fields, T.StructField(REFUSED, T.StringType())])
        names = [f.name for f in sent.fields]
        connect, rows_per_send, keyed = self.connect, self.rows_per_send, self.key

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            context = TaskContext.get()
            place = Place(batch_id, context.partitionId(), context.attemptNumber())
            sender = _Connection(connect, place)
            try:
                for batch in batches:
                    for begin in range(0, batch.num_rows, rows_per_send):
                        part = batch.slice(begin, rows_per_send)
                        values = part.column("_value").to_pylist()
                        keys = part.column("_key").to_pylist() if keyed else [None] * len(values)
                        errors = send_all(
                            sender, list(zip(keys, values, strict=True)), attempts, first_wait
                        )
                        told = pa.array([errors.get(i) for i in range(len(values))], pa.string())
                        columns = [part.column(name) for name in names[:-1]]
                        yield pa.RecordBatch.from_arrays([*columns, told], names=names)
            finally:
                sender.close()

        return records.mapInArrow(send, sent)


class _Connection:
    """Connects at the first event, so that a sink that cannot be reached refuses what it gets."""

    def __init__(self, connect: Callable[[Place], Sender], place: Place):
        self.connect, self.place, self.sender = connect, place, None

    def send(self, records: list[tuple[str | None, str]]) -> Mapping[int, str]:
        if self.sender is None:
            self.sender = self.connect(self.place)
        return self.sender.send(records)

    def close(self) -> None:
        if self.sender is not None:
            self.sender.close()


def send_all(
    sender: Sender,
    records: list[tuple[str | None, str]],
    attempts: int = ATTEMPTS,
    first_wait: float = FIRST_WAIT,
) -> dict[int, str]:
    """Send records, those refused again; returns the last error of each that is still refused."""
    left, errors = list(range(len(records))), {}
    for attempt in range(attempts):
        if attempt:
            time.sleep(first_wait * 2 ** (attempt - 1))
        try:
            answers = sender.send([records[i] for i in left])
        except Exception as error:
            answers = dict.fromkeys(range(len(left)), f"{type(error).__name__}: {error}")
        errors = {left[i]: text for i, text in answers.items()}
        left = sorted(errors)
        if not left:
            break
    return errors


class _BrokerSender:
    """A producer of the confluent_kafka client; each record's delivery report is its answer."""

    def __init__(self, options: Mapping[str, str], topic: str):
        from confluent_kafka import Producer

        self.producer, self.topic = Producer(dict(options)), topic

    def send(self, records: list[tuple[str | None, str]]) -> dict[int, str]:
        answers: dict[int, str | None] = {}

        def report(place: int):
            def answered(error, message) -> None:
                answers[place] = str(error) if error is not None else None

            return answered

        for place, (key, value) in enumerate(records):
            while True:
                try:
                    self.producer.produce(self.topic, value, key=key, on_delivery=report(place))
                    break
                except BufferError:  # the client's queue is full
                    self.producer.poll(0.1)
                except Exception as error:  # such as a record that is too large
                    answers[place] = f"{type(error).__name__}: {error}"
                    break
            self.producer.poll(0)
        self.producer.flush()
        refused = {i: answers.get(i, "no answer") for i in range(len(records))}
        return {i: text for i, text in refused.items() if text is not None}

    def close(self) -> None:
        self.producer.flush()


def broker_each(servers: str, topic: str, options: Mapping[str, str] | None = None) -> EachEvent:
    """Events to a Kafka topic from the tasks, with the event id as key, acknowledged by all replicas.

    Needs the package confluent_kafka on the executors; `broker_writer` uses Spark's own sink, which
    answers for whole batches only.
    """
    settings = {"bootstrap.servers": servers, "acks": "all", **(options or {})}
    return EachEvent(lambda place: _BrokerSender(settings, topic))
