"""A stream of messages to the sinks."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from typing import Any

from pyspark.errors import (
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    NumberFormatException,
    PythonException,
    SparkRuntimeException,
)
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logscore.operators.scoring import MODEL_ERROR, LoginAnomaly, Model, PandasModel
from logscore.operators.validate import check
from logscore.plans.score import score_messages, score_valid
from logscore.schema import Schema
from logscore.streaming.batch import Batch
from logscore.streaming.each import EachEvent
from logscore.streaming.ledger import committing
from logscore.streaming.sinks import Write, computed, deliver

log = logging.getLogger(__name__)

#: Errors of a model's own code or expressions. Others, such as a lost executor, stop the stream.
MODEL_ERRORS = (
    PythonException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    NumberFormatException,
    SparkRuntimeException,
)


@dataclass(frozen=True)
class Report:
    """What became of a micro-batch; `produced` is None where the model failed."""

    batch_id: int
    fetched: int
    dropped: int
    produced: int | None
    outcome: str


_AS_CAME = "_as_came"
_CHECK_OPTIONS = ("policy", "uuid_check")


def start_scoring(
    raw: DataFrame,
    schema: Schema,
    features: DataFrame,
    model: Model,
    *,
    checkpoint: str,
    write: Write | EachEvent,
    write_dead_letter: Write | EachEvent | None = None,
    write_rejected: Write | None = None,
    write_failed: Write | None = None,
    contain_failures: bool | str = False,
    on_batch: Callable[[Report], None] | None = None,
    trigger: Mapping[str, Any] | None = None,
    options: Mapping[str, Any] | None = None,
    delivery: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Score each micro-batch of a stream, send its events, then let Spark commit its offsets.

    Delivery is at least once; with stable ids a replayed batch sends the same events again, and the
    writers get the batch's id to replace what they have of it. `options` go to `score_messages`,
    `delivery` to `deliver`, `trigger` to the stream writer (one micro-batch per second by default;
    `{"availableNow": True}` for a backfill). A sink that Spark itself writes exactly once, such as
    a Parquet folder, needs none of this: give `score_messages` the stream and write the result.

    `write_rejected` gets the messages that are not valid, as they came, with `reject_reason`; it
    must not fail.

    A batch the model fails on stops the stream. With `contain_failures="message"` a Python model's
    error costs only the messages it comes from: tasks find them by halving, `write_failed` gets them
    as they came, with the text of the error in `model_error`, and the others are scored. Where the
    error cannot be put down to messages, as that of a column expression, and with
    `contain_failures="batch"` (or True), all messages of the batch go to `write_failed` (without
    those that went to `write_rejected`). Only errors of the model are contained.

    Progress reports count messages `fetched` and `dropped`, and events `produced` where the batch
    is scored as part of the stream. With `write_rejected`, `contain_failures` or `on_batch` each
    batch is decoded once and kept while it is worked on, and a `Report` with the events that were
    really made goes to the log and to `on_batch`.
    """
    options, delivery = dict(options or {}), dict(delivery or {})
    delivery.setdefault("repeatable", _repeatable(model, options))
    if contain_failures not in (False, True, "batch", "message"):
        raise ValueError(f"contain_failures must be message or batch, not {contain_failures!r}")
    by_message = contain_failures == "message" and isinstance(model, PandasModel)
    if by_message:
        model = replace(model, isolate=True)
    if contain_failures and write_failed is None:
        raise ValueError("contain_failures needs write_failed, the sink for failed batches")

    def send(events: DataFrame, batch_id: int) -> str:
        outcome = deliver(events, write, write_dead_letter, batch_id=batch_id, **delivery)
        log.info("batch %d: %s", batch_id, outcome)
        return outcome

    as_came = [c for c in raw.columns if c not in schema.fields]

    def work_on(flagged: DataFrame, batch_id: int) -> None:
        with committing(Batch(batch_id), write_rejected, write_failed):
            work_in_order(flagged, batch_id)

    def work_in_order(flagged: DataFrame, batch_id: int) -> None:
        flagged = computed(flagged)
        try:
            counts = flagged.agg(F.count("*"), F.count("reject_reason")).first()
            if write_rejected is not None and counts[1]:
                rejected = flagged.where("reject_reason IS NOT NULL")
                write_rejected(rejected.select(*as_came, "reject_reason"), Batch(batch_id))
            produced, outcome = score_and_send(flagged, batch_id)
            report = Report(batch_id, *counts, produced, outcome)
            log.info("%s", report)
            if on_batch is not None:
                on_batch(report)
        finally:
            flagged.unpersist()

    def score_and_send(flagged: DataFrame, batch_id: int) -> tuple[int | None, str]:
        made, valid = Observation(), flagged.where("reject_reason IS NULL").drop("reject_reason")
        scoring = {k: v for k, v in options.items() if k not in (*_CHECK_OPTIONS, "counters")}
        if by_message:
            valid = valid.withColumn(_AS_CAME, F.struct(*as_came))
            scoring["carry"] = [*scoring.get("carry", ()), _AS_CAME]
        events = score_valid(valid, features, model, **scoring)
        good = F.col(MODEL_ERROR).isNull() if by_message else F.lit(True)
        counts = F.count_if(good).alias("produced"), F.count_if(~good).alias("failed")
        events = events.observe(made, *counts)
        try:
            events = computed(events)
        except MODEL_ERRORS:
            if not contain_failures:
                raise
            log.exception("scoring failed on batch %d, its messages are set aside", batch_id)
            aside = flagged if write_rejected is None else valid
            write_failed(aside.select(*as_came), Batch(batch_id))
            return None, "failed"
        try:
            if by_message and made.get["failed"]:
                log.error("scoring failed on %d messages of batch %d", made.get["failed"], batch_id)
                failed = events.where(~good).select(f"{_AS_CAME}.*", MODEL_ERROR)
                write_failed(failed, Batch(batch_id))
            sent = events.where(good).drop(_AS_CAME, MODEL_ERROR) if by_message else events
            return made.get["produced"], send(sent, batch_id)
        finally:
            events.unpersist()

    if write_rejected or contain_failures or on_batch:
        rules = {k: v for k, v in options.items() if k in _CHECK_OPTIONS}
        flagged = check(raw, schema, **rules).observe(
            "messages",
            F.count(F.lit(1)).alias("fetched"),
            F.count("reject_reason").alias("dropped"),
        )
        writer = flagged.writeStream.foreachBatch(work_on)
    else:
        events = score_messages(raw, schema, features, model, **{"counters": True, **options})
        writer = events.writeStream.foreachBatch(send)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )


def _repeatable(model: Model, options: Mapping[str, Any]) -> bool:
    """Whether a batch that is computed again has the same rows."""
    stable = options.get("ids", "stable") == "stable"
    return stable and isinstance(model, LoginAnomaly) and isinstance(model.score, str) and (
        model.score == "hash"
    )
