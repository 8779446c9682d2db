"""Sending a batch of events: retries, then only what is refused to the dead-letter sink."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscore.operators.envelope import sink_records
from logscore.streaming.batch import Batch
from logscore.streaming.each import ATTEMPTS, FIRST_WAIT, REFUSED, EachEvent
from logscore.streaming.ledger import committing

log = logging.getLogger(__name__)

#: Parts that a refused batch, and each refused part of it, is cut into.
PARTS = 16
#: Events that are sent alone, none of them taken, before a part of which all cuts are refused counts
#: as refused event by event.
ALONE = 64


Write = Callable[[DataFrame, Batch], None]


class Refused(Exception):
    """Events that neither the sink nor the dead-letter sink took."""


def deliver(
    events: DataFrame,
    write: Write | EachEvent,
    write_dead_letter: Write | EachEvent | None = None,
    *,
    batch_id: int | None = None,
    attempts: int = ATTEMPTS,
    first_wait: float = FIRST_WAIT,
    on_lost: str = "raise",
    part_by: str = "event_id",
    repeatable: bool = False,
    write_sent: Write | None = None,
) -> str:
    """Write a batch, again after a wait if that fails, and at last only what is refused elsewhere.

    An `EachEvent` sink answers for each event: it is sent the batch once, from the tasks, and what it
    refuses three times goes to the dead-letter sink with the reason in `refused_because`.
    `write_sent` then gets the events it took, for a table of receipts.

    Other writers answer for the batch. After the last attempt the batch is cut into parts by a hash of `part_by`, refused parts again,
    down to single events; those still refused go to the dead-letter sink. A part of which every cut
    is refused has events sent alone, spread by the hash: once one of them is taken the search goes
    on, however many writes that needs; after `ALONE` refusals the sink is down for that part, which
    goes to the dead letters whole.

    Returns "sent", "dead_letter" (some or all of it) or "lost". What neither sink takes raises, so
    that a stream stops and starts over from its checkpoint; `on_lost="log"` only logs it. A retry
    may repeat rows that a failed attempt had written; a `LedgerWriter` commits what was written of
    the batch at the end, and once.

    The batch is computed first and kept for all attempts. With `repeatable=True`, for rows that
    come out the same when computed again, it is written at once and computed and kept only after a
    failure. A batch that cannot be computed raises and is no matter of the sinks.
    """
    if on_lost not in ("raise", "log"):
        raise ValueError(f"on_lost must be raise or log, not {on_lost!r}")
    batch = Batch(batch_id)
    waits = {"attempts": attempts, "first_wait": first_wait}
    with committing(batch, write, write_dead_letter, write_sent):
        if isinstance(write, EachEvent):
            return _deliver_each(events, write, write_dead_letter, batch, on_lost, write_sent, waits)
        if isinstance(write_dead_letter, EachEvent):
            write_dead_letter = _all_or_error(write_dead_letter)
        return _deliver_batch(
            events, write, write_dead_letter, batch, on_lost, part_by, repeatable, **waits
        )


def _deliver_batch(
    events: DataFrame,
    write: Write,
    write_dead_letter: Write | None,
    batch: Batch,
    on_lost: str,
    part_by: str,
    repeatable: bool,
    attempts: int,
    first_wait: float,
) -> str:
    """Send to a writer that answers for the batch."""
    kept_by_caller = events.is_cached
    tried = 0
    if repeatable and not kept_by_caller:
        if _try_write(events, write, batch, 1) is None:
            return "sent"
        tried = 1
        time.sleep(first_wait)
    events = computed(events)
    try:
        wait = first_wait * 2**tried
        error = _try_write(events, write, batch, attempts - tried, wait)
        if error is None:
            return "sent"
        log.error("all %d attempts failed", attempts)
        if write_dead_letter is not None:
            try:
                refused = _refused(events, write, batch, part_by)
                if refused is not None:
                    write_dead_letter(refused, replace(batch, part="refused"))
                    return "dead_letter"
                return "sent"
            except Exception as dead_letter_error:
                error = dead_letter_error
                log.exception("the dead-letter sink failed too")
        if on_lost == "raise":
            raise error
        return "lost"
    finally:
        if not kept_by_caller:
            events.unpersist()


def _deliver_each(
    events: DataFrame,
    write: EachEvent,
    write_dead_letter: Write | EachEvent | None,
    batch: Batch,
    on_lost: str,
    write_sent: Write | None,
    waits: Mapping[str, object],
) -> str:
    """Send from the tasks; only the answers that are needed are kept."""
    answered = write.acknowledged(events, batch.id, **waits)
    refused = f"{REFUSED} IS NOT NULL"
    answered = computed(answered if write_sent is not None else answered.where(refused))
    try:
        if write_sent is not None:
            write_sent(answered.where(f"{REFUSED} IS NULL").drop(REFUSED), batch)
        left = answered.where(refused)
        if left.isEmpty():
            return "sent"
        error: Exception = Refused("the sink refused events and there is no dead-letter sink")
        if write_dead_letter is not None:
            if isinstance(write_dead_letter, EachEvent):
                write_dead_letter = _all_or_error(write_dead_letter)
            try:
                write_dead_letter(left, replace(batch, part="refused"))
                return "dead_letter"
            except Exception as dead_letter_error:
                error = dead_letter_error
                log.exception("the dead-letter sink failed too")
        if on_lost == "raise":
            raise error
        return "lost"
    finally:
        answered.unpersist()


def _all_or_error(sink: EachEvent) -> Write:
    """As a writer that raises if an event is refused."""

    def write(events: DataFrame, batch: Batch) -> None:
        left = sink.acknowledged(events, batch.id).where(f"{REFUSED} IS NOT NULL")
        first = left.agg(F.count("*"), F.min(REFUSED)).first()
        if first[0]:
            raise Refused(f"{first[0]} events refused, one because: {first[1]}")

    return write


def computed(events: DataFrame) -> DataFrame:
    """The same rows, computed now and kept, so that later failures are the sink's own."""
    if events.is_cached:
        return events
    events = events.persist()
    try:
        events.count()
    except Exception:
        events.unpersist()
        raise
    return events


def _try_write(
    events: DataFrame, write: Write, batch: Batch, attempts: int, first_wait: float = 0.0
) -> Exception | None:
    error: Exception | None = None
    for attempt in range(attempts):
        try:
            write(events, batch)
            return None
        except Exception as failure:
            error = failure
            log.warning("attempt %d of %d failed: %s", attempt + 1, attempts, failure)
            if attempt + 1 < attempts:
                time.sleep(first_wait * 2**attempt)
    return error


def _refused(events: DataFrame, write: Write, batch: Batch, part_by: str) -> DataFrame | None:
    """Send what the sink takes, in ever smaller parts; returns the rest, None if nothing is left."""
    if part_by not in events.columns:
        return events
    place = F.xxhash64(F.col(part_by))
    alone: list[int] = []
    whole: list[DataFrame] = []
    todo = [("", events, 0)]
    while todo:
        name, rows, level = todo.pop(0)
        digit = F.pmod(F.shiftright(place, 4 * level), F.lit(PARTS))
        ends = (f(F.when(digit == i, place)) for i in range(PARTS) for f in (F.min, F.max))
        found = rows.agg(*(x.alias(str(i)) for i, x in enumerate(ends))).first()
        parts = [
            (f"{name}{i:x}", rows.where(digit == i), found[2 * i] == found[2 * i + 1], found[2 * i])
            for i in range(PARTS)
            if found[2 * i] is not None
        ]
        left = [part for part in parts if not _takes(write, batch, part[:2])]
        tried: list[int] = []
        if len(left) == len(parts) > 1 and not all(single for _, _, single, _ in left):
            tried, taken = _tried_alone(rows, write, batch, name, place)
            if taken is None:
                whole.append(rows)
                continue
            alone += [at for at in tried if at != taken]
        for part, those, single, at in left:
            if not single:
                todo.append((part, those.where(~place.isin(tried)) if tried else those, level + 1))
            elif at not in tried:
                alone.append(at)
    if alone:
        at = events.sparkSession.createDataFrame([(x,) for x in alone], "refused_at bigint")
        whole.append(events.join(at, place == at["refused_at"], "left_semi"))
    return reduce(DataFrame.union, whole) if whole else None


def _tried_alone(
    rows: DataFrame, write: Write, batch: Batch, name: str, place: Column
) -> tuple[list[int], int | None]:
    """Send events one by one until one is taken: the places of those sent, and of the one taken."""
    order = rows.select(place.alias("place")).distinct().orderBy("place").limit(ALONE)
    tried: list[int] = []
    for at in [row.place for row in order.collect()]:
        tried.append(at)
        if _takes(write, batch, (f"{name}-{len(tried)}", rows.where(place == at))):
            return tried, at
    return tried, None


def _takes(write: Write, batch: Batch, part: tuple[str, DataFrame]) -> bool:
    return _try_write(part[1], write, replace(batch, part=part[0]), 1) is None


def broker_writer(
    servers: str, topic: str, options: Mapping[str, str] | None = None, *, key: bool = False
) -> Write:
    """Writes events to a Kafka topic as JSON; `key` sends the event id as record key."""

    def write(events: DataFrame, batch: Batch) -> None:
        (
            sink_records(events, key=key)
            .write.format("kafka")
            .options(**{"kafka.bootstrap.servers": servers, "topic": topic, **(options or {})})
            .save()
        )

    return write


def file_writer(path: str, layout: str = "parquet") -> Write:
    """Writes to a folder: events as a "parquet" table, or their JSON text with "text".

    A micro-batch has the folder `batch_id=<id>/part=<part>` and replaces what is there, so that a
    replayed one is not there twice; outside of streams rows are appended.
    """

    def write(events: DataFrame, batch: Batch) -> None:
        rows = sink_records(events) if layout == "text" else events
        if batch.id is None:
            rows.write.mode("append").format(layout).save(path)
            return
        folder = f"{path}/batch_id={batch.id}"
        if batch.part == "all":  # replaces parts of an earlier try as well
            rows = rows.withColumn("part", F.lit("all"))
            rows.write.mode("overwrite").partitionBy("part").format(layout).save(folder)
        else:
            rows.write.mode("overwrite").format(layout).save(f"{folder}/part={batch.part}")

    return write
