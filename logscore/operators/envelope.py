"""The fixed output event and its JSON form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscore.functions.identity import event_time, uuid_of

EVENT_COLUMNS = ("event_id", "user_id", "model_id", "timestamp", "score", "data")
# Fixed value: the model id of an event that names none.
UNKNOWN_MODEL = "unknown_model"


def model_name(model_id: str | Column | None) -> Column:
    name = model_id if isinstance(model_id, Column) else F.lit(model_id).cast("string")
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN_MODEL))


def envelope(
    scored: DataFrame,
    model_id: str | Column | None,
    *,
    ids: str = "stable",
    zone: str = "utc",
    as_of: str | Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Wrap scored rows as output events, with `source_event_id` and the carried columns beside.

    `ids="stable"` derives the id from model and message, so a replayed message gives the same
    event again; "random" makes a new one each time.
    """
    taken = sorted({*EVENT_COLUMNS, "source_event_id"}.intersection(carry))
    if taken:
        raise ValueError(f"an event has columns of these names, rename the carried ones: {taken}")
    name = model_name(model_id)
    if ids == "stable":
        new_id = uuid_of(F.concat(name, F.lit(":"), F.col("source_event_id")))
    elif ids == "random":
        new_id = F.uuid()
    else:
        raise ValueError(f"ids must be stable or random, not {ids!r}")
    return scored.select(
        new_id.alias("event_id"),
        "user_id",
        name.alias("model_id"),
        event_time(zone, as_of).alias("timestamp"),
        "score",
        "data",
        "source_event_id",
        *carry,
    )


def sink_records(events: DataFrame, *, key: bool = False, beside: bool = False) -> DataFrame:
    """Events as broker records: `value` is the JSON text, `key` on request the event id.

    Members that are null stay in the text; an event without data gets an empty object. `beside`
    keeps the columns of the events and calls the new ones `_value` and `_key`.
    """

    def text(data: Column) -> Column:
        members = [F.col(c) for c in EVENT_COLUMNS if c != "data"]
        return F.to_json(F.struct(*members, data.alias("data")), {"ignoreNullFields": "false"})

    empty = F.create_map().cast("map<string,string>")
    value = F.when(F.col("data").isNull(), text(empty)).otherwise(text(F.col("data")))
    columns = {"key": F.col("event_id")} if key else {}
    columns["value"] = value
    if beside:
        return events.select("*", *(c.alias(f"_{name}") for name, c in columns.items()))
    return events.select(*(c.alias(name) for name, c in columns.items()))
