"""The whole run as one plan: raw messages in, output events out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logscore.operators.envelope import envelope
from logscore.operators.features import lookup
from logscore.operators.scoring import MODEL_ERROR, Model
from logscore.operators.validate import valid_rows
from logscore.schema import Schema


def messages_for(
    valid: DataFrame, model: Model, *, key: Sequence[str] = ("event_id",), carry: Sequence[str] = ()
) -> DataFrame:
    """What a model needs of the valid rows: its inputs, the message's identity, carried columns.

    An input the schema does not have is NULL.
    """

    def column(name: str) -> Column:
        if name in valid.columns:
            return F.col(name)
        return F.lit(None).cast("string").alias(name)

    parts = [column(c).cast("string") for c in key]
    identity = parts[0] if len(parts) == 1 else F.concat_ws(":", *parts)
    wanted = valid.columns if model.inputs is None else model.inputs
    inputs = [column(c) for c in wanted if c not in carry]
    return valid.select(*inputs, *carry, identity.alias("source_event_id"))


def score_rows(
    rows: DataFrame,
    features: DataFrame,
    model: Model,
    *,
    unknown_users: str = "score",
    salt: int = 1,
) -> DataFrame:
    """Look up the features of each row's user and run the model."""
    known = lookup(
        model.before_lookup(rows),
        features,
        model.feature_columns(),
        unknown_users=unknown_users,
        salt=salt,
        salt_by="source_event_id",
        spread=False,
    )
    return model.process(known)


def score_valid(
    valid: DataFrame,
    features: DataFrame,
    model: Model,
    *,
    unknown_users: str = "score",
    key: Sequence[str] = ("event_id",),
    carry: Sequence[str] = (),
    ids: str = "stable",
    zone: str = "utc",
    as_of: str | Column | None = None,
    salt: int = 1,
) -> DataFrame:
    """The part of `score_messages` behind validation, for rows of `valid_rows` or `check`.

    The events of a `PandasModel` with `isolate` have `model_error` beside: rows with an error are the
    messages the model failed on.
    """
    rows = messages_for(valid, model, key=key, carry=carry)
    scored = score_rows(rows, features, model, unknown_users=unknown_users, salt=salt)
    if getattr(model, "isolate", False):
        carry = [*carry, MODEL_ERROR]
    return envelope(scored, model.model_id, ids=ids, zone=zone, as_of=as_of, carry=carry)


def score_messages(
    raw: DataFrame,
    schema: Schema,
    features: DataFrame,
    model: Model,
    *,
    policy: str = "pydantic",
    uuid_check: bool | None = None,
    unknown_users: str = "score",
    key: Sequence[str] = ("event_id",),
    carry: Sequence[str] = (),
    ids: str = "stable",
    zone: str = "utc",
    as_of: str | Column | None = None,
    salt: int = 1,
    counters: bool = False,
) -> DataFrame:
    """Decode, validate, look up, score, keep what reaches the threshold, wrap.

    `raw` has the JSON text in `value` and may be a stream. `key` names the columns that tell one
    message from another (for a broker: topic, partition, offset) where `event_id` does not.
    `carry` names columns of `raw` to keep beside the event, such as a batch id. `counters` adds
    observed metrics, which a stream reports with its progress: `messages` (fetched, dropped) and
    `events` (produced).
    """
    unknown = [c for c in key if c not in (*schema.fields, *raw.columns)]
    if schema.found and unknown:
        raise ValueError(f"key columns that neither the schema nor the messages have: {unknown}")
    valid = valid_rows(
        raw, schema, policy, uuid_check=uuid_check, counters="messages" if counters else None
    )
    events = score_valid(
        valid,
        features,
        model,
        unknown_users=unknown_users,
        key=key,
        carry=carry,
        ids=ids,
        zone=zone,
        as_of=as_of,
        salt=salt,
    )
    if counters:
        events = events.observe("events", F.count(F.lit(1)).alias("produced"))
    return events
