"""Models: column expressions, or any Python over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from logscore.functions.identity import uniform_of
from logscore.operators.features import has_user

# The login rule.
THRESHOLD = 0.5
HIGH_RISK = 0.5
TRAVEL_WEIGHT = 0.1
SCALE = 1.5
HIGHEST_SCORE = 1.0
REASON_RISK = "high_risk_ip"
REASON_COUNTRY = "unusual_country"


#: Column with the error of a row that a model failed on.
MODEL_ERROR = "model_error"

_NULLABLE = {
    pa.int8(): pd.Int8Dtype(),
    pa.int16(): pd.Int16Dtype(),
    pa.int32(): pd.Int32Dtype(),
    pa.int64(): pd.Int64Dtype(),
}


class Model(Protocol):
    """A scoring model.

    `inputs` names the message columns it needs, None for all. `before_lookup` drops rows without a
    user and may drop and score others by the message alone, which saves them the lookup. `process` gets the rows with the
    columns of `feature_columns` and adds `score` and `data`, keeping the rows that become events.
    Rows carry `source_event_id`, which identifies the message.
    """

    model_id: str
    inputs: Sequence[str] | None

    def feature_columns(self) -> Mapping[str, Column] | None: ...

    def before_lookup(self, rows: DataFrame) -> DataFrame: ...

    def process(self, rows: DataFrame) -> DataFrame: ...


def login_features() -> dict[str, Column]:
    """What the login rule reads from a user's features."""
    return {
        "risk_score": F.col("ip_address_profile.risk_score"),
        "travel_freq": F.col("country_code_profile.travel_freq"),
    }


def base_score(risk: Column, freq: Column) -> Column:
    return F.least(F.lit(HIGHEST_SCORE), (risk + freq * F.lit(TRAVEL_WEIGHT)) * F.lit(SCALE))


def reason(risk: Column) -> Column:
    return F.when(risk > HIGH_RISK, REASON_RISK).otherwise(REASON_COUNTRY)


def known(feature: str) -> Column:
    """A numeric feature, 0 where the user, the profile or the number is missing."""
    return F.coalesce(F.col(feature), F.lit(0.0))


def random_score(kind: str) -> Column:
    """A uniform score: "hash" repeats for the same message, "rand" is new on every run."""
    if kind == "hash":
        return uniform_of(F.col("source_event_id"))
    if kind == "rand":
        return F.rand()
    raise ValueError(f"score must be hash, rand or a Column, not {kind!r}")


@dataclass
class LoginAnomaly:
    """The login rule as columns.

    `score` is "hash", "rand" or any Column over message and feature columns.
    """

    threshold: float = THRESHOLD
    score: str | Column = "hash"
    model_id: str = "loginanomaly"
    inputs = ("user_id", "ip_address", "country_code", "user_agent")

    def __post_init__(self) -> None:
        if isinstance(self.score, Column):
            self.inputs = None

    def feature_columns(self) -> dict[str, Column] | None:
        # A score of the caller's own may use any feature.
        profiles = {c: F.col(c) for c in ("ip_address_profile", "country_code_profile")}
        return profiles | login_features() if isinstance(self.score, Column) else login_features()

    def before_lookup(self, rows: DataFrame) -> DataFrame:
        rows = rows.where(has_user())
        return rows if isinstance(self.score, Column) else self._scored(rows)

    def process(self, rows: DataFrame) -> DataFrame:
        if isinstance(self.score, Column):
            rows = self._scored(rows)
        risk, freq = known("risk_score"), known("travel_freq")
        data = F.struct(
            "ip_address",
            "country_code",
            "user_agent",
            reason(risk).alias("reason"),
            base_score(risk, freq).alias("base_score"),
        )
        return rows.withColumn("data", data)

    def _scored(self, rows: DataFrame) -> DataFrame:
        score = self.score if isinstance(self.score, Column) else random_score(self.score)
        return rows.withColumn("score", score).where(F.col("score") >= self.threshold)


@dataclass
class PandasModel:
    """Any Python over batches of rows.

    `function` gets a pandas frame of messages with their features and returns the rows that become
    events, with the columns of `adds` (a DDL list that names `score`). `data` lists the columns
    that make up the event's `data`. Integer columns are pandas' nullable integers, so that a null
    beside it does not round a large number; timestamps are in UTC.

    With `isolate` an error of the function costs only the rows it comes from: the task cuts the batch
    in halves, and these again, until the rows are found that fail alone. They come out with the
    error's text in the column `model_error`, NULL for the others, and without `data`. A function of
    which a row's result depends on the other rows of its batch is better not cut.
    """

    function: Callable[[pd.DataFrame], pd.DataFrame]
    adds: str
    data: Sequence[str]
    model_id: str
    inputs: Sequence[str] | None = None
    features: Callable[[], Mapping[str, Column] | None] | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None
    isolate: bool = False

    def feature_columns(self) -> Mapping[str, Column] | None:
        return self.features() if self.features else None

    def before_lookup(self, rows: DataFrame) -> DataFrame:
        rows = rows.where(has_user())
        return self.prepare(rows) if self.prepare else rows

    def process(self, rows: DataFrame) -> DataFrame:
        function = self.function
        added = T.StructType.fromDDL(self.adds)
        apply = _isolated(function, added.names) if self.isolate else lambda frame: [function(frame)]
        if self.isolate:
            added = T.StructType([*added.fields, T.StructField(MODEL_ERROR, T.StringType())])
        kept = [f for f in rows.schema.fields if f.name not in added.names]
        schema = T.StructType([*kept, *added.fields])
        result = to_arrow_schema(schema)

        def batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for frame in apply(batch.to_pandas(types_mapper=_NULLABLE.get)):
                    yield from pa.Table.from_pandas(
                        frame[result.names], schema=result, preserve_index=False
                    ).to_batches()

        scored = rows.mapInArrow(batches, schema)
        data = F.struct(*self.data)
        if self.isolate:
            data = F.when(F.col(MODEL_ERROR).isNull(), data)
        return scored.withColumn("data", data)


def _isolated(
    function: Callable[[pd.DataFrame], pd.DataFrame], adds: Sequence[str]
) -> Callable[[pd.DataFrame], Iterator[pd.DataFrame]]:
    """`function` on the largest parts of a frame that it does not fail on, in their order."""

    def apply(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        todo = [frame]
        while todo:
            part = todo.pop()
            try:
                yield function(part.copy(deep=False)).assign(**{MODEL_ERROR: None})
            except Exception as error:
                if len(part) > 1:
                    half = len(part) // 2
                    todo += [part.iloc[half:], part.iloc[:half]]
                    continue
                failed = dict.fromkeys(adds) | {MODEL_ERROR: f"{type(error).__name__}: {error}"}
                yield part.assign(**failed)

    return apply


def login_anomaly_pandas(threshold: float = THRESHOLD) -> PandasModel:
    """The login rule over pandas batches; gives the events of `LoginAnomaly()`."""

    def login_rule(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame[frame["score"] >= threshold]
        risk = frame["risk_score"].astype("float64").fillna(0.0)
        freq = frame["travel_freq"].astype("float64").fillna(0.0)
        return frame.assign(
            reason=np.where(risk > HIGH_RISK, REASON_RISK, REASON_COUNTRY),
            base_score=np.minimum(HIGHEST_SCORE, (risk + freq * TRAVEL_WEIGHT) * SCALE),
        )

    return PandasModel(
        function=login_rule,
        adds="score double, reason string, base_score double",
        data=("ip_address", "country_code", "user_agent", "reason", "base_score"),
        model_id="loginanomaly",
        inputs=LoginAnomaly.inputs,
        features=login_features,
        prepare=lambda rows: rows.withColumn("score", random_score("hash")),
    )
