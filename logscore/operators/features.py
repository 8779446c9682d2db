"""User features and their lookup, the one join of a scoring run."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = "user_id"


def distinct_users(rows: DataFrame) -> DataFrame:
    """The user ids of a batch, without NULL and empty ones; no rows if there is no such column."""
    if KEY not in rows.columns:
        empty = rows.sparkSession.createDataFrame([], f"{KEY} string")
        return empty
    return rows.select(KEY).where(has_user()).distinct()


def has_user() -> Column:
    return F.col(KEY).isNotNull() & (F.col(KEY) != "")


def feature_vector(features: DataFrame, user_id: str) -> DataFrame:
    """The feature row of one user, or no row."""
    return features.where(F.col(KEY) == user_id)


def not_empty(features: DataFrame) -> DataFrame:
    """The users whose vector holds anything at all."""
    anything = [F.col(c).isNotNull() for c in features.columns if c != KEY]
    return features.where(reduce(lambda a, b: a | b, anything, F.lit(False)))


def lookup(
    rows: DataFrame,
    features: DataFrame,
    columns: Mapping[str, Column] | None = None,
    *,
    unknown_users: str = "score",
    salt: int = 1,
    salt_by: str = "event_id",
    spread: bool = True,
) -> DataFrame:
    """Add feature columns to each row by `user_id`; `features` has one row per user.

    `columns` names what to read from a feature row, so nothing else is read or shuffled.
    `unknown_users="score"` keeps rows of users without features (NULL columns, `has_features`
    false); "skip" drops them, and users whose vector is empty too.

    Spark picks the join: broadcast when the features are below its threshold, else a shuffle
    by user in which adaptive execution splits the partitions of very active users. Where that is
    off, as in some streaming set-ups, `salt=n` spreads every user over n partitions at the price
    of n copies of the feature rows. Rows without a user are spread over all partitions;
    `spread=False` saves that where there are none.
    """
    if columns is None:
        columns = {c: F.col(c) for c in features.columns if c != KEY}
    if unknown_users == "skip":
        how, features = "inner", not_empty(features)
    elif unknown_users == "score":
        how = "left"
    else:
        raise ValueError(f"unknown_users must be score or skip, not {unknown_users!r}")
    side = features.select(
        KEY, *(c.alias(name) for name, c in columns.items()), F.lit(True).alias("has_features")
    )
    on = [KEY]
    if salt > 1:
        on = [KEY, "_salt"]
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salt)).cast("int"))
        side = side.withColumn("_salt", F.explode(F.array(*map(F.lit, range(salt)))))
    if spread:
        rows = rows.withColumn("_user", _match_key(rows))
        side, on = side.withColumnRenamed(KEY, "_user"), ["_user", *on[1:]]
    joined = rows.join(side, on, how).drop("_user", "_salt")
    return joined.withColumn("has_features", F.coalesce("has_features", F.lit(False)))


def _match_key(rows: DataFrame) -> Column:
    """The user, or where there is none a text that matches no user and differs between rows, so
    that such rows do not meet in one partition."""
    texts = [f.name for f in rows.schema.fields if f.dataType == T.StringType()]
    other = F.concat(F.lit("\0"), F.xxhash64(*texts).cast("string"))
    return F.when(has_user(), F.col(KEY)).otherwise(other)


def without_features(rows: DataFrame, features: DataFrame) -> DataFrame:
    """The rows that `lookup(..., unknown_users="skip")` drops for want of features."""
    side = not_empty(features).select(F.col(KEY).alias("_user"))
    return rows.withColumn("_user", _match_key(rows)).join(side, "_user", "left_anti").drop("_user")


def by_user(features: DataFrame) -> DataFrame:
    """The features dealt by user once and kept, for a stream whose batches all look up in them.

    Joins above Spark's broadcast threshold then shuffle the messages of a batch only. `unpersist`
    the result when the stream has ended. A table of `sources.features.save_by_user` needs no such copy.
    """
    parts = int(features.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return features.repartition(parts, KEY).persist()
