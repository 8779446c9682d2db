"""Reading user features."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscore.sources.json_object import json_members

log = logging.getLogger(__name__)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXTS = T.ArrayType(T.StringType())
FEATURES_SCHEMA = _struct(
    user_id=T.StringType(),
    version=T.StringType(),
    ip_address_profile=_struct(frequent_ips=_TEXTS, risk_score=T.DoubleType()),
    user_agent_profile=_struct(common_agents=_TEXTS, device_type=T.StringType()),
    country_code_profile=_struct(common_countries=_TEXTS, travel_freq=T.DoubleType()),
)


def no_features(spark: SparkSession, schema: T.StructType = FEATURES_SCHEMA) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_features(
    spark: SparkSession,
    path: str,
    layout: str = "parquet",
    schema: T.StructType = FEATURES_SCHEMA,
    latest_by: str | None = None,
) -> DataFrame:
    """The features table, one row per user; a missing path gives an empty table.

    `layout`: "parquet", "json_lines" or "json_object", a file that is one JSON object keyed by user;
    of a user given twice the last one counts. Values of the wrong type become NULL; a file that is
    not JSON gives no rows. All are split over tasks, and of any size.

    Rows that repeat a user double that user's events. `latest_by` names a column of the schema, such
    as "version", by which only the largest row of each user is kept (null is the smallest).
    """
    rows = _read(spark, path, layout, schema)
    if latest_by is None:
        return rows
    whole = F.struct(*rows.columns)
    latest = rows.groupBy("user_id").agg(F.max_by(whole, F.struct(latest_by, whole.cast("string"))))
    return latest.toDF("user_id", "row").select("row.*")


def save_by_user(features: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write the features as a table bucketed and sorted by user, one file a bucket, and return it.

    A join by user that Spark does not broadcast then shuffles the messages only, and takes the
    features from the files, which an executor that is lost does not take along. `path` puts the
    files outside of the warehouse; `open_by_user` registers them in a session of another catalog.
    """
    writer = features.repartition(buckets, "user_id").write.bucketBy(buckets, "user_id")
    writer = writer.sortBy("user_id").format("parquet").mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return features.sparkSession.table(table)


def open_by_user(
    spark: SparkSession,
    table: str,
    buckets: int,
    path: str,
    schema: T.StructType = FEATURES_SCHEMA,
) -> DataFrame:
    """The files that `save_by_user` wrote to `path`, as a table of this session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY (user_id) SORTED BY (user_id) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def _read(spark: SparkSession, path: str, layout: str, schema: T.StructType) -> DataFrame:
    try:
        if layout == "parquet":
            return spark.read.schema(schema).parquet(path)
        if layout == "json_lines":
            rows = spark.read.schema(schema).json(path)
            return rows.where(F.col("user_id").isNotNull())
        if layout == "json_object":
            return _by_user(json_members(spark, path), schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no features at %s, going on without", path)
        return no_features(spark, schema)
    raise ValueError(f"layout must be parquet, json_lines or json_object, not {layout!r}")


def _by_user(members: DataFrame, schema: T.StructType) -> DataFrame:
    vector = T.StructType([f for f in schema.fields if f.name != "user_id"])
    text = F.concat(F.lit("{"), "text", F.lit("}"))
    keys = F.size(F.from_json(text, "map<string, string>"))  # 1, or 0 for an empty object
    users = F.map_entries(F.from_json(text, T.MapType(T.StringType(), vector)))
    rows = members.select("file", "member", keys.alias("keys"), F.get(users, F.lit(0)).alias("entry"))
    sound = F.every(F.coalesce(F.col("keys") == 1, F.lit(False)))
    files = rows.groupBy("file").agg(sound.alias("sound")).where("sound")
    entries = rows.join(files, "file", "left_semi").where("entry.value IS NOT NULL")
    # Of a user given twice the last one counts.
    latest = F.max_by("entry.value", F.struct("file", "member"))
    return (
        entries.groupBy(F.col("entry.key").alias("user_id"))
        .agg(latest.alias("vector"))
        .select("user_id", *(F.col(f"vector.{f.name}") for f in vector.fields))
        .select(*schema.names)
    )
