"""Messages and features derived from the event, customer and nation tables.

The derived messages carry known faults, so that every rule of the validator has rows to reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logscore.functions.identity import uuid_of
from logscore.operators.decode import once


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _common_fields() -> dict[str, Column]:
    return {
        "event_id": uuid_of(F.col("event_id").cast("string")),
        "log_type": F.col("event_type"),
        "ip_address": F.concat(
            F.lit("10."), F.col("user_id") % 256, F.lit("."), F.col("event_id") % 256, F.lit(".1")
        ),
        "event_timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "user_id": F.col("user_id").cast("string"),
    }


def _json(fields: dict[str, Column], more: Column) -> Column:
    """An object of the fields that are not NULL, followed by further members given as text."""
    members = F.to_json(F.struct(*(c.alias(name) for name, c in fields.items())))
    return F.concat(F.regexp_replace(members, r"\}$", ""), more, F.lit("}"))


def raw_login(spark: SparkSession, folder: str) -> DataFrame:
    """`value`, `batch_id` and `offset`: one login message per event, 15 in 100 with a fault."""
    events, nations = table(spark, folder, "events"), table(spark, folder, "nation")
    rows = events.join(nations, F.col("user_id") % 25 == F.col("n_nationkey"))
    fault = F.col("event_id") % 100
    fields = _common_fields() | {
        "user_agent": F.concat(F.lit("agent-"), F.col("event_id") % 5),
        "country_code": F.col("n_name"),
    }
    fields["event_id"] = (
        F.when(fault == 5, "not-a-uuid")
        .when(fault == 6, F.regexp_replace(fields["event_id"], "^(.{14})4", "$11"))
        .otherwise(fields["event_id"])
    )
    fields["user_id"] = F.when(fault == 10, "").when(~fault.isin(3, 4, 7), fields["user_id"])
    fields["user_agent"] = F.when(~fault.isin(9, 14), fields["user_agent"])
    fields["country_code"] = F.when(fault != 15, fields["country_code"])
    for name in fields.keys() - {"log_type"}:
        fields[name] = F.when(fault != 12, fields[name])
    more = (
        F.when(fault == 4, ',"user_id":null')
        .when(fault == 7, F.concat(F.lit(',"user_id":'), F.col("user_id")))
        .when(fault == 8, ',"session":"s-1"')
        .when(fault == 9, ',"user_agent":null')
        .otherwise("")
    )
    message = _json(fields, more)
    value = (
        F.when(fault == 0, F.substring(message, 1, 10))
        .when(fault == 1, F.concat(F.lit("["), message, F.lit("]")))
        .when(fault == 2, "null")
        .otherwise(message)
    )
    return once(rows, value, "message").select(
        F.col("message").alias("value"),
        F.expr("event_id DIV 100").alias("batch_id"),
        F.col("event_id").alias("offset"),
    )


def raw_exfil(spark: SparkSession, folder: str) -> DataFrame:
    """`value` and `offset`: one upload message per event, its size given in nine ways."""
    events = table(spark, folder, "events")
    way = F.col("event_id") % 10
    number = F.floor("value").cast("string")
    fields = _common_fields() | {"destination": F.concat(F.lit("host-"), F.col("user_id") % 7)}
    size = (
        F.when(way.isin(0, 9), number)
        .when(way == 1, F.concat(F.lit('"'), number, F.lit('"')))
        .when(way == 2, '"abc"')
        .when(way == 3, "12.5")
        .when(way == 4, "true")
        .when(way == 5, "null")
        .when(way == 7, "12.0")
        .when(way == 8, '" 12 "')
    )
    more = F.coalesce(F.concat(F.lit(',"file_size":'), size), F.lit(""))
    message = once(events, _json(fields, more), "message")
    return message.select(F.col("message").alias("value"), F.col("event_id").alias("offset"))


#: What a number and a truth value are given as, by event number; None leaves the field out.
_RATIOS = ("half", '"half"', "whole", '" 1.5 "', '"1e3"', "true", "null", '"abc"', None, "{}", '"1_0.5"')
_FLAGS = ("true", "false", "1", "2", '"True"', '"yes"', '"F"', "null", "[]", None)


def raw_typed(spark: SparkSession, folder: str) -> DataFrame:
    """`value` and `offset`: one message per event with a number and a truth value, each given in
    about ten ways."""
    events = table(spark, folder, "events")
    whole = F.floor("value").cast("string")
    half = F.concat(whole, F.lit(".5"))
    given = {"half": half, '"half"': F.concat(F.lit('"'), half, F.lit('"')), "whole": whole}

    def member(name: str, ways: tuple, number: Column) -> Column:
        text = F.lit("")
        for i, way in enumerate(ways):
            if way is not None:
                value = F.concat(F.lit(f',"{name}":'), given.get(way, F.lit(way)))
                text = F.when(number == i, value).otherwise(text)
        return text

    number = F.col("event_id")
    ratio = member("ratio", _RATIOS, number % len(_RATIOS))
    flag = member("flag", _FLAGS, F.floor(number / len(_RATIOS)) % len(_FLAGS))
    message = F.concat(F.lit('{"kind":"typed"'), ratio, flag, F.lit("}"))
    return events.select(message.alias("value"), number.alias("offset"))


def user_features(spark: SparkSession, folder: str) -> DataFrame:
    """One feature row per customer, nine of ten; one of those has an empty vector."""
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
    rows = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    user, kind = F.col("c_custkey"), F.col("c_custkey") % 10
    filled = kind != 5
    risk = F.when(kind != 7, (user * 37) % 100 / F.lit(100.0))
    return rows.where(kind != 0).select(
        user.cast("string").alias("user_id"),
        F.when(filled, "2024-02-10").alias("version"),
        F.when(
            filled,
            F.struct(
                F.array(F.concat(F.lit("10."), user % 256, F.lit(".0.1"))).alias("frequent_ips"),
                risk.alias("risk_score"),
            ),
        ).alias("ip_address_profile"),
        F.when(
            filled,
            F.struct(
                F.array(F.concat(F.lit("agent-"), user % 5)).alias("common_agents"),
                F.col("c_mktsegment").alias("device_type"),
            ),
        ).alias("user_agent_profile"),
        F.when(
            filled & (kind != 8),
            F.struct(
                F.array("n_name").alias("common_countries"),
                (user % 8).cast("double").alias("travel_freq"),
            ),
        ).alias("country_code_profile"),
    )
