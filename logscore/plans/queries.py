"""One query per operator over the given tables.

Messages and features are derived from `events`, `customer` and `nation`; every query reads them
whole. `oracle.py` states the same results as SQL that never parses JSON.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import replace

import pandas as pd
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logscore.functions.identity import event_time
from logscore.operators import features as lookups
from logscore.operators.decode import decode, is_json
from logscore.operators.envelope import envelope, sink_records
from logscore.operators.scoring import (
    LoginAnomaly,
    PandasModel,
    base_score,
    known,
    login_anomaly_pandas,
    login_features,
    random_score,
    reason,
)
from logscore.operators.validate import batch_counts, check, rejected_rows, valid_rows
from logscore.plans.score import messages_for, score_messages, score_valid
from logscore.schema import EXFIL, LOGIN, Schema, find_schema
from logscore.session import configure, scratch_folder
from logscore.sources.features import read_features, save_by_user
from logscore.sources.raw import stream_messages
from logscore.sources.tables import raw_exfil, raw_login, raw_typed, table, user_features
from logscore.streaming.batch import Batch
from logscore.streaming.each import EachEvent
from logscore.streaming.ledger import LedgerWriter, read_committed
from logscore.streaming.sinks import file_writer
from logscore.streaming.stream import start_scoring

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-02-01T00:00:00.000000Z"
LOOKED_UP_USER = "42"


def flat_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", "model_id", "timestamp", "score", "data.*", "source_event_id"
    )


def _valid_login(spark: SparkSession, folder: str, policy: str = "pydantic") -> DataFrame:
    return valid_rows(raw_login(spark, folder), LOGIN, policy)


def _with_features(spark: SparkSession, folder: str, unknown_users: str = "score") -> DataFrame:
    return lookups.lookup(
        _valid_login(spark, folder),
        user_features(spark, folder),
        login_features(),
        unknown_users=unknown_users,
    )


def decode_ok(spark: SparkSession, folder: str) -> DataFrame:
    return raw_login(spark, folder).where(is_json()).select("offset")


def decode_objects(spark: SparkSession, folder: str) -> DataFrame:
    decoded = decode(raw_login(spark, folder), LOGIN.columns)
    return decoded.where("_is_object").select("offset")


def required_ok(spark: SparkSession, folder: str) -> DataFrame:
    flagged = check(raw_login(spark, folder), LOGIN, "lenient")
    lacking = F.col("reject_reason").rlike("^(malformed|not a JSON|missing)")
    return flagged.where(~F.coalesce(lacking, F.lit(False))).select("offset")


def uuid_ok(spark: SparkSession, folder: str) -> DataFrame:
    ids = Schema("ids", {"event_id": "str"}, ("event_id",))
    return valid_rows(raw_login(spark, folder), ids).select("offset", "event_id")


def valid_messages(policy: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _valid_login(spark, folder, policy).select("batch_id", "offset", *LOGIN.fields)

    return query


def valid_keep_raw(spark: SparkSession, folder: str) -> DataFrame:
    valid = valid_rows(raw_login(spark, folder), LOGIN, "strict", keep_raw=True)
    session = F.try_variant_get("raw", "$.session", "string")
    return valid.select("offset", "event_id", session.alias("session"))


def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw_login(spark, folder).select("offset", "value")
    policies = ("pydantic", "lenient", "strict")
    for policy in policies:  # one scan, a decode for each policy
        rows = check(rows, LOGIN, policy).select(
            *rows.columns, F.col("reject_reason").alias(f"why_{policy}")
        )
    whys = [F.struct(F.lit(p).alias("policy"), F.col(f"why_{p}").alias("reject_reason")) for p in policies]
    rows = rows.select("offset", F.inline(F.array(*whys)))
    return rows.where("reject_reason IS NOT NULL").select("policy", "offset", "reject_reason")


def typed_messages(policy: str) -> Query:
    schema = Schema("typed", {"ratio": "float", "flag": "bool"})

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return valid_rows(raw_typed(spark, folder), schema, policy)

    return query


def schema_not_found(spark: SparkSession, folder: str) -> DataFrame:
    missing = find_schema({LOGIN.name: LOGIN}, "app_log_type_none")
    return rejected_rows(raw_login(spark, folder), missing).select("offset", "reject_reason")


def _batch_events(spark: SparkSession, folder: str) -> DataFrame:
    return score_messages(
        raw_login(spark, folder),
        LOGIN,
        user_features(spark, folder),
        LoginAnomaly(),
        carry=("batch_id",),
        as_of=AS_OF,
    )


def counts_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return batch_counts(check(raw_login(spark, folder), LOGIN), _batch_events(spark, folder))


def events_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return _batch_events(spark, folder).groupBy("batch_id").agg(
        F.count("*").alias("events"),
        F.min("event_id").alias("first_event_id"),
        F.max("score").alias("top_score"),
        F.max("data.base_score").alias("top_base_score"),
    )


def exfil_messages(policy: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        valid = valid_rows(raw_exfil(spark, folder), EXFIL, policy)
        return valid.select("offset", *EXFIL.fields)

    return query


def features_table(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_features(user_features(spark, folder))


def feature_point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_features(lookups.feature_vector(user_features(spark, folder), LOOKED_UP_USER))


def _flat_features(features: DataFrame) -> DataFrame:
    return features.select(
        "user_id",
        "version",
        F.col("ip_address_profile.frequent_ips")[0].alias("frequent_ip"),
        "ip_address_profile.risk_score",
        F.col("user_agent_profile.common_agents")[0].alias("common_agent"),
        "user_agent_profile.device_type",
        F.col("country_code_profile.common_countries")[0].alias("common_country"),
        "country_code_profile.travel_freq",
    )


def distinct_users(spark: SparkSession, folder: str) -> DataFrame:
    return lookups.distinct_users(_valid_login(spark, folder))


_LOOKED_UP = ("event_id", "user_id", "has_features", "risk_score", "travel_freq")


def features_left(spark: SparkSession, folder: str) -> DataFrame:
    return _with_features(spark, folder).select(*_LOOKED_UP)


def features_inner(spark: SparkSession, folder: str) -> DataFrame:
    return _with_features(spark, folder, "skip").select(*_LOOKED_UP)


def features_anti(spark: SparkSession, folder: str) -> DataFrame:
    rows = _valid_login(spark, folder)
    return lookups.without_features(rows, user_features(spark, folder)).select(
        "event_id", "user_id"
    )


def base_scores(spark: SparkSession, folder: str) -> DataFrame:
    score = base_score(known("risk_score"), known("travel_freq"))
    return _with_features(spark, folder).select("event_id", "user_id", score.alias("base_score"))


def reasons(spark: SparkSession, folder: str) -> DataFrame:
    why = reason(known("risk_score"))
    return _with_features(spark, folder).select("event_id", "user_id", why.alias("reason"))


def hash_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows = messages_for(_valid_login(spark, folder), LoginAnomaly())
    return rows.select("source_event_id", "user_id", random_score("hash").alias("score"))


def threshold(spark: SparkSession, folder: str) -> DataFrame:
    model = LoginAnomaly(threshold=0.75)
    rows = messages_for(_valid_login(spark, folder), model)
    return model.before_lookup(rows).select("source_event_id", "user_id", "score")


def custom_score(spark: SparkSession, folder: str) -> DataFrame:
    model = LoginAnomaly(score=base_score(known("risk_score"), known("travel_freq")))
    return _login_events(spark, folder, model)


def _login_events(spark: SparkSession, folder: str, model, **options) -> DataFrame:
    events = score_messages(
        raw_login(spark, folder), LOGIN, user_features(spark, folder), model, as_of=AS_OF, **options
    )
    return flat_events(events)


def login_events(policy: str, unknown_users: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return _login_events(
            spark, folder, LoginAnomaly(), policy=policy, unknown_users=unknown_users
        )

    return query


def salted_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return _login_events(spark, folder, LoginAnomaly(), salt=8)


def pandas_model(spark: SparkSession, folder: str) -> DataFrame:
    return _login_events(spark, folder, login_anomaly_pandas())


EVENT_JSON = (
    "event_id STRING, user_id STRING, model_id STRING, timestamp STRING, score DOUBLE,"
    " data STRUCT<ip_address: STRING, country_code: STRING, user_agent: STRING,"
    " reason: STRING, base_score: DOUBLE>"
)


def sent_records(spark: SparkSession, folder: str) -> DataFrame:
    events = score_messages(
        raw_login(spark, folder),
        LOGIN,
        user_features(spark, folder),
        LoginAnomaly(),
        unknown_users="skip",
        as_of=AS_OF,
    )
    records = sink_records(events, key=True)
    read_back = records.select("key", "value", F.from_json("value", EVENT_JSON).alias("event"))
    # Members that are null are written out.
    null_agent = F.col("value").contains('"user_agent":null')
    return read_back.select(
        "key",
        "event.event_id",
        "event.user_id",
        "event.model_id",
        "event.timestamp",
        "event.score",
        "event.data.*",
        null_agent.alias("null_agent_written"),
    )


BIG = 9007199254740993  # not a float


def pandas_exfil(spark: SparkSession, folder: str) -> DataFrame:
    """Large integers, nulls among them, through a Python model."""
    model = PandasModel(
        function=lambda frame: frame.assign(score=1.0),
        adds="score double",
        data=("file_size", "destination"),
        model_id="exfil",
        inputs=("user_id", "file_size", "destination"),
    )
    valid = valid_rows(raw_exfil(spark, folder), EXFIL, "pydantic")
    valid = valid.withColumns(
        {
            "file_size": F.col("file_size") + BIG,
            "big": F.when(F.col("offset") % 3 != 0, F.col("offset") + BIG),
        }
    )
    features = user_features(spark, folder)
    carry = ("offset", "big")
    events = score_valid(valid, features, model, key=("offset",), carry=carry, as_of=AS_OF)
    exact = [F.col(c).cast("string").alias(c.split(".")[-1]) for c in ("big", "data.file_size")]
    return events.select("offset", *exact, "data.destination", "score")


def unnamed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that name no model and have no data, as they are sent."""
    scored = hash_scores(spark, folder).withColumn("data", F.lit(None).cast("struct<x: string>"))
    records = sink_records(envelope(scored, None, as_of=AS_OF), key=True)
    member = {c: F.get_json_object("value", f"$.{c}") for c in ("user_id", "model_id", "data")}
    return records.select("key", *(value.alias(name) for name, value in member.items()))


def stored_features(layout: str) -> Query:
    """The features written as a table of that layout and read back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = scratch_folder(spark, "features")
        features = user_features(spark, folder)
        features.write.format({"json_lines": "json"}.get(layout, layout)).save(path)
        return _flat_features(read_features(spark, path, layout))

    return query


def features_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The login events, with the features from a table bucketed by user."""
    name = f"features_{uuid.uuid4().hex}"
    path, features = scratch_folder(spark, name), user_features(spark, folder)
    features = save_by_user(features, name, 8, path)
    return flat_events(
        score_messages(raw_login(spark, folder), LOGIN, features, LoginAnomaly(), as_of=AS_OF)
    )


def events_without_features(spark: SparkSession, folder: str) -> DataFrame:
    """The login events where there is no features file: every user scores as unknown."""
    features = read_features(spark, scratch_folder(spark, "nothing"))
    return flat_events(
        score_messages(raw_login(spark, folder), LOGIN, features, LoginAnomaly(), as_of=AS_OF)
    )


def event_times(spark: SparkSession, folder: str) -> DataFrame:
    """The time text of an event that is made at the time of each row, in the three forms."""
    rows = table(spark, folder, "events")
    zones = [event_time(zone, F.col("ts")).alias(zone) for zone in ("utc", "local", "offset")]
    return rows.select(F.col("event_id").alias("event"), *zones)


def features_json_object(spark: SparkSession, folder: str) -> DataFrame:
    """The features written as a file that is one JSON object, and read back by byte ranges.

    Each user is in it twice, first with a vector that does not count. One task writes the file.
    """
    path = scratch_folder(spark, "features")
    features = user_features(spark, folder)
    vector = F.struct(*(c for c in features.columns if c != "user_id"))
    member = F.concat(F.lit(',"'), "user_id", F.lit('":'))
    lines = features.select(
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("place"), F.concat(member, F.lit('{"version":"{old}"}'))),
                F.struct(F.lit(2).alias("place"), F.concat(member, F.to_json(vector))),
            )
        ).alias("place", "line")
    )
    edges = spark.createDataFrame([(0, '{"nobody":null'), (3, "}")], "place int, line string")
    whole = lines.union(edges).repartition(1).sortWithinPartitions("place")
    whole.select("line").write.text(path)
    return _flat_features(read_features(spark, path, "json_object"))


def _message_files(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """Messages written as text files, to be read as a stream in four micro-batches."""
    path = scratch_folder(spark, "messages")
    files = 4 * -(-max(4, messages.rdd.getNumPartitions()) // 4)
    messages.select("value").repartition(files).write.text(path)
    return stream_messages(spark, "text", {"maxFilesPerTrigger": str(files // 4)}, path)


def _written(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What a file writer has written; it makes no folder when there is nothing to write."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class _Picky:
    """A sink that refuses events whose id begins with three zeros."""

    def send(self, records: list[tuple[str | None, str]]) -> dict[int, str]:
        return {i: "refused" for i, (key, _) in enumerate(records) if key.startswith("000")}

    def close(self) -> None:
        pass


def stream_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """A sink that refuses some events gets all others; those go to the dead letters."""
    sent, dead, checkpoint = (scratch_folder(spark, x) for x in ("events", "dead", "checkpoint"))
    stream = _message_files(spark, raw_login(spark, folder))
    features = user_features(spark, folder)
    start_scoring(
        stream,
        LOGIN,
        features,
        LoginAnomaly(),
        checkpoint=checkpoint,
        write=EachEvent(lambda place: _Picky()),
        write_dead_letter=file_writer(dead),
        trigger={"availableNow": True},
        options={"as_of": AS_OF},
        delivery={"first_wait": 0.0, "write_sent": file_writer(sent)},
    ).awaitTermination()
    schema = score_messages(raw_login(spark, folder), LOGIN, features, LoginAnomaly()).schema
    parts = [
        flat_events(_written(spark, path, schema)).withColumn("sink", F.lit(name))
        for name, path in (("events", sent), ("dead_letters", dead))
    ]
    return parts[0].union(parts[1])


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """A stream that stops in the middle of writing a micro-batch and starts again: by the ledgers,
    each event is there once."""
    sent, dead, checkpoint = (scratch_folder(spark, x) for x in ("events", "dead", "checkpoint"))
    dies = [True]

    class Dying(LedgerWriter):
        def __call__(self, events: DataFrame, batch: Batch) -> None:
            if batch.id == 1 and dies:
                dies.clear()
                raise OSError("no room left")
            super().__call__(events, batch)

    stream = _message_files(spark, raw_login(spark, folder))
    features = user_features(spark, folder)
    for _ in range(2):
        try:
            start_scoring(
                stream,
                LOGIN,
                features,
                LoginAnomaly(),
                checkpoint=checkpoint,
                write=EachEvent(lambda place: _Picky()),
                write_dead_letter=Dying(dead),
                trigger={"availableNow": True},
                options={"as_of": AS_OF},
                delivery={"first_wait": 0.0, "write_sent": LedgerWriter(sent)},
            ).awaitTermination()
        except StreamingQueryException as stopped:
            if "no room left" not in str(stopped):
                raise
    schema = score_messages(raw_login(spark, folder), LOGIN, features, LoginAnomaly()).schema
    parts = [
        flat_events(read_committed(spark, path, schema)).withColumn("sink", F.lit(name))
        for name, path in (("events", sent), ("dead_letters", dead))
    ]
    return parts[0].union(parts[1])


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """How many messages a stream rejects for each reason, from its rejects sink."""
    sent, rejects, checkpoint = (
        scratch_folder(spark, x) for x in ("events", "rejects", "checkpoint")
    )
    start_scoring(
        _message_files(spark, raw_login(spark, folder)),
        LOGIN,
        user_features(spark, folder),
        LoginAnomaly(),
        checkpoint=checkpoint,
        write=file_writer(sent),
        write_rejected=file_writer(rejects),
        trigger={"availableNow": True},
    ).awaitTermination()
    rows = _written(spark, rejects, T.StructType.fromDDL("value string, reject_reason string"))
    return rows.groupBy("reject_reason").agg(F.count("*").alias("messages"))


def _contained(
    spark: SparkSession,
    folder: str,
    stream: DataFrame,
    model: PandasModel,
    contain: str,
    arrivals: list[Callable[[], None]],
) -> list[DataFrame]:
    """What a stream with that model sends, and what it sets aside, with the model's error. It is
    started once more after each of the arrivals."""
    sent, aside, checkpoint = (scratch_folder(spark, x) for x in ("events", "aside", "checkpoint"))
    for arrive in [lambda: None, *arrivals]:
        arrive()
        start_scoring(
            stream,
            LOGIN,
            user_features(spark, folder),
            model,
            checkpoint=checkpoint,
            write=file_writer(sent),
            write_failed=file_writer(aside),
            contain_failures=contain,
            trigger={"availableNow": True},
            options={"as_of": AS_OF},
        ).awaitTermination()
    schemas = "source_event_id string", "value string, model_error string"
    return [
        _written(spark, path, T.StructType.fromDDL(schema))
        for path, schema in zip((sent, aside), schemas, strict=True)
    ]


def _failing(fails: Callable[[pd.DataFrame], pd.Series]) -> PandasModel:
    """The login rule, but for an error on some messages."""
    login = login_anomaly_pandas()

    def function(frame: pd.DataFrame) -> pd.DataFrame:
        if fails(frame).any():
            raise ValueError("no score for this message")
        return login.function(frame)

    return replace(login, function=function)


def stream_contained(spark: SparkSession, folder: str) -> DataFrame:
    """A model that fails on some messages: these are set aside, all others scored."""
    model = _failing(lambda frame: frame["source_event_id"].str.startswith("000"))
    stream = _message_files(spark, raw_login(spark, folder))
    events, failed = _contained(spark, folder, stream, model, "message", [])
    events = events.select(
        F.lit("events").alias("sink"), "source_event_id", F.lit(None).alias("model_error")
    )
    event_id = F.get_json_object("value", "$.event_id")
    return events.union(failed.select(F.lit("failed"), event_id, "model_error"))


def stream_contained_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A model that fails on a message of one micro-batch: that is set aside whole, the others are
    scored."""
    path, raw = scratch_folder(spark, "messages"), raw_login(spark, folder)
    raw.where("batch_id = 0").select("value").repartition(1).write.text(path)
    failing = raw.where("offset = 11").first()["value"]
    failing = json.loads(failing)["event_id"]
    model = _failing(lambda frame: frame["source_event_id"] == failing)

    def others_arrive() -> None:
        raw.where("batch_id <> 0").select("value").write.mode("append").text(path)

    stream = stream_messages(spark, "text", {}, path)
    written = _contained(spark, folder, stream, model, "batch", [others_arrive])
    counts = [
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("sink"), "rows")
        for name, rows in zip(("events", "failed"), written, strict=True)
    ]
    return counts[0].union(counts[1])


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The messages written as text files, then scored as a stream into a table of events."""
    sent, checkpoint = scratch_folder(spark, "events"), scratch_folder(spark, "checkpoint")
    stream = _message_files(spark, raw_login(spark, folder))
    features = user_features(spark, folder)
    events = score_messages(stream, LOGIN, features, LoginAnomaly(), as_of=AS_OF)
    query = (
        events.writeStream.format("parquet")
        .option("path", sent)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return flat_events(spark.read.schema(events.schema).parquet(sent))


_QUERIES: dict[str, Query] = {
    "decode_ok": decode_ok,
    "decode_objects": decode_objects,
    "required_ok": required_ok,
    "uuid_ok": uuid_ok,
    "valid_strict": valid_messages("strict"),
    "valid_lenient": valid_messages("lenient"),
    "valid_pydantic": valid_messages("pydantic"),
    "valid_keep_raw": valid_keep_raw,
    "reject_reasons": reject_reasons,
    "schema_not_found": schema_not_found,
    "batch_counts": counts_per_batch,
    "batch_events": events_per_batch,
    "exfil_strict": exfil_messages("strict"),
    "exfil_lenient": exfil_messages("lenient"),
    "exfil_pydantic": exfil_messages("pydantic"),
    "typed_strict": typed_messages("strict"),
    "typed_lenient": typed_messages("lenient"),
    "typed_pydantic": typed_messages("pydantic"),
    "features_table": features_table,
    "feature_point_lookup": feature_point_lookup,
    "distinct_users": distinct_users,
    "features_left": features_left,
    "features_inner": features_inner,
    "features_anti": features_anti,
    "base_score": base_scores,
    "reason": reasons,
    "hash_score": hash_scores,
    "threshold": threshold,
    "custom_score": custom_score,
    "events_score_unknown": login_events("pydantic", "score"),
    "events_skip_unknown": login_events("pydantic", "skip"),
    "events_lenient": login_events("lenient", "skip"),
    "events_strict": login_events("strict", "score"),
    "salted_lookup": salted_lookup,
    "sink_records": sent_records,
    "pandas_model": pandas_model,
    "stream_events": stream_events,
    "stream_dead_letters": stream_dead_letters,
    "stream_restart": stream_restart,
    "stream_rejects": stream_rejects,
    "stream_contained": stream_contained,
    "stream_contained_batch": stream_contained_batch,
    "pandas_exfil": pandas_exfil,
    "unnamed_events": unnamed_events,
    "features_parquet": stored_features("parquet"),
    "features_json_lines": stored_features("json_lines"),
    "features_json_object": features_json_object,
    "features_bucketed": features_bucketed,
    "events_without_features": events_without_features,
    "event_times": event_times,
}


def _configured(query: Query) -> Query:
    return lambda spark, folder: query(configure(spark), folder)


def queries() -> dict[str, Query]:
    return {name: _configured(query) for name, query in _QUERIES.items()}
