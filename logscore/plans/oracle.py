"""The results of `queries.py` as SQL over the given tables.

Written from the fault numbers (`event_id % 100` and `event_id % 10`), without any JSON, so that it
shares no step with the decoder it checks.
"""

from __future__ import annotations

AS_OF = "2024-02-01T00:00:00.000000Z"

_UUID = (
    r"regexp_replace(md5({}), '^(.{{8}})(.{{4}}).(.{{3}}).(.{{3}})(.{{12}})$', '\1-\2-4\3-8\4-\5')"
)
_SCORE = "('0x' || substr(md5({}), 1, 8))::UBIGINT::DOUBLE / 4294967296::DOUBLE"

_SENT = f"""
sent AS (
  SELECT e.event_id AS n, e.event_id % 100 AS fault, e.event_id % 10 AS way, e.value AS amount,
         {_UUID.format("CAST(e.event_id AS VARCHAR)")} AS made_id,
         e.event_type AS log_type,
         '10.' || (e.user_id % 256) || '.' || (e.event_id % 256) || '.1' AS ip_address,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp,
         e.user_id AS user_number
  FROM events e
)"""

_LOGIN = f"""{_SENT},
login AS (
  SELECT n, n // 100 AS batch_id, fault,
         CASE fault WHEN 5 THEN 'not-a-uuid'
                    WHEN 6 THEN substr(made_id, 1, 14) || '1' || substr(made_id, 16)
                    ELSE made_id END AS event_id,
         log_type, ip_address, event_timestamp,
         CASE WHEN fault = 10 THEN '' ELSE CAST(user_number AS VARCHAR) END AS user_id,
         CASE WHEN fault NOT IN (9, 14) THEN 'agent-' || (n % 5) END AS user_agent,
         CASE WHEN fault <> 15 THEN n_name END AS country_code
  FROM sent JOIN nation ON user_number % 25 = n_nationkey
)"""

_UNREADABLE = {0: "malformed JSON", 1: "not a JSON object", 2: "not a JSON object"}
_MISSING = {3: "user_id", 4: "user_id", 12: "event_id"}
_NO_UUID = "field event_id: not acceptable as a version-4 UUID"
_NO_TEXT = "field {}: not acceptable as str"
_REJECTED = {
    "pydantic": {5: _NO_UUID, 6: _NO_UUID, 7: _NO_TEXT.format("user_id")},
    "lenient": {},
    "strict": {7: _NO_TEXT.format("user_id"), 9: _NO_TEXT.format("user_agent")},
}


def _reasons(policy: str) -> dict[int, str]:
    missing = {f: f"missing required field: {c}" for f, c in _MISSING.items()}
    return _UNREADABLE | missing | _REJECTED[policy]


def _valid(policy: str) -> str:
    agent = "CASE WHEN fault = 9 THEN '<nil>' ELSE user_agent END" if policy == "lenient" else "user_agent"
    faults = ", ".join(map(str, sorted(_reasons(policy))))
    return f"""
valid AS (
  SELECT * REPLACE ({agent} AS user_agent) FROM login WHERE fault NOT IN ({faults})
)"""


_FEATURES = """
features AS (
  SELECT CAST(k AS VARCHAR) AS user_id,
         CASE WHEN m <> 5 THEN '2024-02-10' END AS version,
         CASE WHEN m <> 5 THEN '10.' || (k % 256) || '.0.1' END AS frequent_ip,
         CASE WHEN m NOT IN (5, 7) THEN ((k * 37) % 100) / CAST(100 AS DOUBLE) END AS risk_score,
         CASE WHEN m <> 5 THEN 'agent-' || (k % 5) END AS common_agent,
         CASE WHEN m <> 5 THEN c_mktsegment END AS device_type,
         CASE WHEN m NOT IN (5, 8) THEN n_name END AS common_country,
         CASE WHEN m NOT IN (5, 8) THEN CAST(k % 8 AS DOUBLE) END AS travel_freq,
         m = 5 AS empty
  FROM (SELECT *, c_custkey AS k, c_custkey % 10 AS m FROM customer)
  JOIN nation ON c_nationkey = n_nationkey
  WHERE m <> 0
)"""

_RISK = "coalesce(risk_score, CAST(0 AS DOUBLE))"
_FREQ = "coalesce(travel_freq, CAST(0 AS DOUBLE))"
_BASE = (
    f"least(CAST(1 AS DOUBLE), ({_RISK} + {_FREQ} * CAST(0.1 AS DOUBLE)) * CAST(1.5 AS DOUBLE))"
)
_WHY = f"CASE WHEN {_RISK} > CAST(0.5 AS DOUBLE) THEN 'high_risk_ip' ELSE 'unusual_country' END"


def _known(policy: str, unknown_users: str) -> str:
    """The valid messages with the features of their user."""
    join = (
        "LEFT JOIN features f USING (user_id)"
        if unknown_users == "score"
        else "JOIN (FROM features WHERE NOT empty) f USING (user_id)"
    )
    return f"""WITH {_LOGIN}, {_valid(policy)}, {_FEATURES},
known AS (
  SELECT v.*, f.user_id IS NOT NULL AS has_features, f.risk_score, f.travel_freq
  FROM valid v {join}
)"""


def _events(policy: str, unknown_users: str, score: str | None = None, at_least: float = 0.5) -> str:
    new_id = _UUID.format("'loginanomaly:' || event_id")
    return f"""{_known(policy, unknown_users)},
event AS (
  SELECT {new_id} AS event_id, user_id, 'loginanomaly' AS model_id, '{AS_OF}' AS "timestamp",
         {score or _SCORE.format("event_id")} AS score,
         ip_address, country_code, user_agent, {_WHY} AS reason, {_BASE} AS base_score,
         event_id AS source_event_id, batch_id
  FROM known WHERE user_id <> ''
),
produced AS (SELECT * FROM event WHERE score >= CAST({at_least} AS DOUBLE))"""


def _flat(events: str) -> str:
    return f"{events} SELECT * EXCLUDE (batch_id) FROM produced"


_MESSAGE = "event_id, log_type, ip_address, event_timestamp, user_id, user_agent, country_code"


def _valid_login(policy: str, select: str) -> str:
    return f"WITH {_LOGIN}, {_valid(policy)} SELECT {select} FROM valid"


def _exfil(policy: str) -> str:
    whole = "CAST(floor(amount) AS BIGINT)"
    sizes = {
        "pydantic": {0: whole, 9: whole, 1: whole, 4: "1", 5: "NULL", 6: "NULL", 7: "12", 8: "12"},
        "lenient": {0: whole, 9: whole, 1: whole, 3: "12", 6: "NULL", 7: "12"},
        "strict": {0: whole, 9: whole, 6: "NULL", 7: "12"},
    }[policy]
    cases = " ".join(f"WHEN {way} THEN {size}" for way, size in sizes.items())
    return f"""WITH {_SENT}
SELECT n AS "offset", made_id AS event_id, log_type, ip_address, event_timestamp,
       CAST(user_number AS VARCHAR) AS user_id,
       CAST(CASE way {cases} END AS BIGINT) AS file_size,
       'host-' || (user_number % 7) AS destination
FROM sent WHERE way IN ({", ".join(map(str, sizes))})"""


def _typed(policy: str) -> str:
    """By policy, what each way of giving a number and a truth value comes to."""
    half, whole, read = "floor(value) + 0.5", "floor(value)", policy != "strict"
    ratios = {0: half, 2: whole, 8: "NULL"}
    flags = {0: "true", 1: "false", 9: "NULL"}
    if read:
        ratios |= {1: half, 4: "1000"}
        flags |= {4: "true", 6: "false"}
    if policy == "pydantic":
        ratios |= {3: "1.5", 5: "1", 6: "NULL", 10: "10.5"}
        flags |= {2: "true", 5: "true", 7: "NULL"}

    def cases(values: dict[int, str]) -> str:
        return " ".join(f"WHEN {way} THEN {value}" for way, value in values.items())

    return f"""
SELECT event_id AS "offset", CAST(CASE event_id % 11 {cases(ratios)} END AS DOUBLE) AS ratio,
       CAST(CASE event_id // 11 % 10 {cases(flags)} END AS BOOLEAN) AS flag
FROM events WHERE event_id % 11 IN ({", ".join(map(str, ratios))})
  AND event_id // 11 % 10 IN ({", ".join(map(str, flags))})"""


def _rejects() -> str:
    parts = []
    for policy in _REJECTED:
        cases = " ".join(f"WHEN {fault} THEN '{why}'" for fault, why in _reasons(policy).items())
        faults = ", ".join(map(str, _reasons(policy)))
        parts.append(
            f"""SELECT '{policy}' AS policy, event_id AS "offset",
       CASE event_id % 100 {cases} END AS reject_reason
FROM events WHERE event_id % 100 IN ({faults})"""
        )
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    events = _events("pydantic", "score")
    offsets = 'SELECT event_id AS "offset" FROM events WHERE event_id % 100 NOT IN ({})'
    picky = f"""{events}
SELECT * EXCLUDE (batch_id),
       CASE WHEN event_id LIKE '000%' THEN 'dead_letters' ELSE 'events' END AS sink
FROM produced"""
    flat_features = f"WITH {_FEATURES} SELECT * EXCLUDE (empty) FROM features"
    looked_up = "event_id, user_id, has_features, risk_score, travel_freq"
    scored = f"event_id AS source_event_id, user_id, {_SCORE.format('event_id')} AS score"
    in_batch = f'batch_id, n AS "offset", {_MESSAGE}'
    unreadable_pydantic = ", ".join(map(str, sorted(_reasons("pydantic"))))
    return {
        "decode_ok": offsets.format("0"),
        "decode_objects": offsets.format("0, 1, 2"),
        "required_ok": offsets.format("0, 1, 2, 3, 4, 12"),
        "uuid_ok": f"""WITH {_LOGIN}
SELECT n AS "offset", event_id FROM login WHERE fault NOT IN (0, 1, 2, 5, 6, 12)""",
        "valid_strict": _valid_login("strict", in_batch),
        "valid_lenient": _valid_login("lenient", in_batch),
        "valid_pydantic": _valid_login("pydantic", in_batch),
        "valid_keep_raw": _valid_login(
            "strict",
            "n AS \"offset\", event_id, CASE WHEN fault = 8 THEN 's-1' END AS session",
        ),
        "reject_reasons": _rejects(),
        "schema_not_found": """SELECT event_id AS "offset",
       'schema not found: app_log_type_none' AS reject_reason FROM events""",
        "batch_counts": f"""WITH {_LOGIN}
SELECT batch_id, count(*) AS fetched,
       count(*) FILTER (fault IN ({unreadable_pydantic})) AS dropped,
       count(*) FILTER (fault NOT IN ({unreadable_pydantic})) AS valid,
       count(*) FILTER (fault NOT IN ({unreadable_pydantic}) AND user_id <> ''
                        AND {_SCORE.format("event_id")} >= CAST(0.5 AS DOUBLE)) AS produced
FROM login GROUP BY batch_id""",
        "batch_events": f"""{events}
SELECT batch_id, count(*) AS events, min(event_id) AS first_event_id, max(score) AS top_score,
       max(base_score) AS top_base_score
FROM produced GROUP BY batch_id""",
        "exfil_strict": _exfil("strict"),
        "exfil_lenient": _exfil("lenient"),
        "exfil_pydantic": _exfil("pydantic"),
        "typed_strict": _typed("strict"),
        "typed_lenient": _typed("lenient"),
        "typed_pydantic": _typed("pydantic"),
        "features_table": flat_features,
        "feature_point_lookup": f"{flat_features} WHERE user_id = '42'",
        "distinct_users": _valid_login("pydantic", "DISTINCT user_id") + " WHERE user_id <> ''",
        "features_left": f"{_known('pydantic', 'score')} SELECT {looked_up} FROM known",
        "features_inner": f"{_known('pydantic', 'skip')} SELECT {looked_up} FROM known",
        "features_anti": f"""WITH {_LOGIN}, {_valid("pydantic")}, {_FEATURES}
SELECT event_id, user_id FROM valid
WHERE user_id NOT IN (SELECT user_id FROM features WHERE NOT empty)""",
        "base_score": f"""{_known("pydantic", "score")}
SELECT event_id, user_id, {_BASE} AS base_score FROM known""",
        "reason": f"""{_known("pydantic", "score")}
SELECT event_id, user_id, {_WHY} AS reason FROM known""",
        "hash_score": _valid_login("pydantic", scored),
        "threshold": _valid_login("pydantic", scored)
        + f" WHERE user_id <> '' AND {_SCORE.format('event_id')} >= CAST(0.75 AS DOUBLE)",
        "custom_score": _flat(_events("pydantic", "score", _BASE)),
        "events_score_unknown": _flat(events),
        "events_skip_unknown": _flat(_events("pydantic", "skip")),
        "events_lenient": _flat(_events("lenient", "skip")),
        "events_strict": _flat(_events("strict", "score")),
        "salted_lookup": _flat(events),
        "sink_records": f"""{_events("pydantic", "skip")}
SELECT event_id AS "key", * EXCLUDE (batch_id, source_event_id),
       user_agent IS NULL AS null_agent_written
FROM produced""",
        "pandas_model": _flat(events),
        "stream_events": _flat(events),
        "stream_dead_letters": picky,
        "stream_restart": picky,
        "stream_rejects": f"""SELECT reject_reason, count(*) AS messages FROM ({_rejects()})
WHERE policy = 'pydantic' GROUP BY reject_reason""",
        "stream_contained": f"""{events}
SELECT 'events' AS sink, source_event_id, NULL AS model_error
FROM produced WHERE source_event_id NOT LIKE '000%'
UNION ALL SELECT 'failed', source_event_id, 'ValueError: no score for this message'
FROM event WHERE source_event_id LIKE '000%'""",
        "stream_contained_batch": f"""{events}
SELECT 'events' AS sink, count(*) AS rows FROM produced WHERE batch_id <> 0
UNION ALL SELECT 'failed', count(*) FROM events WHERE event_id // 100 = 0""",
        "pandas_exfil": f"""SELECT "offset",
       CAST(CASE WHEN "offset" % 3 <> 0 THEN "offset" + 9007199254740993 END AS VARCHAR) AS big,
       CAST(file_size + 9007199254740993 AS VARCHAR) AS file_size, destination, CAST(1 AS DOUBLE) AS score
FROM ({_exfil("pydantic")})""",
        "unnamed_events": _valid_login(
            "pydantic",
            f"{_UUID.format("'unknown_model:' || event_id")} AS \"key\", user_id, "
            "'unknown_model' AS model_id, '{}' AS data",
        ),
        "features_parquet": flat_features,
        "features_json_lines": flat_features,
        "features_json_object": flat_features,
        "features_bucketed": _flat(events),
        "events_without_features": _flat(events).replace("WHERE m <> 0", "WHERE false"),
        "event_times": """
SELECT event_id AS event, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS utc,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "local",
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "offset"
FROM events""",
    }
