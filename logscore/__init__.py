"""Log-event scoring on Spark: decode, validate, look up, score, emit.

Everything is a lazy DataFrame plan, so the same calls serve a batch DataFrame and a stream.
"""

from logscore.operators.envelope import envelope, sink_records
from logscore.operators.scoring import LoginAnomaly, PandasModel, login_anomaly_pandas
from logscore.operators.validate import batch_counts, check, rejected_rows, valid_rows
from logscore.plans.score import score_messages
from logscore.schema import EXFIL, LOGIN, Schema, find_schema, load_schemas
from logscore.session import configure
from logscore.streaming.sinks import deliver
from logscore.streaming.stream import start_scoring

__all__ = [
    "EXFIL",
    "LOGIN",
    "LoginAnomaly",
    "PandasModel",
    "Schema",
    "batch_counts",
    "check",
    "configure",
    "deliver",
    "envelope",
    "find_schema",
    "load_schemas",
    "login_anomaly_pandas",
    "rejected_rows",
    "score_messages",
    "sink_records",
    "start_scoring",
    "valid_rows",
]
