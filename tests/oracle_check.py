"""Runs queries against their SQL and reports differences: python -m tests.oracle_check [folder]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from __spark_entry__ import oracle_sql, queries


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(frame.itertuples(index=False, name=None), key=repr)


def difference(spark, db: duckdb.DuckDBPyConnection, folder: str, name: str) -> str | None:
    """What is different between the query and its SQL, None if nothing is."""
    ours = queries()[name](spark, folder).toPandas()
    theirs = db.execute(oracle_sql()[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for a, b in zip(_rows(ours), _rows(theirs), strict=True):
        if a != b:
            return f"first different row {a} and {b}"
    return None


def main() -> None:
    from tests.conftest import new_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(oracle_sql())
    spark, db = new_session(), connect(folder)
    for name in wanted:
        start = time.time()
        result = difference(spark, db, folder, name)
        print(f"{name:24} {time.time() - start:6.2f}s  {result or 'same'}", flush=True)


if __name__ == "__main__":
    main()
