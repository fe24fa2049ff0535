"""Compare a Spark result with the result of its SQL, row by row."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in (TESTDATA / sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(value, float):
        return repr(value)
    return value if value is None else str(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> str:
    """Empty when columns, row counts and all values agree."""
    cursor = con.execute(sql)
    theirs = [d[0] for d in cursor.description]
    expected = canonical(theirs, cursor.fetchall())
    got = canonical(spark_df.columns, spark_df.collect())
    if sorted(spark_df.columns) != sorted(theirs):
        return f"columns {sorted(spark_df.columns)} against {sorted(theirs)}"
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    for ours, other in zip(got, expected):
        if ours != other:
            return f"{ours} against {other}"
    return ""
