"""Compare a query with its oracle: same columns, same multiset of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return bytes(value) if isinstance(value, bytearray) else value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if actual == expected:
        return None
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} vs {sum(expected.values())} rows; "
        f"{sum(extra.values())} only in Spark e.g. {next(iter(extra), None)}; "
        f"{sum(missing.values())} only in SQL e.g. {next(iter(missing), None)}; "
        f"columns {sorted(names)}"
    )
