"""Compare a Spark result with its SQL counterpart in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _table(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def difference(df: DataFrame, sql: str, con) -> str | None:
    """None when equal, else the first thing that differs."""
    got_columns = df.columns
    got = _table(got_columns, df.collect())
    cur = con.execute(sql)
    want_columns = [d[0] for d in cur.description]
    want = _table(want_columns, cur.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        odd = set(got_columns) ^ set(want_columns)
        return f"columns differ: {sorted(odd)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    names = sorted(got_columns)
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            cells = [(n, x, y) for n, x, y in zip(names, a, b) if repr(x) != repr(y)]
            return f"row differs: {cells[:6]} in {a[:4]}"
    return None
