"""Compare a registered query with its oracle, value by value."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, int):
        return repr(v)
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    got_columns = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, oracle {len(want)}"
    a, b = _rows(got_columns, got), _rows(want_columns, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
