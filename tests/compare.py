"""Runs a query and its SQL over the same tables and compares the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, float):
        return format(v, ".12g")
    return str(v)


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both sides agree, else what differs first."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(columns, result.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(columns)}\n  ours   {a}\n  theirs {b}"
    return None
