"""Row-for-row comparison of a Spark result with the SQL oracle."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{folder}/{name}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, decimal.Decimal):
        return float(f"{float(value):.10g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None if both sides have the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(names, result.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}; only here {[r for r in mine if r not in set(theirs)][:2]} only there {[r for r in theirs if r not in set(mine)][:2]}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}\n  here  {str(a)[:900]}\n  there {str(b)[:900]}"
    return None
