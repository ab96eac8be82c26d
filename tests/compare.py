"""Order-insensitive comparison of a Spark result with the oracle's."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if both agree, else a short description."""
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    expected = sorted_rows(names, got.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = sorted_rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            return f"{sorted(names)}: {a} != {e}"
    return None
