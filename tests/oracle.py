"""Comparison of a query with its SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Asserts equal columns and rows, order aside; returns the number of rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    expected = _rows(names, cursor.fetchall())
    actual = _rows(df.columns, df.collect())
    assert len(actual) == len(expected)
    assert actual == expected
    return len(actual)
