"""Runs a query on Spark and its SQL on DuckDB and compares the rows, in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "" if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql) -> str | None:
    """None if columns and rows agree, else what differs."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, expected.fetchall())
    got = _rows(df.columns, df.collect())
    if got == want:
        return None
    odd = [(g, w) for g, w in zip(got, want) if g != w][:3]
    return f"{len(got)} rows, expected {len(want)}; first differences {odd}"
