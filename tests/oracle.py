"""Run a query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{d}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}") + 0.0
    if hasattr(v, "tzinfo"):
        return v.replace(tzinfo=None)
    return v


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in data]
    return sorted(out, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), rows(columns, result.fetchall())
