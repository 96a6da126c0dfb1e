"""Compares a query with its SQL twin: same columns, same rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.5g}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.5g}" if abs(value) < 10_000 else str(value)
    if isinstance(value, (list, tuple)):
        return str([_cell(v) for v in value])
    return None if value is None else str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(_cell(r[k]) for k in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = rows_of(df.columns, df.collect()), rows_of(names, found.fetchall())
    if len(a) != len(b):
        return f"rows {len(a)} and {len(b)}"
    off = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(off)} of {len(a)} rows differ, first {off[0]}" if off else ""
