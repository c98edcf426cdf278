"""DuckDB over the same Parquet tables, and a comparison that ignores the order of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.001"


def cell(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)
    if isinstance(x, (list, tuple)):
        return tuple(cell(y) for y in x)
    if isinstance(x, dict):
        return tuple(sorted((str(k), cell(v)) for k, v in x.items()))
    return x


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def of_spark(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def of_duckdb(sql: str, folder: str = SF_DIR):
    con = duckdb.connect()
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = con.execute(sql)
    return table([c[0] for c in got.description], got.fetchall())
