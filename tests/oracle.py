"""Run a query in Spark and its SQL in DuckDB and compare the results."""

from __future__ import annotations

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark, con, fn, sql, sf_dir):
    """None when both agree, else a short description of the first difference."""
    df = fn(spark, sf_dir)
    left_cols, left = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    right_cols, right = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"first difference\n  spark {str(a)[:400]}\n  duck  {str(b)[:400]}"
    return None
