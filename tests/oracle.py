"""Runs a registered query and its SQL on the same tables and compares them, rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{directory}/{name}.parquet").exists():
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _ordered(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark, con, directory, query, sql) -> list[str]:
    df = query(spark, directory)
    left = _ordered([tuple(r) for r in df.collect()], df.columns)
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    right = _ordered(answer.fetchall(), names)
    out = []
    if sorted(df.columns) != sorted(names):
        out.append(f"columns {sorted(df.columns)} / {sorted(names)}")
    if len(left) != len(right):
        out.append(f"rows {len(left)} / {len(right)}")
    if not out and left != right:
        at = [(a, b) for a, b in zip(left, right) if a != b]
        out.append(f"{len(at)} rows differ, first {str(at[0])[:600]}")
    return out
