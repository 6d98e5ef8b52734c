"""Compares a query with its SQL the way the driver does: columns by name, rows in any order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, list | tuple):
        return tuple(map(normal, value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def differences(spark, fn, sql: str, sf_dir: str) -> str:
    """'' where the two agree, else what differs."""
    got = fn(spark, sf_dir)
    want = connect(sf_dir).execute(sql)
    names = [d[0] for d in want.description]
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} and {sorted(names)}"
    order = sorted(names)
    a = Counter(tuple(normal(r[c]) for c in order) for r in got.collect())
    at = [names.index(c) for c in order]
    b = Counter(tuple(normal(r[i]) for i in at) for r in want.fetchall())
    if a == b:
        return ""
    return f"rows {sum(a.values())} and {sum(b.values())}; only Spark: {list((a - b).items())[:3]}; only SQL: {list((b - a).items())[:3]}"
