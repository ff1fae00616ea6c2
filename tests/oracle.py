"""Compares a Spark result with DuckDB's, row for row."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(df) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    return cols, Counter(tuple(_plain(r[c]) for c in cols) for r in df.collect())


def oracle_rows(con, sql: str) -> tuple[list[str], Counter]:
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, Counter(tuple(_plain(r[i]) for i in at) for r in res.fetchall())
