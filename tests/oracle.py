"""Run a registered query in Spark and its oracle in DuckDB; compare rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}")
        return problems, len(s_rows), len(d_rows)
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} duck={len(d_rows)}")
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        problems.append(f"values differ: spark-only {only_s} duck-only {only_d}")
    return problems, len(s_rows), len(d_rows)
