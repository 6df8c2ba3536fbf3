"""Differential check of one driver query: Spark result vs DuckDB oracle SQL
(row count, column names, order-insensitive values)."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, con, sql):
    srows = [tuple(r) for r in spark_df.collect()]
    scols = list(spark_df.columns)
    rel = con.sql(sql)
    dcols = list(rel.columns)
    drows = rel.fetchall()
    sc, sr = canon(scols, srows)
    dc, dr = canon(dcols, drows)
    problems = []
    if sc != dc:
        problems.append(f"columns {sc} != {dc}")
    if len(sr) != len(dr):
        problems.append(f"rows {len(sr)} != {len(dr)}")
    elif sr != dr:
        bad = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {bad}")
    return problems, len(sr)
