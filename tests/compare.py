"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's check:
row count, column names, order-insensitive multiset of values)."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import duckdb

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in ("part", "orders", "lineitem"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    return v


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    cols = spark_df.columns
    rows_s = [tuple(_norm(r[c]) for c in sorted(cols)) for r in spark_df.collect()]
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    if sorted(cols) != sorted(ocols):
        return False, f"columns differ: {sorted(cols)} vs {sorted(ocols)}"
    idx = [ocols.index(c) for c in sorted(cols)]
    rows_o = [tuple(_norm(r[i]) for i in idx) for r in orows]
    if len(rows_s) != len(rows_o):
        return False, f"row count {len(rows_s)} vs {len(rows_o)}"
    cs, co = Counter(rows_s), Counter(rows_o)
    if cs != co:
        only_s = list((cs - co).elements())[:3]
        only_o = list((co - cs).elements())[:3]
        return False, f"values differ: spark-only {only_s} oracle-only {only_o}"
    return True, f"{len(rows_s)} rows"
