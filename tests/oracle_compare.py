"""Run a registered query and its DuckDB oracle; compare rows order-insensitively."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x) if x is not None else (True, "", "") for x in row)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_cols = sorted(spark_df.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    if sorted(d_cols) != s_cols:
        return False, f"columns differ: spark={s_cols} duck={sorted(d_cols)}"
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    s_sorted, d_sorted = sorted(s_rows, key=_key), sorted(d_rows, key=_key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(s_cols, a, b) if x != y]
            return False, f"first differing row: {diff[:5]}"
    return True, f"{len(s_rows)} rows"
