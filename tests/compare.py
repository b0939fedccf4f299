"""Local stand-in for the driver's check: Spark query vs DuckDB oracle.

Row count, column names, and an order-insensitive hash of the values
(columns sorted by name) must agree.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def rows_hash(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, con, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    out = {"rows_spark": len(s_rows), "rows_oracle": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    hs, ls = rows_hash(s_cols, s_rows)
    hd, ld = rows_hash(d_cols, d_rows)
    out["hash_match"] = hs == hd
    if not out["hash_match"] or not out["cols_match"]:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols
        diff_s = sorted(set(ls) - set(ld))[:3]
        diff_d = sorted(set(ld) - set(ls))[:3]
        out["only_spark"] = diff_s
        out["only_oracle"] = diff_d
    return out
