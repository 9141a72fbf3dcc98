"""Spark-vs-DuckDB comparison in the way the driver checks queries:
row count, column names, and an order-insensitive hash of the values with
columns sorted by name."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
REPO = os.path.dirname(HERE)
if REPO not in sys.path:
    sys.path.insert(0, REPO)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, (dt.datetime,)):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):  # Decimal
        return repr(float(v))
    return repr(v)


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(
        "|".join(str(_norm(r[i])) for i in order) for r in rows
    )
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()


def compare(spark, name, fn, sql, sf_dir, con=None):
    """Returns a dict with counts, column check and hash match."""
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    out = {"query": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["oracle"] = None
        return out
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    out.update(
        oracle_rows=len(d_rows),
        columns_match=sorted(s_cols) == sorted(d_cols),
        hash_match=digest(s_cols, s_rows) == digest(d_cols, d_rows),
    )
    if not out["columns_match"]:
        out["spark_cols"] = s_cols
        out["oracle_cols"] = d_cols
    if not out["hash_match"] and out["columns_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ss = sorted(tuple(str(_norm(r[i])) for i in order_s) for r in s_rows)
        dd = sorted(tuple(str(_norm(r[i])) for i in order_d) for r in d_rows)
        diff = [(a, b) for a, b in zip(ss, dd) if a != b][:3]
        out["first_diffs"] = diff
        out["sorted_cols"] = sorted(s_cols)
    return out
