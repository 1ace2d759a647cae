"""Run a registered Spark query and its DuckDB oracle; compare the results.

Comparison is order-insensitive, by column name, with exact values (floats
are compared exactly too: both engines perform the same IEEE operations).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{sf_dir}/{v}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("f", v)
    if isinstance(v, int):
        return ("f", float(v)) if abs(v) < 2**53 else ("i", v)
    if isinstance(v, decimal.Decimal):
        return ("f", float(v)) if v == v.to_integral_value() else ("d", v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return ("t", v.isoformat())
    return ("s", str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, spark_fn, sql: str, sf_dir: str, con=None) -> dict:
    df = spark_fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": s_cols,
        "oracle_cols": d_cols,
    }
    out["values_match"] = out["columns_match"] and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    if out["columns_match"] and not out["values_match"]:
        a, b = set(_rows(s_cols, s_rows)), set(_rows(d_cols, d_rows))
        out["only_spark"] = sorted(a - b)[:3]
        out["only_oracle"] = sorted(b - a)[:3]
    out["ok"] = out["values_match"] and len(s_rows) == len(d_rows)
    return out
