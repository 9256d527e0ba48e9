"""Spark-vs-DuckDB comparison: row count, column names, order-free value hash."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6f}"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, key: str, fn, sql: str, sf_dir: str) -> dict:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {
        "key": key,
        "rows": (len(s_rows), len(o_rows)),
        "cols_match": sorted(s_cols) == sorted(o_cols),
        "hash_match": digest(s_cols, s_rows) == digest(o_cols, o_rows),
    }
    out["ok"] = out["rows"][0] == out["rows"][1] and out["cols_match"] and out["hash_match"]
    if not out["ok"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
        s_set = {tuple(_norm(r[s_cols.index(c)]) for c in sorted(s_cols)) for r in s_rows} if out["cols_match"] else set()
        o_set = {tuple(_norm(r[o_cols.index(c)]) for c in sorted(o_cols)) for r in o_rows} if out["cols_match"] else set()
        out["only_spark"] = sorted(s_set - o_set)[:3]
        out["only_oracle"] = sorted(o_set - s_set)[:3]
    return out
