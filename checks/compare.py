"""Run a registered query in Spark and its oracle SQL in DuckDB, and compare
row count, column names/kinds and order-insensitive values."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind_spark(t: str) -> str:
    t = t.lower()
    if t in ("bigint", "int", "smallint", "tinyint", "long", "integer"):
        return "int"
    if t in ("double", "float") or t.startswith("decimal"):
        return "float"
    if t.startswith("timestamp"):
        return t
    if t == "boolean":
        return "bool"
    return "str"


def _kind_duck(t: str) -> str:
    t = t.upper()
    if t in ("BIGINT", "INTEGER", "SMALLINT", "TINYINT", "HUGEINT", "UBIGINT", "UINTEGER"):
        return "int"
    if t in ("DOUBLE", "FLOAT") or t.startswith("DECIMAL"):
        return "float"
    if t == "TIMESTAMP":
        return "timestamp_ntz"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "BOOLEAN":
        return "bool"
    return "str"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_kinds = {f.name: _kind_spark(f.dataType.simpleString()) for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_kinds = {c: _kind_duck(str(t)) for c, t in zip(d_cols, rel.types)}
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    res["kinds_match"] = res["columns_match"] and all(s_kinds[c] == d_kinds[c] for c in s_cols)
    if not res["kinds_match"]:
        res["kinds"] = {"spark": s_kinds, "oracle": d_kinds}
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["values_match"] = res["columns_match"] and a == b
    if not res["values_match"] and res["columns_match"]:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["only_spark"], res["only_oracle"] = diff_a, diff_b
    res["ok"] = res["values_match"] and res["kinds_match"] and len(s_rows) == len(d_rows)
    return res
