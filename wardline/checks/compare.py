"""Cross-engine check: a registered Spark query against its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, and equal
multisets of rows after rounding doubles.
"""

from __future__ import annotations

import math
import os

import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df: pd.DataFrame, cols):
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare_frames(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> dict:
    res = {"spark_rows": len(spark_pdf), "oracle_rows": len(oracle_pdf)}
    sc, oc = sorted(spark_pdf.columns), sorted(oracle_pdf.columns)
    res["columns_match"] = sc == oc
    if sc != oc:
        res["only_spark"] = sorted(set(sc) - set(oc))
        res["only_oracle"] = sorted(set(oc) - set(sc))
        res["ok"] = False
        return res
    a, b = _rows(spark_pdf, sc), _rows(oracle_pdf, sc)
    res["values_match"] = a == b
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["first_diffs"] = [(dict(zip(sc, x)), dict(zip(sc, y))) for x, y in diff]
    res["ok"] = res["columns_match"] and res["values_match"] and len(a) == len(b)
    return res


def check(spark, name: str, sf_dir: str, queries: dict, sqls: dict, con=None) -> dict:
    con = con or duckdb_connection(sf_dir)
    sp = queries[name](spark, sf_dir).toPandas()
    if name not in sqls:
        return {"ok": True, "rows_only": True, "spark_rows": len(sp)}
    orc = con.execute(sqls[name]).df()
    return compare_frames(sp, orc)
