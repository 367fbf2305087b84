"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's check)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

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
        return round(v, int(os.environ.get("QUARRY_ORACLE_DIGITS", "6"))) if os.environ.get("QUARRY_ORACLE_DIGITS", "6") != "exact" else v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row counts differ: {len(s)} vs {len(o)}"
    st = {c: str(s[c].dtype) for c in s.columns}
    ot = {c: str(o[c].dtype) for c in o.columns}
    if len(s) and st != ot:
        diff = {c: (st[c], ot[c]) for c in st if st[c] != ot[c]}
        return False, f"column types differ (spark, oracle): {diff}"
    rs, ro = rows_of(s), rows_of(o)
    for a, b in zip(rs, ro):
        if a != b:
            return False, f"first differing row: {a} vs {b}"
    return True, f"{len(s)} rows equal"
