"""Local stand-in for the driver's correctness gate: run a registered query in
Spark and its oracle SQL in DuckDB on the same parquet tables, and compare
row count, column names and order-insensitive values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


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
        return float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def compare(spark_df, con, sql: str) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    d = d.astype(object).where(pd.notna(d), None)
    s = s.astype(object).where(pd.notna(s), None)
    res = {"rows_spark": len(s), "rows_oracle": len(d),
           "cols_equal": sorted(s.columns) == sorted(d.columns)}
    if not res["cols_equal"]:
        res["cols_spark"] = sorted(s.columns)
        res["cols_oracle"] = sorted(d.columns)
        res["match"] = False
        return res
    rs, rd = _rows(s), _rows(d)
    res["match"] = rs == rd
    if not res["match"]:
        diff = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        res["first_diffs"] = diff
    return res
