"""Test helper: run a Spark DataFrame and a DuckDB SQL string on the same
input folder and compare them as unordered row multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pandas as pd

INPUT_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in INPUT_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, con, sql: str, check_dtypes: bool = True) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.sql(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
    kinds = {c: (s[c].dtype.kind, d[c].dtype.kind) for c in s.columns}
    bad = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if bad and check_dtypes:
        return False, f"column dtype kinds differ (spark, oracle): {bad}"
    if len(s) != len(d):
        return False, f"row counts differ: spark {len(s)} vs oracle {len(d)}"
    rs, rd = rows(s), rows(d)
    for i, (a, b) in enumerate(zip(rs, rd)):
        if a != b:
            return False, f"first differing row #{i}:\n spark  {a}\n oracle {b}"
    return True, f"{len(rs)} rows equal"
