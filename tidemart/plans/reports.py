"""Operational reports over any landing store."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.exprs import readable_quantity
from tidemart.operators.cdc import latest_version
from tidemart.plans.landing import Landing
from tidemart.session import child_names
from tidemart.sources.schemas import IS_DELETED, LANDING, SYNCED_AT, VERSION, ts_lit


def row_counts(L: Landing, tables: Iterable[str] | None = None) -> DataFrame:
    """Per landing table, all stored rows, keys and live keys, plus the
    row count in readable form.

    Stored rows come from a plain scan aggregate; keys and live keys from the
    newest version per key, whose partial limit drops older versions before
    the shuffle. The two one-row results are summed (a union, not a join)."""
    parts = []
    zero = F.lit(0).cast("long")
    for name in tables or LANDING:
        t = LANDING[name]
        raw = L.raw(name)
        stored = raw.agg(F.count(F.lit(1)).alias("raw_rows")).select("raw_rows", zero.alias("keys"),
                                                                   zero.alias("live_rows"))
        latest = latest_version(raw, t.sort_key).agg(
            F.count(F.lit(1)).alias("keys"), F.count_if(F.col(IS_DELETED) == 0).alias("live_rows"))
        parts.append(stored.unionByName(latest.select(zero.alias("raw_rows"), "keys", "live_rows"))
                     .agg(F.sum("raw_rows").alias("raw_rows"), F.sum("keys").alias("keys"),
                          F.sum("live_rows").alias("live_rows"))
                     .withColumn("table_name", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "raw_rows", "keys", "live_rows",
                      readable_quantity(F.col("raw_rows")).alias("raw_rows_readable"))


def mart_row_counts(spark: SparkSession, root: str, names: Iterable[str]) -> DataFrame:
    """R6 for mart tables: stored rows per table, plain and in readable form; both NULL for a table that is not there.

    The counts read no column, so files are opened for their footers only."""
    out = None
    for name in names:
        path = f"{root.rstrip('/')}/{name}"
        found = any(n.startswith("month=") for n in child_names(spark, path))
        rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")) if found else spark.range(1).select(
            F.lit(None).cast("long").alias("n_rows"))
        part = rows.select(F.lit(name).alias("mart"), "n_rows", readable_quantity(F.col("n_rows")).alias("n_rows_readable"))
        out = part if out is None else out.unionByName(part)
    return out


def cdc_lag(log: DataFrame, applied: Column, as_of: _dt.datetime, table: str) -> DataFrame:
    """How far the applied part of a change log trails the whole log.

    ``applied`` marks the rows already landed/merged (e.g. arrival batch below
    the committed one). Version lag is a plain difference of log positions;
    freshness is ``as_of`` minus the newest applied arrival time. One global
    aggregate (partial per task, one row out)."""
    g = log.agg(
        F.max(VERSION).alias("log_version"),
        F.max(F.when(applied, F.col(VERSION))).alias("applied_version"),
        F.count_if(~applied).alias("pending_rows"),
        F.count_distinct(F.when(~applied, F.col("id"))).alias("pending_keys"),
        F.max(F.when(applied, F.col(SYNCED_AT))).alias("applied_synced_at"),
        F.max(SYNCED_AT).alias("log_synced_at"))
    return g.select(
        F.lit(table).alias("table_name"), "log_version", "applied_version",
        (F.col("log_version") - F.col("applied_version")).alias("version_lag"),
        "pending_rows", "pending_keys",
        (F.unix_seconds(ts_lit(as_of)) - F.unix_seconds("applied_synced_at"))
        .alias("freshness_secs"),
        (F.unix_seconds("log_synced_at") - F.unix_seconds("applied_synced_at")).alias("lag_secs"))


def freshness(L: Landing, as_of: _dt.datetime, tables: Iterable[str] | None = None) -> DataFrame:
    """Per landing table: newest arrival time, newest version and the age of
    the newest arrival at ``as_of`` (the monitor's freshness view)."""
    parts = []
    for name in tables or LANDING:
        parts.append(L.raw(name).agg(F.max(SYNCED_AT).alias("last_synced_at"),
                                     F.max(VERSION).alias("last_version"))
                     .withColumn("table_name", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "last_synced_at", "last_version",
                      (F.unix_seconds(ts_lit(as_of)) - F.unix_seconds("last_synced_at"))
                      .alias("age_secs"))
