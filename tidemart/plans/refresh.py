"""Mart refresh into month-partitioned Parquet tables.

Table layout: ``<root>/<mart>/month=YYYYMM/part-*.parquet``, typed per the mart
DDL (Decimal(18,4), DATE) plus ``_etl_loaded_at``.

Modes:

* ``replace_window`` (default): every month the 90-day window touches is
  rewritten as (rows before the window start) + (new result). Keys that
  vanished from the window disappear; reruns are idempotent.
* ``literal``: the reference's scheme — drop the month of ``as_of``, append the
  whole window. Older months then hold several loads of a key;
  ``mart_latest`` resolves them by ``_etl_loaded_at``.

Snapshots (``snapshot_*``): ``replace_window`` replaces only rows of
``snapshot_date = as_of`` (one snapshot per day is kept); ``literal`` drops the
whole month first, as the reference does.

Each refresh first writes its result to a staging folder below the shared
checkpoint folder: that cuts the lineage (an executor lost afterwards does not
recompute the mart) and lets the replacement read a stable input.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.exprs import yyyymm
from tidemart.operators.cdc import latest_version
from tidemart.plans import marts as M
from tidemart.plans.landing import Landing, SharedReadings
from tidemart.session import child_names, delete_path, scratch_path
from tidemart.sources.schemas import MART_DATE_COL, MART_KEYS, ts_lit

LOADED_AT = "_etl_loaded_at"
AGG_GROUP = [n for n in M.MARTS if n.startswith("agg_")]
SNAPSHOT_GROUP = [n for n in M.MARTS if n.startswith("snapshot_")]
# Columns that are NULL only if their value does not fit the published type.
_NEVER_NULL = {
    "agg_daily_buyer": ["po_count", "total_spend", "approved_spend", "rfq_awarded_count", "quote_received",
                        "invoice_paid", "invoice_overdue"],
    "agg_daily_seller": ["quotes_submitted", "quotes_won", "revenue", "po_fulfilled"],
    "agg_daily_supplier_spend": ["po_count", "total_spend", "invoice_overdue_amt"],
    "agg_daily_category_spend": ["total_spend"],
    "agg_daily_revenue_territory": ["revenue"],
    "agg_daily_rfq_pipeline": ["pipeline_value"],
    "snapshot_org_daily": ["open_po_count", "open_po_value", "open_rfq_count", "pending_invoices",
                           "pending_invoice_amt", "inventory_value"],
}
GROUPS = {"agg": AGG_GROUP, "snapshot": SNAPSHOT_GROUP, "all": AGG_GROUP + SNAPSHOT_GROUP}


class RefreshFailed(RuntimeError):
    """Marts of a pass failed; the others have been refreshed."""


def _months_between(a: _dt.date, b: _dt.date) -> list[int]:
    out, y, m = [], a.year, a.month
    while (y, m) <= (b.year, b.month):
        out.append(y * 100 + m)
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def _stored_months(spark: SparkSession, path: str) -> list[int]:
    """Months of a mart table, from its partition folders."""
    return [int(n.removeprefix("month=")) for n in child_names(spark, path) if n.startswith("month=")]


def mart_result(L: Landing, name: str, as_of: _dt.date, loaded_at: _dt.datetime | None = None,
                semantics: str = "literal") -> DataFrame:
    from tidemart import mart
    df = mart(L, name, as_of, semantics=semantics)
    ts = ts_lit(loaded_at) if loaded_at else F.current_timestamp()
    return df.withColumn(LOADED_AT, ts).withColumn("month", yyyymm(MART_DATE_COL[name]))


def replace_months(spark: SparkSession, path: str, merged: DataFrame, affected: list[int]) -> None:
    """Replace the stored months ``affected`` by the rows of ``merged`` (which may be read from them)."""
    schema = merged.schema
    # stage the merged months, so the overwrite does not read what it replaces
    staged = scratch_path(spark, "staging", f"months-{uuid.uuid4().hex}")
    merged.write.mode("overwrite").partitionBy("month").parquet(staged)
    present = set(_stored_months(spark, staged))
    if present:
        (spark.read.schema(schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("month").parquet(path))
    empty_schema = T.StructType([f for f in schema.fields if f.name != "month"])
    for m in affected:
        if m not in present:
            spark.createDataFrame([], empty_schema).write.mode("overwrite").parquet(f"{path}/month={m}")
    delete_path(spark, staged)


def refresh_mart(spark: SparkSession, L: Landing, name: str, as_of: _dt.date, root: str,
                 mode: str = "replace_window", loaded_at: _dt.datetime | None = None,
                 semantics: str = "literal") -> tuple[int, int]:
    """Refresh one mart table; returns the number of new rows written, and how many
    of them hold a value that does not fit the published type (NULL there)."""
    path = f"{root.rstrip('/')}/{name}"
    date_col = MART_DATE_COL[name]
    staging = scratch_path(spark, "staging", f"{name}-{uuid.uuid4().hex}")
    result = mart_result(L, name, as_of, loaded_at, semantics)
    schema = result.schema
    result.write.mode("overwrite").partitionBy("month").parquet(staging)
    new = spark.read.schema(schema).parquet(staging)
    new_months = sorted(r["month"] for r in new.select("month").distinct().collect())
    n_rows = new.count()
    is_snapshot = name.startswith("snapshot_")
    this_month = as_of.year * 100 + as_of.month

    survive: Column | None
    if mode == "literal":
        affected = [this_month]            # reference: drop the current month only
        survive = None
        if not is_snapshot:
            # other months keep their old rows; the new ones are appended
            affected = sorted(set(affected) | set(new_months))
            survive = F.col("month") != F.lit(this_month)
    elif is_snapshot:
        affected = sorted({this_month, *new_months})
        survive = F.col(date_col) != F.lit(as_of)
    else:
        start = as_of - _dt.timedelta(days=M.WINDOW_DAYS)
        # the window has no upper bound: a later month that is stored is replaced
        # too, else rows of a since deleted future-dated order would stay
        later = [m for m in _stored_months(spark, path) if m >= start.year * 100 + start.month]
        affected = sorted({*_months_between(start, as_of), *new_months, *later})
        survive = F.col(date_col) < F.lit(start)

    if _stored_months(spark, path) and survive is not None:
        old = spark.read.schema(schema).parquet(path).filter(F.col("month").isin(affected)).filter(survive)
        merged = old.unionByName(new.filter(F.col("month").isin(affected)))
    else:
        merged = new.filter(F.col("month").isin(affected))
    replace_months(spark, path, merged, affected)
    never = _NEVER_NULL.get(name)
    unfit = new.filter(" OR ".join(f"{c} IS NULL" for c in never)).count() if never else 0
    delete_path(spark, staging)
    return n_rows, unfit


def read_mart(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def mart_latest(df: DataFrame, name: str) -> DataFrame:
    """R2: one row per mart key, the one with the latest ``_etl_loaded_at``."""
    return latest_version(df, MART_KEYS[name], version_col=LOADED_AT)


def run(spark: SparkSession, L: Landing, root: str, as_of: _dt.date, group: str = "all",
        as_of_events: _dt.date | None = None, mode: str = "replace_window",
        semantics: str = "literal", parallel: int = 1) -> DataFrame:
    """R3 + R4: refresh a group of marts in one pass; a failing mart does not
    stop the others. The marts share their deduplicated inputs (fact_po is
    read by six of them). ``parallel`` marts are refreshed at a time, each in a scheduler pool of
    its own name (which shares the cluster evenly if the session runs with
    ``spark.scheduler.mode=FAIR``). Returns one status row per mart; a failed one has no
    row count. Who goes on to read the marts passes the status to ``all_refreshed`` first: the table of a
    failed mart is missing or as an earlier pass left it.

    ``L`` may be the ``SharedReadings`` of several passes over one state of the landing tables; the
    caller releases them."""
    shared = L if isinstance(L, SharedReadings) else SharedReadings(L)

    def one(name: str) -> tuple:
        t0 = time.time()
        day = as_of_events if (name == "agg_daily_engagement" and as_of_events) else as_of
        if parallel > 1:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            n, unfit = refresh_mart(spark, shared, name, day, root, mode=mode, semantics=semantics)
            note = f"{unfit} groups hold a value beyond the published type (NULL)" if unfit else ""
            return name, "ok", n, round(time.time() - t0, 3), note
        except Exception as exc:  # noqa: BLE001 - isolation is the point
            return name, "failed", None, round(time.time() - t0, 3), str(exc)
    try:
        if parallel > 1:
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                rows = list(pool.map(inheritable_thread_target(spark)(one), GROUPS[group]))
        else:
            rows = [one(name) for name in GROUPS[group]]
    finally:
        if shared is not L:
            shared.release()
    return spark.createDataFrame(rows, "mart string, status string, rows long, seconds double, error string")


def all_refreshed(status: DataFrame) -> None:
    """Raises if a mart of the pass failed."""
    bad = [r for r in status.collect() if r["status"] != "ok"]  # a row per mart
    if bad:
        raise RefreshFailed("; ".join(f"{r['mart']}: {r['error']}" for r in bad))


def refresh_status(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    """Last refresh time and row count per mart table, read from the tables
    themselves (not from process memory)."""
    parts = []
    for name in names or GROUPS["all"]:
        path = f"{root.rstrip('/')}/{name}"
        if not _stored_months(spark, path):
            continue
        parts.append(read_mart(spark, root, name).agg(
            F.max(LOADED_AT).alias("last_refresh"), F.count(F.lit(1)).alias("rows"))
            .withColumn("mart", F.lit(name)))
    if not parts:
        return spark.createDataFrame([], "mart string, last_refresh timestamp, rows long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("mart", "last_refresh", "rows")
