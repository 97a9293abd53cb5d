"""Mergeable state of the engagement mart (A8, A9): one small row per day and organisation.

The exact mart (M7) counts distinct users from the rows, so a month or a year of it reads every event again.
Here each (day, organisation) keeps two HLL sketches (users, sessions), a frequent-item sketch (event types)
and plain sums. Sketches of different days merge, so any span of days is answered from the state, and a
refresh rewrites only the days it is given. State is computed from the live rows of a day, not from changes:
a deletion or a correction cannot be taken out of a sketch, so its day is computed again.

Errors: distinct counts of up to about 1,500 values are exact at ``LG_K`` = 14 (the sketch holds the hashes themselves), above that
the relative standard error is about 0.8 %. A count of the frequent-item sketch is too high by at most 3.5 / ``ITEMS`` of the
group's rows, and exact while the group has fewer than 0.75 * ``ITEMS`` different values. The exact mart stays the default.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.exprs import day
from tidemart.plans.landing import Landing
from tidemart.session import child_names, delete_path, path_exists

LG_K, ITEMS = 14, 1024
TOP_CANDIDATES = 100  # values of the highest count that are compared for the smallest one
GRAIN = ("metric_date", "org_id")
DAY = "metric_date"


def engagement_state(events: DataFrame) -> DataFrame:
    """Live events -> a row per (day, organisation): sketches and sums. Partial aggregation keeps one
    sketch per group and task, so a hot organisation moves sketches, not rows."""
    return events.groupBy(day("event_ts").alias(DAY), "org_id").agg(
        F.hll_sketch_agg("user_id", LG_K).alias("users"),
        F.hll_sketch_agg("session_id", LG_K).alias("sessions"),
        F.expr(f"approx_top_k_accumulate(event_type, {ITEMS})").alias("types"),
        F.sum("duration_secs").alias("duration"), F.count(F.lit(1)).alias("events"))


def merge_state(state: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """State rows of the same group into one."""
    return state.groupBy(*by).agg(
        F.hll_union_agg("users").alias("users"), F.hll_union_agg("sessions").alias("sessions"),
        F.expr(f"approx_top_k_combine(types, {ITEMS})").alias("types"),
        F.sum("duration").alias("duration"), F.sum("events").alias("events"))


def top_type(types: str = "types") -> Column:
    """The most frequent value of a frequent-item state; of equal counts the smallest, as in the exact mode
    (with more than ``TOP_CANDIDATES`` values of one count, the smallest of those)."""
    top = F.expr(f"approx_top_k_estimate({types}, {TOP_CANDIDATES})")
    best = F.array_max(F.transform(top, lambda x: x["count"]))
    return F.array_min(F.transform(F.filter(top, lambda x: x["count"] == best), lambda x: x["item"]))


def from_state(state: DataFrame) -> DataFrame:
    """The mart's columns from state rows of any grain."""
    keys = [c for c in state.columns if c not in ("users", "sessions", "types", "duration", "events")]
    return state.select(
        *keys, F.hll_sketch_estimate("users").alias("active_users"), F.hll_sketch_estimate("sessions").alias("sessions"),
        (F.col("duration").cast("double") / F.col("events")).alias("avg_session_secs"),
        F.col("events").alias("page_views"), top_type().alias("top_event_type"))


# --- the stored state -----------------------------------------------------------------------

def changed_days(changes: DataFrame) -> list[_dt.date]:
    """Days that change rows (of old and new images) touch: the dates to give to ``refresh_state``."""
    return sorted(r[0] for r in changes.select(day("event_ts")).distinct().collect())


def refresh_state(spark: SparkSession, L: Landing, root: str, days: Iterable[_dt.date] | None = None) -> None:
    """Compute the state of ``days`` (None: of all) from the live rows and replace these days' partitions.

    A day that has no live rows any more loses its partition; other days keep their files. One row per
    organisation and day is written, so a day is one task per ``rebalance`` of its size."""
    root, events = root.rstrip("/"), L.live("fact_engagement_raw")
    if days is not None:
        days = list(days)
        events = events.filter(day("event_ts").isin(days)) if days else events.filter(F.lit(False))
    state = engagement_state(events).hint("rebalance", DAY)
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if days is not None else "static").partitionBy(DAY).parquet(root)
    for d in days or ():
        path = f"{root}/{DAY}={d:%Y-%m-%d}"
        if path_exists(spark, path) and not events.filter(day("event_ts") == F.lit(d)).limit(1).count():
            delete_path(spark, path)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """Stored state rows; filters on ``metric_date`` open only those days."""
    root = root.rstrip("/")
    if not any(n.startswith(f"{DAY}=") for n in child_names(spark, root)):
        raise FileNotFoundError(f"no state below {root}")
    return spark.read.parquet(root)


def engagement_by_month(state: DataFrame) -> DataFrame:
    """Users, sessions and top event type per month and organisation, from day sketches only."""
    return from_state(merge_state(state, [F.date_format(DAY, "yyyy-MM").alias("month"), "org_id"]))
