"""Stored sketches against the exact mart: days, merged spans, refresh of changed days, stated error."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from mart_helpers import make_landing
from tidemart.plans import sketches as K
from tidemart.session import child_names


def _event(i, day, user, kind="view", org=1, version=1, deleted=0):
    return {"id": i, "org_id": org, "user_id": user, "event_type": kind, "session_id": f"s{user}", "duration_secs": i % 7,
            "event_ts": f"2024-01-{day:02d} 12:00:00", "_cdc_version": version, "_cdc_is_deleted": deleted}


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_refresh_replaces_only_the_given_days(spark):
    root = tempfile.mkdtemp(prefix="sketch-", dir="/tmp") + "/state"
    first = [_event(i, 1 + i % 3, i % 5, "view" if i % 2 else "buy", org=i % 2) for i in range(40)]
    K.refresh_state(spark, make_landing(spark, {"fact_engagement_raw": first}), root)
    kept = child_names(spark, f"{root}/metric_date=2024-01-03")
    # day 1 loses rows and gets others, day 2 loses all, day 4 is new
    change = ([_event(i, 1, i % 5, org=i % 2, version=2, deleted=1) for i in range(0, 21, 3)] + [_event(100, 1, 77), _event(101, 4, 8)]
              + [_event(i, 2, i % 5, org=i % 2, version=2, deleted=1) for i in range(1, 40, 3)])
    L = make_landing(spark, {"fact_engagement_raw": first + change})
    days = K.changed_days(make_landing(spark, {"fact_engagement_raw": change}).raw("fact_engagement_raw"))
    assert days == [dt.date(2024, 1, d) for d in (1, 2, 4)]
    K.refresh_state(spark, L, root, days)
    again = tempfile.mkdtemp(prefix="sketch-", dir="/tmp") + "/state"
    K.refresh_state(spark, L, again)
    got = K.from_state(K.read_state(spark, root))
    assert _rows(got) == _rows(K.from_state(K.read_state(spark, again)))
    assert child_names(spark, f"{root}/metric_date=2024-01-03") == kept  # same files
    assert "metric_date=2024-01-02" not in child_names(spark, root)
    K.refresh_state(spark, L, root, [])
    assert _rows(K.from_state(K.read_state(spark, root))) == _rows(got)


def test_merged_days_within_the_stated_error(spark):
    # 40 days, 60,000 rows of one organisation, about 20,000 users: beyond the exact range of the sketch
    e = spark.range(60_000).select(
        F.lit(1).cast("long").alias("org_id"), (F.xxhash64("id") % 15_000).alias("user_id"), F.lit("s").alias("session_id"),
        F.expr("CASE WHEN id % 3 = 0 THEN 'buy' WHEN id % 3 = 1 THEN 'view' ELSE concat('rare', id % 5000) END").alias("event_type"),
        F.col("id").alias("duration_secs"), F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(id % 40 as int))").alias("event_ts"))
    state = K.engagement_state(e)
    assert state.count() == 40
    got = K.from_state(K.merge_state(state, ["org_id"])).first()
    exact = e.agg(F.count_distinct("user_id")).first()[0]
    assert exact > 20_000 and abs(got["active_users"] - exact) <= 4 * 0.008 * exact
    assert got["sessions"] == 1 and got["page_views"] == 60_000 and got["avg_session_secs"] == 59_999 / 2
    # both leaders have 20,000 rows, the sketch may add 3.5 / 1,024 of the rows to either
    top = {r["item"]: r["count"] for r in K.merge_state(state, ["org_id"]).select(
        F.explode(F.expr("approx_top_k_estimate(types, 2)")).alias("x")).select("x.*").collect()}
    assert set(top) == {"buy", "view"} and all(20_000 <= n <= 20_000 + 60_000 * 3.5 / K.ITEMS for n in top.values())


def test_ties_nulls_and_no_rows(spark):
    e = spark.createDataFrame([(1, 5, "b", "s", 1), (1, 6, "a", "s", 3), (2, None, None, None, None)],
                              "org_id long, user_id long, event_type string, session_id string, duration_secs long").withColumn(
                                  "event_ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    got = {r["org_id"]: (r["active_users"], r["sessions"], r["avg_session_secs"], r["page_views"], r["top_event_type"])
           for r in K.from_state(K.engagement_state(e)).collect()}
    assert got == {1: (2, 1, 2.0, 2, "a"), 2: (0, 0, None, 1, None)}
    assert K.engagement_by_month(K.engagement_state(e.limit(0))).count() == 0
