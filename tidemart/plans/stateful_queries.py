"""Registered queries of jobs that write tables: refresh, streaming, compaction.

Each call works in a new folder below the shared checkpoint folder, over data that
Spark derives from the input tables, and returns what it has written.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.cdc import compact, latest_live
from tidemart.plans import cdc_queries as C
from tidemart.plans import refresh as R
from tidemart.plans import sketches as K
from tidemart.plans.landing import Landing, SharedReadings
from tidemart.plans.marts import MARTS, window_start
from tidemart.plans.oracle_fixtures import latest_sql, with_fixtures
from tidemart.plans.oracle_sql import MART_SQL
from tidemart.plans.reports import mart_row_counts
from tidemart.plans.store import LandingStore, land_batches, refresh_from_store
from tidemart.session import scratch_path
from tidemart.sources.changelog import BATCHES, po_change_log
from tidemart.sources.copy import snapshot_by_depth, truncate_and_load, write_within
from tidemart.sources.position import POSITION, append_segment, position_feed, segments
from tidemart.sources.schemas import IS_DELETED, LANDING
from tidemart.streaming.apply import (
    change_feed, land_changes, read_landed, read_rejected, read_state, to_envelope, upsert_changes,
)
from tidemart.streaming.routing import landed_progress, log_end, route_changes, routed_landing, stream_lag
from tidemart.streaming.state import upsert_stream

AS_OF = _dt.date(2001, 8, 1)
DAY_BEFORE = _dt.date(2001, 7, 31)
AS_OF_EVENTS = _dt.date(2024, 1, 30)  # as in registry.py
TERRITORY, ORG = "agg_daily_revenue_territory", "snapshot_org_daily"
PO = LANDING["fact_po_raw"]


def _work(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "queries", f"{name}-{uuid.uuid4().hex}")


def _portable(df: DataFrame) -> DataFrame:
    from tidemart.plans.registry import portable
    return portable(df)


def _stored(df: DataFrame) -> DataFrame:
    return _portable(df.drop(R.LOADED_AT, "month"))


def refresh_twice_same(spark, sf_dir):
    """A mart table after two refreshes of the same day."""
    root, L = _work(spark, "refresh"), Landing.materialized(spark, sf_dir)
    for _ in range(2):
        R.refresh_mart(spark, L, TERRITORY, AS_OF, root)
    return _stored(R.read_mart(spark, root, TERRITORY))


def mart_latest(spark, sf_dir):
    """R2: two loads by the drop-current-month scheme leave older months twice; one row per key."""
    root, L = _work(spark, "latest"), Landing.materialized(spark, sf_dir)
    for hour in (1, 2):
        R.refresh_mart(spark, L, TERRITORY, AS_OF, root, mode="literal", loaded_at=_dt.datetime(2001, 8, 1, hour))
    return _stored(R.mart_latest(R.read_mart(spark, root, TERRITORY), TERRITORY))


def report_refresh_status(spark, sf_dir):
    """Rows per refreshed mart table (its load time is the run's)."""
    root, L = _work(spark, "status"), Landing.materialized(spark, sf_dir)
    for name in (TERRITORY, ORG):
        R.refresh_mart(spark, L, name, AS_OF, root)
    return R.refresh_status(spark, root).select("mart", F.col("rows").alias("n_rows"),
                                                F.col("last_refresh").isNotNull().cast("int").alias("refreshed"))


def refresh_group_run(spark, sf_dir):
    """One pass over the agg group, four marts at a time; the engagement feed cannot be read,
    which fails its mart and no other (a failure of another kind is raised). Rows are those of the tables."""
    root, L, unreadable = _work(spark, "group"), Landing.materialized(spark, sf_dir), "feed not readable"

    def raw(table: str) -> DataFrame:
        if table == "fact_engagement_raw":
            raise RuntimeError(unreadable)
        return L.raw(table)
    status = R.run(spark, Landing(raw), root, AS_OF, group="agg", as_of_events=AS_OF_EVENTS, parallel=4)
    R.all_refreshed(status.filter(F.col("error") != unreadable))
    return status.select("mart", "status").join(mart_row_counts(spark, root, R.AGG_GROUP), "mart")


def report_mart_row_counts(spark, sf_dir):
    """Rows of the snapshot tables after two days' passes of their group; a mart that failed is an error, not a count."""
    root, L = _work(spark, "counts"), SharedReadings(Landing.materialized(spark, sf_dir))
    try:
        for day in (DAY_BEFORE, AS_OF):
            R.all_refreshed(R.run(spark, L, root, day, group="snapshot"))
    finally:
        L.release()
    return mart_row_counts(spark, root, R.SNAPSHOT_GROUP)


def seed_truncate_and_load(spark, sf_dir):
    """A table loaded with the whole change log, then with the latest live POs: only the second load is left."""
    path, log = f"{_work(spark, 'load')}/po", po_change_log(Landing.materialized(spark, sf_dir).raw("fact_po_raw"))
    for rows in (log, latest_live(log, PO.sort_key)):
        truncate_and_load(rows, path)
    return _portable(spark.read.parquet(path))


def snapshot_two_days(spark, sf_dir):
    """The snapshots of two days stand side by side; the second day's is loaded twice."""
    root, L = _work(spark, "days"), Landing.materialized(spark, sf_dir)
    for day in (DAY_BEFORE, AS_OF, AS_OF):
        R.refresh_mart(spark, L, ORG, day, root)
    return _stored(R.read_mart(spark, root, ORG))


def stream_two_feeds_landed(spark, sf_dir):
    """Two feeds with their own checkpoints into one root, read as latest live POs."""
    work, L = _work(spark, "feeds"), Landing.materialized(spark, sf_dir)
    log = po_change_log(L.raw("fact_po_raw"))
    for feed, mine in (("even", F.col("id") % 2 == 0), ("odd", F.col("id") % 2 == 1)):
        to_envelope(log.filter(mine), "fact_po_raw").write.parquet(f"{work}/feeds/{feed}")
        land_changes(change_feed(spark, f"{work}/feeds/{feed}"), f"{work}/landing", f"{work}/checkpoints/{feed}",
                     ["fact_po_raw", "fact_rfq_raw"], name=feed).awaitTermination()
    landed = read_landed(spark, f"{work}/landing", "fact_po_raw").drop("month")
    return _portable(latest_live(landed, PO.sort_key))


def stream_rejects(spark, sf_dir):
    """Malformed payloads (every PO with id % 50 = 0) and records of a table that is not
    listed are kept aside and counted; the rest is landed."""
    work, L = _work(spark, "rejects"), Landing.materialized(spark, sf_dir)
    bad = F.when(F.col("_id") % 50 == 0, F.concat(F.lit("{\"id\":"), F.col("payload")))
    po = L.raw("fact_po_raw")
    good = to_envelope(po, "fact_po_raw").withColumn("_id", F.get_json_object("payload", "$.id").cast("long"))
    good = good.withColumn("payload", F.coalesce(bad, "payload")).drop("_id")
    good.unionByName(to_envelope(L.raw("fact_rfq_raw"), "fact_rfq_raw")).write.parquet(f"{work}/feed")
    land_changes(change_feed(spark, f"{work}/feed"), f"{work}/landing", f"{work}/checkpoint", ["fact_po_raw"],
                 name="rejects", max_malformed=0.05).awaitTermination()
    landed = read_landed(spark, f"{work}/landing", "fact_po_raw").select(
        F.lit("landed").alias("reason"), F.lit("fact_po_raw").alias("table_name"))
    return read_rejected(spark, f"{work}/landing").select("reason", F.col("_table").alias("table_name")).unionByName(
        landed).groupBy("reason", "table_name").agg(F.count(F.lit(1)).alias("records"))


def stream_upsert_state(spark, sf_dir):
    """Keyed upsert by version: the change log arrives in two runs, newest batches first."""
    work, L = _work(spark, "upsert"), Landing.materialized(spark, sf_dir)
    log = po_change_log(L.raw("fact_po_raw"), with_batch=True)
    for newest in (True, False):
        part = log.filter((F.col("_batch") >= 2) == newest).drop("_batch")
        to_envelope(part, "fact_po_raw").write.mode("append").parquet(f"{work}/feed")
        upsert_changes(change_feed(spark, f"{work}/feed"), f"{work}/state", "fact_po_raw",
                       f"{work}/checkpoint").awaitTermination()
    return _portable(read_state(spark, f"{work}/state", "fact_po_raw").select(*C.PO_COLS))


def stream_state_upsert(spark, sf_dir):
    """2.11 by the state store: the change log in two runs, newest batches first; the records that
    moved their key forward, as base plus tail."""
    work, L = _work(spark, "state"), Landing.materialized(spark, sf_dir)
    log, store = po_change_log(L.raw("fact_po_raw"), with_batch=True), LandingStore(spark, f"{work}/landing")
    for newest in (True, False):
        to_envelope(log.filter((F.col("_batch") >= 2) == newest).drop("_batch"), "fact_po_raw").write.mode("append").parquet(f"{work}/feed")
        upsert_stream(change_feed(spark, f"{work}/feed"), store, "fact_po_raw", f"{work}/checkpoint").awaitTermination()
    return _portable(store.landing().latest("fact_po_raw").select(*C.PO_COLS))


STREAM_LAG_SQL = with_fixtures(["fact_po_raw", "fact_rfq_raw", "fact_rfq_quote_raw"], """
SELECT table_name, count(*) AS log_records, count(*) FILTER (WHERE landed) AS landed_records,
       count(*) FILTER (WHERE NOT landed) AS pending_records, max(version) AS log_version, max(version) FILTER (WHERE landed) AS landed_version,
       max(version) - max(version) FILTER (WHERE landed) AS version_lag,
       CAST(epoch(max(synced)) - epoch(max(synced) FILTER (WHERE landed)) AS BIGINT) AS lag_secs
FROM (SELECT 'fact_po_raw' AS table_name, id % 3 > 0 AS landed, _cdc_version AS version, _cdc_synced_at AS synced FROM log
      UNION ALL SELECT 'fact_rfq_raw', id % 3 > 0, _cdc_version, _cdc_synced_at FROM fact_rfq_raw
      UNION ALL SELECT 'fact_rfq_quote_raw', id % 3 > 0, _cdc_version, _cdc_synced_at FROM fact_rfq_quote_raw)
GROUP BY 1""", C._log_ctes())
MONTHS_SQL = with_fixtures(["fact_engagement_raw"], """, w AS (
  SELECT strftime(event_ts, '%Y-%m') AS month, * FROM e),
top AS (SELECT month, org_id, event_type FROM (
  SELECT month, org_id, event_type, row_number() OVER (PARTITION BY month, org_id ORDER BY count(*) DESC, event_type) AS rk
  FROM w GROUP BY month, org_id, event_type) WHERE rk = 1)
SELECT w.month, w.org_id, count(DISTINCT user_id) AS active_users, count(DISTINCT session_id) AS sessions,
       avg(duration_secs) AS avg_session_secs, count(*) AS page_views, min(top.event_type) AS top_event_type
FROM w JOIN top ON top.month = w.month AND top.org_id = w.org_id GROUP BY w.month, w.org_id""".replace(", w AS", ",\nw AS", 1),
                           [("e", latest_sql("fact_engagement_raw"))])
ROUTED = ["fact_rfq_raw", "fact_rfq_quote_raw", "fact_po_raw"]


def _routed(spark, sf_dir, name: str) -> tuple[str, list]:
    """A work folder and two arrivals of the records of three tables, POs as their change log: first two ids of three, then every third."""
    L, parts = Landing.materialized(spark, sf_dir), []
    for mine in (F.col("id") % 3 > 0, F.col("id") % 3 == 0):
        rows = [(L.raw(t) if t != "fact_po_raw" else po_change_log(L.raw(t))).filter(mine) for t in ROUTED]
        envelopes = [to_envelope(r, t) for r, t in zip(rows, ROUTED)]
        parts.append(envelopes[0].unionByName(envelopes[1]).unionByName(envelopes[2]))
    return _work(spark, name), parts


def _route(spark, work: str, arrival: DataFrame) -> None:
    arrival.write.mode("append").parquet(f"{work}/feed")
    route_changes(change_feed(spark, f"{work}/feed"), f"{work}/landing", f"{work}/checkpoint", ROUTED).awaitTermination()


def stream_routed_tables(spark, sf_dir):
    """Three tables from one feed, each batch by one job; POs as the newest version per key."""
    work, arrivals = _routed(spark, sf_dir, "routed")
    for a in arrivals:
        _route(spark, work, a)
    return _portable(routed_landing(spark, f"{work}/landing").latest("fact_po_raw").select(*C.PO_COLS))


def stream_routed_mart(spark, sf_dir):
    """A mart over the tables that one feed has landed."""
    work, arrivals = _routed(spark, sf_dir, "routed-mart")
    for a in arrivals:
        _route(spark, work, a)
    return _portable(MARTS["agg_daily_rfq_pipeline"](routed_landing(spark, f"{work}/landing"), AS_OF))


def report_stream_lag(spark, sf_dir):
    """The first arrival has been landed, the second is in the log only."""
    work, arrivals = _routed(spark, sf_dir, "lag")
    _route(spark, work, arrivals[0])
    arrivals[1].write.mode("append").parquet(f"{work}/feed")
    return _portable(stream_lag(log_end(spark.read.parquet(f"{work}/feed")), landed_progress(spark, f"{work}/landing")))


def stream_by_position(spark, sf_dir):
    """The change log as segments by position, read in batches of about half of it with a restart after each."""
    work, L = _work(spark, "position"), Landing.materialized(spark, sf_dir)
    log = po_change_log(L.raw("fact_po_raw"), with_batch=True).withColumn("_copy", F.expr("unix_seconds(_cdc_synced_at) div 86400 % 2"))
    for batch in range(BATCHES):
        rows = log.filter(F.col("_batch") == batch)
        # within an arrival batch by id, version and replay: a number that grows and is unique
        place = ((F.lit(batch).cast("long") * 2 ** 40 + F.col("id")) * 4 + F.col("_cdc_version")) * 2 + F.col("_copy")
        append_segment(to_envelope(rows, "fact_po_raw", keep=[place.alias(POSITION)]), f"{work}/log")
    half = sum(n for _, _, n in segments(spark, f"{work}/log")) // 2
    for _ in range(BATCHES):
        feed = position_feed(spark, f"{work}/log", f"{work}/checkpoint", max_rows=half).drop(POSITION)
        land_changes(feed, f"{work}/landing", f"{work}/checkpoint", ["fact_po_raw"], name="position").awaitTermination()
    landed = read_landed(spark, f"{work}/landing", "fact_po_raw").drop("month")
    return _portable(latest_live(landed, PO.sort_key))


def snapshot_equi_depth(spark, sf_dir):
    """The PO table copied in eight key ranges of about equal row counts."""
    path = f"{_work(spark, 'depth')}/copy"
    snapshot_by_depth(Landing.materialized(spark, sf_dir).raw("fact_po_raw"), "id", 8).write.parquet(path)
    return _portable(spark.read.parquet(path).select(*C.PO_COLS))


def _engagement_state(spark, sf_dir, name: str) -> DataFrame:
    """Stored state of all events, first without the events of id % 3 = 0, then with the days of those computed again."""
    root, L = f"{_work(spark, name)}/state", Landing.materialized(spark, sf_dir)
    events = L.raw("fact_engagement_raw")
    K.refresh_state(spark, Landing(lambda _: events.filter("id % 3 != 0")), root)
    K.refresh_state(spark, L, root, K.changed_days(events.filter("id % 3 = 0")))
    return K.read_state(spark, root)


def engagement_from_sketches(spark, sf_dir):
    """The engagement mart of the window from stored sketches per day and organisation."""
    state = _engagement_state(spark, sf_dir, "sketches").filter(F.col(K.DAY) >= F.lit(window_start(AS_OF_EVENTS)))
    return _portable(K.from_state(state))


def engagement_months_from_sketches(spark, sf_dir):
    """Users, sessions and top event type per month, merged from the sketches of its days."""
    return _portable(K.engagement_by_month(_engagement_state(spark, sf_dir, "sketch-months")))


def result_within_limits(spark, sf_dir):
    """A mart written under limits that it keeps, in one execution."""
    path = f"{_work(spark, 'within')}/mart"
    write_within(MARTS[TERRITORY](Landing.materialized(spark, sf_dir), AS_OF), path)
    return _portable(spark.read.parquet(path))


def cdc_compact_drop(spark, sf_dir):
    """Physical deletion, a compaction that keeps no tombstones."""
    log = po_change_log(Landing.materialized(spark, sf_dir).raw("fact_po_raw"))
    return _portable(compact(log, PO.sort_key, keep_tombstones=False))


# --- base plus tail, refresh by changes ------------------------------------------------------

SPLIT_TABLES = ["fact_po_item_raw", "fact_rfq_raw", "fact_rfq_quote_raw", "fact_invoice_raw", "fact_delivery_raw",
                "fact_rating_raw", "fact_inventory_movement_raw"]


def _batches(L: Landing, table: str) -> list[DataFrame]:
    """Three arrival batches of a landing table, all rows: the PO change log (with key drift) by its own
    batches, other tables by id."""
    if table == "fact_po_raw":
        log = po_change_log(L.raw(table), drift=True, with_batch=True)
        return [log.filter(c).drop("_batch") for c in ("_batch < 2", "_batch = 2", "_batch = 3")]
    if table not in SPLIT_TABLES:
        return [L.raw(table)]
    return [L.raw(table).filter(c) for c in ("id % 7 > 1", "id % 7 = 0", "id % 7 = 1")]


def _store(spark, sf_dir, name: str, tables: list[str]) -> tuple[LandingStore, str, dict[str, list[DataFrame]]]:
    work, L = _work(spark, name), Landing.materialized(spark, sf_dir)
    return LandingStore(spark, f"{work}/landing"), f"{work}/marts", {t: _batches(L, t) for t in tables}


def _changed(mart: str, tables: list[str]):
    def run(spark, sf_dir):
        store, root, batches = _store(spark, sf_dir, f"changed-{mart}", tables)
        land_batches(store, {t: b[:1] for t, b in batches.items()})
        refresh_from_store(spark, store, root, mart, DAY_BEFORE)
        for t, b in batches.items():
            for i, rows in enumerate(b[1:], 1):
                store.append(t, rows, f"{i:06d}")
        store.compact(tables[0])  # its changes are in the base already, the others' in the tail
        kind, _ = refresh_from_store(spark, store, root, mart, AS_OF)
        if kind != "changes":
            raise RuntimeError(f"{mart}: refreshed in full")
        out = R.read_mart(spark, root, mart)
        # rows before the window keep their last refresh, and so does the snapshot of the day before
        return _stored(out.filter(F.col("snapshot_date") == F.lit(AS_OF) if mart.startswith("snapshot_") else
                                  F.col("metric_date") >= F.lit(window_start(AS_OF))))
    return run


CHANGED = {
    "agg_daily_buyer": ["fact_po_raw", "fact_rfq_raw", "fact_invoice_raw", "fact_delivery_raw", "fact_rating_raw"],
    "agg_daily_seller": ["fact_rfq_quote_raw", "fact_rfq_raw", "fact_po_raw", "fact_delivery_raw", "fact_rating_raw"],
    "agg_daily_revenue_territory": ["fact_po_raw", "dim_organization_raw"],
    "snapshot_org_daily": ["fact_po_raw", "fact_rfq_raw", "fact_invoice_raw", "fact_inventory_movement_raw"],
}


def store_latest_live(spark, sf_dir):
    """C8 + C9: the change log as a compacted base and a tail of two batches, read as latest live POs."""
    store, _, batches = _store(spark, sf_dir, "store", ["fact_po_raw"])
    land_batches(store, batches)
    return _portable(store.landing().live("fact_po_raw").select(*C.PO_COLS))


def store_mart_base_tail(spark, sf_dir):
    """A mart over base plus tail equals the mart over the whole change log."""
    store, _, batches = _store(spark, sf_dir, "store-mart", CHANGED["agg_daily_buyer"])
    land_batches(store, batches)
    return _portable(MARTS["agg_daily_buyer"](store.landing(), AS_OF))


def queries() -> dict:
    out = {f.__name__: f for f in (refresh_twice_same, mart_latest, report_refresh_status, refresh_group_run,
                                   report_mart_row_counts, seed_truncate_and_load, snapshot_two_days,
                                   stream_two_feeds_landed, stream_rejects, stream_upsert_state, cdc_compact_drop,
                                   store_latest_live, store_mart_base_tail, stream_state_upsert,
                                   stream_routed_tables, stream_routed_mart, report_stream_lag, stream_by_position, snapshot_equi_depth,
                                   engagement_from_sketches, engagement_months_from_sketches, result_within_limits)}
    out.update({f"changed_{mart}": _changed(mart, tables) for mart, tables in CHANGED.items()})
    return out


def _counted(marts: dict[str, str], failed: str | None = None) -> str:
    """Rows per mart as mart, n_rows and the readable form (and status, where a group run is meant)."""
    parts = [f"(SELECT '{m}' AS mart, NULL::BIGINT AS n_rows)" if m == failed else
             f"(SELECT '{m}' AS mart, count(*) AS n_rows FROM ({sql}))" for m, sql in marts.items()]
    status = f"CASE mart WHEN '{failed}' THEN 'failed' ELSE 'ok' END AS status, " if failed else ""
    return f"""
SELECT mart, {status}n_rows{'::DOUBLE' if failed else ''} AS n_rows, CASE
  WHEN n_rows >= 1000000000 THEN printf('%.2f billion', n_rows / 1e9)
  WHEN n_rows >= 1000000 THEN printf('%.2f million', n_rows / 1e6)
  WHEN n_rows >= 1000 THEN printf('%.2f thousand', n_rows / 1e3)
  ELSE printf('%d.00', n_rows) END AS n_rows_readable
FROM ({' UNION ALL '.join(parts)})"""


def oracle_sql() -> dict:
    cdc = C.oracle_sql()
    day = MART_SQL[ORG]
    before = f"SELECT * REPLACE ('{DAY_BEFORE}' AS snapshot_date) FROM ({day})"
    rejects = with_fixtures(["fact_po_raw", "fact_rfq_raw"], """
SELECT CASE WHEN id % 50 = 0 THEN 'malformed payload' ELSE 'landed' END AS reason, 'fact_po_raw' AS table_name,
       count(*) AS records FROM fact_po_raw GROUP BY 1
UNION ALL SELECT 'unlisted table', 'fact_rfq_raw', count(*) FROM fact_rfq_raw""")
    return {
        "refresh_twice_same": MART_SQL[TERRITORY],
        "mart_latest": MART_SQL[TERRITORY],
        "report_refresh_status": f"SELECT '{TERRITORY}' AS mart, count(*) AS n_rows, 1 AS refreshed FROM ({MART_SQL[TERRITORY]}) "
                                 f"UNION ALL SELECT '{ORG}', count(*), 1 FROM ({day})",
        "refresh_group_run": _counted({m: MART_SQL[m] for m in R.AGG_GROUP}, failed="agg_daily_engagement"),
        "report_mart_row_counts": _counted({m: f"SELECT * FROM ({MART_SQL[m]}) UNION ALL SELECT * REPLACE ('{DAY_BEFORE}' AS "
                                               f"snapshot_date) FROM ({MART_SQL[m]})" for m in R.SNAPSHOT_GROUP}),
        "seed_truncate_and_load": cdc["cdc_latest_live"],
        "snapshot_two_days": f"SELECT * FROM ({day}) UNION ALL {before}",
        "stream_two_feeds_landed": cdc["cdc_latest_live"],
        "stream_rejects": rejects,
        "stream_upsert_state": cdc["cdc_latest"],
        "cdc_compact_drop": cdc["cdc_latest_live"],
        "stream_state_upsert": cdc["cdc_latest"],
        "stream_routed_tables": cdc["cdc_latest"],
        "stream_routed_mart": MART_SQL["agg_daily_rfq_pipeline"],
        "report_stream_lag": STREAM_LAG_SQL,
        "snapshot_equi_depth": with_fixtures(["fact_po_raw"], f"SELECT {C._portable_cols('fact_po_raw')} FROM fact_po_raw"),
        "stream_by_position": cdc["cdc_latest_live"],
        "engagement_from_sketches": MART_SQL["agg_daily_engagement"],
        "engagement_months_from_sketches": MONTHS_SQL,
        "result_within_limits": MART_SQL[TERRITORY],
        "store_latest_live": cdc["cdc_key_drift"],
        "store_mart_base_tail": cdc["agg_daily_buyer_changelog"],
        # POs by the change log (with key drift) where the mart reads them; nothing of the refresh is restated
        **{f"changed_{mart}": cdc[f"{mart}_changelog"] if f"{mart}_changelog" in cdc else C.with_po_log(MART_SQL[mart])
           for mart in CHANGED},
    }
