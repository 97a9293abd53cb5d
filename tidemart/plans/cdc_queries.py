"""Registered CDC, clean-view and report queries, with their oracle SQL."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.cdc import (
    drop_columns, latest_by_max, latest_live, latest_live_incremental, latest_version, map_to_landing,
    snapshot_plus_tail,
)
from tidemart.plans import views as V
from tidemart.plans.landing import Landing
from tidemart.plans.reports import cdc_lag, freshness, row_counts
from tidemart.plans.oracle_fixtures import FIXTURE_SQL, latest_sql, with_fixtures
from tidemart.sources.copy import bounded_copy, insert_if_absent
from tidemart.sources.changelog import LOG_START, po_change_log, po_mapping, po_source
from tidemart.sources.fixtures import Fixtures
from tidemart.sources.schemas import LANDING, SYNCED_AT, VERSION, ts_lit
from tidemart.sources.tables import TableSource

PO = LANDING["fact_po_raw"]
PO_COLS = [f.name for f in PO.schema.fields]
# Arrival batches 0..APPLIED_BATCHES-1 count as applied in the lag report.
APPLIED_BATCHES = 3
LAG_AS_OF = _dt.datetime(2024, 2, 2, 12, 0, 0)


def _portable(df: DataFrame) -> DataFrame:
    from tidemart.plans.registry import portable
    return portable(df)


def _fx(spark: SparkSession, sf_dir: str) -> Fixtures:
    return Fixtures(TableSource(spark, sf_dir))


def _po(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed single-version fact_po_raw the change log is built from."""
    return Landing.materialized(spark, sf_dir).raw("fact_po_raw")


# --- Spark side --------------------------------------------------------------

def cdc_latest(spark, sf_dir):
    return _portable(latest_version(po_change_log(_po(spark, sf_dir)), PO.sort_key))


def cdc_latest_by_max(spark, sf_dir):
    """C1 as an aggregate (max_by over the version order) instead of a window."""
    log = po_change_log(_po(spark, sf_dir))
    return _portable(latest_by_max(log, PO.sort_key, PO_COLS).select(*PO_COLS))


def dashboard_po_by_status(spark, sf_dir):
    """Entry point C: SQL over the registered clean views (V6 over the change log)."""
    M = Landing.materialized(spark, sf_dir)
    L = Landing(lambda t: po_change_log(M.raw("fact_po_raw")) if t == "fact_po_raw" else M.raw(t))
    V.register_views(spark, L)
    return _portable(spark.sql("""
        SELECT status, count(*) AS po_count, CAST(sum(total_amount) AS DECIMAL(18,4)) AS total_amount,
               count(DISTINCT buyer_org_id) AS buyers, min(metric_date) AS first_po, max(metric_date) AS last_po
        FROM fact_po GROUP BY status"""))


def cdc_latest_live(spark, sf_dir):
    return _portable(latest_live(po_change_log(_po(spark, sf_dir)), PO.sort_key))


def cdc_key_drift(spark, sf_dir):
    return _portable(latest_live(po_change_log(_po(spark, sf_dir), drift=True), PO.key("sort_key")))


def cdc_key_drift_primary_key(spark, sf_dir):
    return _portable(latest_live(po_change_log(_po(spark, sf_dir), drift=True), PO.key("primary_key")))


def cdc_snapshot_plus_tail(spark, sf_dir):
    po = _po(spark, sf_dir)
    snap = po.drop(VERSION, SYNCED_AT).withColumn(
        SYNCED_AT, ts_lit(_dt.datetime(2024, 1, 31)))
    log = po_change_log(po)
    # the tail overlaps the snapshot with the replayed version-1 copies
    tail = log.filter((F.col(VERSION) >= 2) | (F.col(SYNCED_AT) >= ts_lit(_dt.datetime(2024, 2, 2))))
    return _portable(snapshot_plus_tail(snap, tail, PO.sort_key).select(*PO_COLS))


def cdc_replay_idempotent(spark, sf_dir):
    log = po_change_log(_po(spark, sf_dir))
    return _portable(latest_live(log.unionByName(log), PO.sort_key))


def cdc_compact_then_tail(spark, sf_dir):
    """C8 + C9: compact the first two arrival batches (tombstones kept), then
    apply the later batches on top; equals the live reading of the whole log."""
    log = po_change_log(_po(spark, sf_dir), with_batch=True)
    compacted = latest_version(log.filter(F.col("_batch") < 2).drop("_batch"), PO.sort_key)
    tail = log.filter(F.col("_batch") >= 2).drop("_batch")
    return _portable(latest_live(compacted.unionByName(tail), PO.sort_key))


def cdc_incremental_merge(spark, sf_dir):
    """Compacted first half of the log + tail applied incrementally."""
    log = po_change_log(_po(spark, sf_dir), with_batch=True)
    base = latest_version(log.filter(F.col("_batch") < 2).drop("_batch"), PO.sort_key)
    tail = log.filter(F.col("_batch") >= 2).drop("_batch")
    return _portable(latest_live_incremental(base, tail, PO.sort_key))


def seed_bounded_copy(spark, sf_dir):
    """The first 2,000 POs by id (a stable seed sample)."""
    return _portable(bounded_copy(_po(spark, sf_dir), SEED_ROWS, ["id"]))


def seed_insert_if_absent(spark, sf_dir):
    """existing = POs of even order keys; insert version-2 rows of every
    third key only where the key is absent, then the table content."""
    po = _po(spark, sf_dir)
    existing = po.filter((F.col("id") - 1) % 2 == 0)
    new = po_change_log(po).filter(F.col(VERSION) == 2)
    added = insert_if_absent(new, existing, ["id"], first_by=[F.col(SYNCED_AT)])
    return _portable(existing.unionByName(added))


SEED_ROWS = 2000


def cdc_map_po(spark, sf_dir):
    src = po_source(_fx(spark, sf_dir))
    return _portable(map_to_landing(src, "fact_po_raw", po_mapping(),
                                    synced_at=ts_lit(LOG_START), version=F.lit(0)))


def cdc_exclude_cols(spark, sf_dir):
    src = po_source(_fx(spark, sf_dir))
    landed = map_to_landing(src, "fact_po_raw", po_mapping(), synced_at=ts_lit(LOG_START), version=F.lit(0))
    return _portable(drop_columns(landed, EXCLUDED))


EXCLUDED = ["delivery_address", "payment_terms"]


def _view(name: str):
    fn = V.VIEWS[name]

    def run(spark, sf_dir):
        M = Landing.materialized(spark, sf_dir)
        if name == "fact_po":
            L = Landing(lambda t: po_change_log(M.raw("fact_po_raw")) if t == "fact_po_raw" else M.raw(t))
        else:
            L = M
        return _portable(fn(L))
    return run


def report_row_counts(spark, sf_dir):
    """Raw and live row counts of the sixteen landing tables."""
    return row_counts(Landing.materialized(spark, sf_dir))


def report_freshness(spark, sf_dir):
    """R7 (monitor view): per landing table, newest arrival, newest version and
    the age of the newest arrival at the report time."""
    return _portable(freshness(Landing.materialized(spark, sf_dir), LAG_AS_OF))


def report_cdc_lag(spark, sf_dir):
    """Log position vs applied position and freshness, for the PO change log
    when arrival batches 0..2 are applied."""
    log = po_change_log(_po(spark, sf_dir), with_batch=True)
    return _portable(cdc_lag(log, F.col("_batch") < APPLIED_BATCHES, LAG_AS_OF, "fact_po_raw"))


def queries() -> dict:
    q = {
        "cdc_latest": cdc_latest,
        "cdc_latest_live": cdc_latest_live,
        "cdc_latest_by_max": cdc_latest_by_max,
        "dashboard_po_by_status": dashboard_po_by_status,
        "cdc_key_drift": cdc_key_drift,
        "cdc_key_drift_primary_key": cdc_key_drift_primary_key,
        "cdc_snapshot_plus_tail": cdc_snapshot_plus_tail,
        "cdc_replay_idempotent": cdc_replay_idempotent,
        "cdc_compact_then_tail": cdc_compact_then_tail,
        "cdc_incremental_merge": cdc_incremental_merge,
        "cdc_map_po": cdc_map_po,
        "cdc_exclude_cols": cdc_exclude_cols,
        "seed_bounded_copy": seed_bounded_copy,
        "seed_insert_if_absent": seed_insert_if_absent,
        "report_row_counts": report_row_counts,
        "report_cdc_lag": report_cdc_lag,
        "report_freshness": report_freshness,
    }
    for name in V.VIEWS:
        q[f"view_{name}"] = _view(name)
    q.update(log_mart_queries())
    return q


# --- oracle SQL ---------------------------------------------------------------

def _ts(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _portable_cols(table: str, drop: tuple[str, ...] = ()) -> str:
    out = []
    for f in LANDING[table].schema.fields:
        if f.name in drop:
            continue
        tn = type(f.dataType).__name__
        if tn == "DecimalType":
            out.append(f"CAST({f.name} AS DOUBLE) AS {f.name}")
        elif tn == "DateType":
            out.append(f"strftime({f.name}, '%Y-%m-%d') AS {f.name}")
        elif tn == "TimestampType":
            out.append(f"{_ts(f.name)} AS {f.name}")
        else:
            out.append(f.name)
    return ", ".join(out)


def _stamp_sql(version: int, deleted: int, delay_days: int = 0, replace: str = "", where: str = "") -> str:
    batch = f"((id - 1 + {version}) % 4)"
    rep = f" REPLACE ({replace})" if replace else ""
    w = f" WHERE {where}" if where else ""
    return (f"SELECT b.*{rep}, TIMESTAMP '2024-02-01 00:00:00' + to_days({delay_days}) + "
            f"to_hours(CAST({batch} AS BIGINT)) AS _cdc_synced_at, {deleted} AS _cdc_is_deleted, "
            f"CAST({version} AS BIGINT) AS _cdc_version, CAST({batch} AS INTEGER) AS _batch FROM base b{w}")


def _log_sql(drift: bool = False) -> str:
    parts = [
        _stamp_sql(1, 0),
        _stamp_sql(2, 0, replace="CAST(total_amount + 100 AS DECIMAL(18,4)) AS total_amount, 5 AS status",
                   where="(id - 1) % 3 = 0"),
        _stamp_sql(3, 1, where="(id - 1) % 11 = 0"),
        _stamp_sql(1, 0, delay_days=1, where="(id - 1) % 5 = 0"),
    ]
    if drift:
        parts.append(_stamp_sql(2, 0, delay_days=2, replace="buyer_org_id + 1 AS buyer_org_id",
                                where="(id - 1) % 13 = 0"))
    return "\nUNION ALL\n".join(parts)


def _log_ctes(drift: bool = False) -> list[tuple[str, str]]:
    return [("base", "SELECT * EXCLUDE (_cdc_synced_at, _cdc_is_deleted, _cdc_version) FROM fact_po_raw"),
            ("log", _log_sql(drift))]


def _dedup(src: str, key: str, live: bool) -> str:
    pred = " AND _cdc_is_deleted = 0" if live else ""
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY _cdc_version DESC, _cdc_synced_at DESC) AS _rn FROM {src}) WHERE _rn = 1{pred}")


SORT_KEY = ", ".join(PO.sort_key)


def _on_log(body_src: str, drift: bool = False, extra: list[tuple[str, str]] | None = None) -> str:
    return with_fixtures(["fact_po_raw"], f"SELECT {_portable_cols('fact_po_raw')} FROM {body_src}",
                         _log_ctes(drift) + (extra or []))


def _map_po_sql(drop: tuple[str, ...] = ()) -> str:
    src = """SELECT CAST(o_orderkey AS INTEGER) AS id, 'PO-' || CAST(o_orderkey AS VARCHAR) AS po_number,
      CASE WHEN o_orderkey % 3 <> 0 THEN 'NEFT' END AS payment_mode,
      CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS po_created_date,
      CAST(o_orderdate AS DATE) + 45 AS expiry_date,
      CAST(o_custkey + 1 AS INTEGER) AS buyer_org_id,
      CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey % 100 + 1000000 AS INTEGER) END AS seller_org_id,
      CAST(1 + o_orderkey % 5 AS INTEGER) AS status,
      CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS total_amount,
      o_orderdate AS created_date, o_orderdate + INTERVAL 1 DAY AS updated_date,
      CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey + 1 END AS buyer_user_id
    FROM orders"""
    landed = """SELECT CAST(COALESCE(id, 0) AS BIGINT) AS id, CAST(COALESCE(buyer_org_id, 0) AS BIGINT) AS buyer_org_id,
      CAST(COALESCE(seller_org_id, 0) AS BIGINT) AS supplier_org_id, CAST(COALESCE(buyer_user_id, 0) AS BIGINT) AS created_by,
      COALESCE(po_number, '') AS po_number, COALESCE(status, 0) AS status,
      COALESCE(CAST(total_amount AS DECIMAL(18,4)), 0) AS total_amount, 'INR' AS currency,
      COALESCE(CAST(po_created_date AS TIMESTAMP), created_date, TIMESTAMP '1970-01-01 00:00:00') AS po_date,
      COALESCE(expiry_date, DATE '1970-01-01') AS expected_delivery, '' AS delivery_address,
      COALESCE(payment_mode, '') AS payment_terms, 0 AS is_deleted,
      COALESCE(created_date, TIMESTAMP '1970-01-01 00:00:00') AS created_at,
      COALESCE(updated_date, TIMESTAMP '1970-01-01 00:00:00') AS updated_at,
      TIMESTAMP '2024-02-01 00:00:00' AS _cdc_synced_at, 0 AS _cdc_is_deleted, CAST(0 AS BIGINT) AS _cdc_version
    FROM src"""
    return (f"WITH src AS ({src}), landed AS ({landed})\n"
            f"SELECT {_portable_cols('fact_po_raw', drop)} FROM landed")


def _row_counts_sql() -> str:
    tables = list(LANDING)
    body = []
    for t in tables:
        body.append(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS raw_rows, "
                    f"(SELECT count(*) FROM ({latest_sql(t, live=False)})) AS keys, "
                    f"(SELECT count(*) FROM ({latest_sql(t, live=True)})) AS live_rows")
    union = "\nUNION ALL\n".join(body)
    readable = " ".join(
        f"WHEN raw_rows >= {int(b)} THEN CAST((raw_rows * 100 + {int(b) // 2}) // {int(b)} // 100 AS VARCHAR) || '.' "
        f"|| lpad(CAST((raw_rows * 100 + {int(b) // 2}) // {int(b)} % 100 AS VARCHAR), 2, '0') || ' {w}'"
        for b, w in [(1e15, "quadrillion"), (1e12, "trillion"), (1e9, "billion"), (1e6, "million"), (1e3, "thousand")])
    fixture_tables = [t for t in tables if t in FIXTURE_SQL] + [t for t in tables if t not in FIXTURE_SQL]
    return with_fixtures(fixture_tables, f"""SELECT table_name, raw_rows, keys, live_rows,
  CASE {readable} ELSE CAST(raw_rows AS VARCHAR) || '.00' END AS raw_rows_readable
FROM counts""", [("counts", union)])


def _freshness_sql() -> str:
    union = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, max(_cdc_synced_at) AS ts, max(_cdc_version) AS last_version FROM {t}"
        for t in LANDING)
    return with_fixtures(list(LANDING), f"""SELECT table_name,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_synced_at, last_version,
  CAST(epoch(TIMESTAMP '{LAG_AS_OF:%Y-%m-%d %H:%M:%S}') - epoch(ts) AS BIGINT) AS age_secs
FROM fresh""", [("fresh", union)])


def _lag_sql() -> str:
    return with_fixtures(["fact_po_raw"], f"""SELECT 'fact_po_raw' AS table_name,
  max(_cdc_version) AS log_version,
  max(_cdc_version) FILTER (WHERE _batch < {APPLIED_BATCHES}) AS applied_version,
  max(_cdc_version) - max(_cdc_version) FILTER (WHERE _batch < {APPLIED_BATCHES}) AS version_lag,
  count(*) FILTER (WHERE _batch >= {APPLIED_BATCHES}) AS pending_rows,
  count(DISTINCT id) FILTER (WHERE _batch >= {APPLIED_BATCHES}) AS pending_keys,
  CAST(epoch(TIMESTAMP '{LAG_AS_OF:%Y-%m-%d %H:%M:%S}') - epoch(max(_cdc_synced_at) FILTER (WHERE _batch < {APPLIED_BATCHES})) AS BIGINT) AS freshness_secs,
  CAST(epoch(max(_cdc_synced_at)) - epoch(max(_cdc_synced_at) FILTER (WHERE _batch < {APPLIED_BATCHES})) AS BIGINT) AS lag_secs
FROM log""", _log_ctes())


def oracle_sql() -> dict:
    snap_tail = [
        ("snap", "SELECT * EXCLUDE (_cdc_synced_at, _cdc_version, _cdc_is_deleted), "
                 "TIMESTAMP '2024-01-31 00:00:00' AS _cdc_synced_at, 0 AS _cdc_is_deleted, "
                 "CAST(0 AS BIGINT) AS _cdc_version, 0 AS _batch FROM fact_po_raw"),
        ("tail", "SELECT * FROM log WHERE _cdc_version >= 2 OR _cdc_synced_at >= TIMESTAMP '2024-02-02 00:00:00'"),
        ("combined", "SELECT * FROM snap UNION ALL SELECT * FROM tail"),
        ("res", _dedup("combined", SORT_KEY, True)),
    ]
    out = {
        "cdc_latest": _on_log("res", extra=[("res", _dedup("log", SORT_KEY, False))]),
        "cdc_latest_live": _on_log("res", extra=[("res", _dedup("log", SORT_KEY, True))]),
        "cdc_latest_by_max": _on_log("res", extra=[("res", _dedup("log", SORT_KEY, False))]),
        "dashboard_po_by_status": with_fixtures(["fact_po_raw"], """SELECT status, count(*) AS po_count,
  CAST(CAST(sum(total_amount) AS DECIMAL(18,4)) AS DOUBLE) AS total_amount, count(DISTINCT buyer_org_id) AS buyers,
  strftime(min(po_date), '%Y-%m-%d %H:%M:%S') AS first_po, strftime(max(po_date), '%Y-%m-%d %H:%M:%S') AS last_po
FROM res WHERE is_deleted = 0 GROUP BY status""", _log_ctes() + [("res", _dedup("log", SORT_KEY, True))]),
        "cdc_key_drift": _on_log("res", drift=True, extra=[("res", _dedup("log", SORT_KEY, True))]),
        "cdc_key_drift_primary_key": _on_log("res", drift=True, extra=[("res", _dedup("log", "id", True))]),
        "cdc_snapshot_plus_tail": _on_log("res", extra=snap_tail),
        "cdc_replay_idempotent": _on_log("res", extra=[
            ("twice", "SELECT * FROM log UNION ALL SELECT * FROM log"), ("res", _dedup("twice", SORT_KEY, True))]),
        # the property: compaction keeping tombstones + tail == live reading of the whole log
        "cdc_compact_then_tail": _on_log("res", extra=[("res", _dedup("log", SORT_KEY, True))]),
        "cdc_incremental_merge": _on_log("res", extra=[("res", _dedup("log", SORT_KEY, True))]),
        "seed_bounded_copy": with_fixtures(["fact_po_raw"], f"SELECT {_portable_cols('fact_po_raw')} "
                                           f"FROM (SELECT * FROM fact_po_raw ORDER BY id LIMIT {SEED_ROWS})"),
        "seed_insert_if_absent": with_fixtures(["fact_po_raw"], f"SELECT {_portable_cols('fact_po_raw')} FROM res",
            _log_ctes() + [
                ("existing", "SELECT * FROM fact_po_raw WHERE (id - 1) % 2 = 0"),
                ("added", "SELECT * EXCLUDE (_batch) FROM log WHERE _cdc_version = 2 "
                          "AND id NOT IN (SELECT id FROM existing)"),
                ("res", "SELECT * FROM existing UNION ALL SELECT * FROM added")]),
        "cdc_map_po": _map_po_sql(),
        "cdc_exclude_cols": _map_po_sql(tuple(EXCLUDED)),
        "report_row_counts": _row_counts_sql(),
        "report_cdc_lag": _lag_sql(),
        "report_freshness": _freshness_sql(),
    }
    for name in V.VIEWS:
        out[f"view_{name}"] = V.view_sql(name)
    out.update(log_mart_sql())
    return out


# --- marts over the versioned PO change log (dedup inside the marts) -----------

LOG_MARTS = ["agg_daily_buyer", "agg_daily_seller", "agg_daily_category_spend", "agg_daily_supplier_spend",
             "agg_daily_revenue_territory", "snapshot_org_daily"]


def with_po_log(sql: str) -> str:
    """Oracle SQL of a mart with ``fact_po_raw`` replaced by the change log
    (versions 1-3, replays, key drift) derived from the same base rows."""
    old = f"fact_po_raw AS (\n{FIXTURE_SQL['fact_po_raw']}\n)"
    if old not in sql:
        raise ValueError("mart SQL does not define fact_po_raw")
    new = (f"fact_po_base AS (\n{FIXTURE_SQL['fact_po_raw']}\n),\n"
           "base AS (SELECT * EXCLUDE (_cdc_synced_at, _cdc_is_deleted, _cdc_version) FROM fact_po_base),\n"
           f"log AS (\n{_log_sql(drift=True)}\n),\n"
           "fact_po_raw AS (SELECT * EXCLUDE (_batch) FROM log)")
    return sql.replace(old, new, 1)


def _log_landing(spark, sf_dir) -> Landing:
    M = Landing.materialized(spark, sf_dir)
    return Landing(lambda t: po_change_log(M.raw("fact_po_raw"), drift=True) if t == "fact_po_raw" else M.raw(t))


def log_mart_queries() -> dict:
    from tidemart.plans import marts as MM
    from tidemart.plans import marts_strict as SS
    from tidemart.plans.registry import AS_OF
    out = {}
    for name in LOG_MARTS:
        for strict in (False, True):
            fn = SS.STRICT_MARTS[name] if strict else MM.MARTS[name]

            def run(spark, sf_dir, _fn=fn):
                return _portable(_fn(_log_landing(spark, sf_dir), AS_OF))
            out[f"{name}_changelog" + ("_strict" if strict else "")] = run
    return out


def log_mart_sql() -> dict:
    from tidemart.plans.oracle_sql import MART_SQL, STRICT_SQL
    out = {}
    for name in LOG_MARTS:
        out[f"{name}_changelog"] = with_po_log(MART_SQL[name])
        out[f"{name}_changelog_strict"] = with_po_log(STRICT_SQL[name])
    return out
