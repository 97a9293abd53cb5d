"""Refresh into partitioned mart tables: idempotency, vanished keys, the
reference's month-drop mode, snapshot history, failure isolation, status."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from mart_helpers import make_landing

from tidemart.plans import refresh as R
from tidemart.plans.landing import Landing

AS_OF = dt.date(2001, 8, 1)


def _root():
    return tempfile.mkdtemp(prefix="marts-", dir="/tmp")


def _rows(df, drop=("_etl_loaded_at", "month")):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=repr)


def test_refresh_twice_same(spark, landing_small):
    root = _root()
    R.refresh_mart(spark, landing_small, "agg_daily_buyer", AS_OF, root)
    first = _rows(R.read_mart(spark, root, "agg_daily_buyer"))
    R.refresh_mart(spark, landing_small, "agg_daily_buyer", AS_OF, root)
    assert _rows(R.read_mart(spark, root, "agg_daily_buyer")) == first
    assert len(first) == 57


def test_literal_mode_dedups_on_read(spark, landing_small):
    root_a, root_b = _root(), _root()
    for _ in range(2):
        R.refresh_mart(spark, landing_small, "agg_daily_seller", AS_OF, root_a, mode="literal")
    R.refresh_mart(spark, landing_small, "agg_daily_seller", AS_OF, root_b)
    raw_a = R.read_mart(spark, root_a, "agg_daily_seller")
    assert raw_a.count() > R.read_mart(spark, root_b, "agg_daily_seller").count()  # older months doubled
    latest_a = R.mart_latest(raw_a, "agg_daily_seller")
    assert _rows(latest_a) == _rows(R.read_mart(spark, root_b, "agg_daily_seller"))


def test_empty_window_rerun_removes_rows(spark):
    day = "2001-07-20 10:00:00"
    po = {"id": 1, "buyer_org_id": 5, "supplier_org_id": 7, "total_amount": 3, "po_date": day}
    org = [{"id": 5, "state": "S", "city_name": "C"}]
    root = _root()
    L1 = make_landing(spark, {"fact_po_raw": [po], "dim_organization_raw": org})
    R.refresh_mart(spark, L1, "agg_daily_revenue_territory", AS_OF, root)
    assert R.read_mart(spark, root, "agg_daily_revenue_territory").count() == 1
    gone = dict(po, _cdc_version=2, _cdc_is_deleted=1)
    L2 = make_landing(spark, {"fact_po_raw": [po, gone], "dim_organization_raw": org})
    R.refresh_mart(spark, L2, "agg_daily_revenue_territory", AS_OF, root)
    assert R.read_mart(spark, root, "agg_daily_revenue_territory").count() == 0


def test_rows_before_window_survive(spark):
    org = [{"id": 5, "state": "S"}]
    old = {"id": 1, "buyer_org_id": 5, "supplier_org_id": 7, "total_amount": 3, "po_date": "2001-05-01 00:00:00"}
    root = _root()
    R.refresh_mart(spark, make_landing(spark, {"fact_po_raw": [old], "dim_organization_raw": org}),
                   "agg_daily_revenue_territory", dt.date(2001, 6, 1), root)
    new = {"id": 2, "buyer_org_id": 5, "supplier_org_id": 7, "total_amount": 4, "po_date": "2001-07-30 00:00:00"}
    R.refresh_mart(spark, make_landing(spark, {"fact_po_raw": [new], "dim_organization_raw": org}),
                   "agg_daily_revenue_territory", AS_OF, root)
    dates = {r["metric_date"] for r in R.read_mart(spark, root, "agg_daily_revenue_territory").collect()}
    assert dates == {dt.date(2001, 5, 1), dt.date(2001, 7, 30)}


def test_two_snapshot_days(spark, landing_small):
    root = _root()
    d1, d2 = dt.date(2001, 8, 1), dt.date(2001, 8, 2)
    R.refresh_mart(spark, landing_small, "snapshot_org_daily", d1, root)
    R.refresh_mart(spark, landing_small, "snapshot_org_daily", d2, root)
    days = R.read_mart(spark, root, "snapshot_org_daily").groupBy("snapshot_date").count().collect()
    assert {r["snapshot_date"]: r["count"] for r in days} == {d1: 150, d2: 150}
    lit_root = _root()
    R.refresh_mart(spark, landing_small, "snapshot_org_daily", d1, lit_root, mode="literal")
    R.refresh_mart(spark, landing_small, "snapshot_org_daily", d2, lit_root, mode="literal")
    days = R.read_mart(spark, lit_root, "snapshot_org_daily").select("snapshot_date").distinct().collect()
    assert [r[0] for r in days] == [d2]      # reference: one snapshot per month


def test_run_isolates_failures_and_reports_status(spark, landing_small):
    root = _root()

    def broken(name):
        if name == "fact_rating_raw":
            raise RuntimeError("landing table unavailable")
        return landing_small.raw(name)
    status = R.run(spark, Landing(broken), root, AS_OF, group="agg", as_of_events=dt.date(2024, 1, 30))
    by = {r["mart"]: r["status"] for r in status.collect()}
    assert by["agg_daily_buyer"] == "failed" and by["agg_daily_category_spend"] == "ok"
    assert by["agg_daily_engagement"] == "ok"
    st = R.refresh_status(spark, root).collect()
    names = {r["mart"] for r in st}
    assert "agg_daily_category_spend" in names and "agg_daily_buyer" not in names
    assert all(r["last_refresh"] is not None for r in st)
    assert R.read_mart(spark, root, "agg_daily_category_spend").filter(F.col("po_count") > 0).count() == 177


def test_cli_run_and_status(spark, landing_small, capsys):
    from tidemart.cli import main
    from tidemart.plans.landing import write_landing
    base = _root()
    for t in ["fact_inventory_movement_raw", "fact_po_raw", "fact_rfq_raw", "fact_invoice_raw"]:
        write_landing(landing_small.raw(t), t, f"{base}/landing/{t}", by_month=True)
    rc = main(["run", "--landing", f"{base}/landing", "--marts", f"{base}/marts",
               "--group", "snapshot", "--as-of", "2001-08-01"], spark=spark)
    assert rc == 0
    assert R.read_mart(spark, f"{base}/marts", "snapshot_inventory_sku_daily").count() == 1449
    assert main(["status", "--marts", f"{base}/marts"], spark=spark) == 0
    assert "snapshot_org_daily" in capsys.readouterr().out


def test_freshness_report(spark, landing_small):
    from tidemart.plans.reports import freshness
    rows = freshness(landing_small, dt.datetime(2024, 2, 2), ["fact_po_raw", "dim_user_raw"]).collect()
    assert {r["table_name"]: r["age_secs"] for r in rows} == {"fact_po_raw": 86400, "dim_user_raw": 86400}


def test_refresh_strict_semantics(spark, landing_small):
    from tidemart.plans import marts_strict as S
    root = _root()
    R.refresh_mart(spark, landing_small, "agg_daily_buyer", AS_OF, root, semantics="strict")
    got = _rows(R.read_mart(spark, root, "agg_daily_buyer"))
    want = sorted((tuple(r) for r in S.daily_buyer(landing_small, AS_OF).collect()), key=repr)
    assert got == want


def test_run_all_marts_equals_direct_results(spark, landing_small):
    from tidemart import mart
    root = _root()
    events_day = dt.date(2024, 1, 30)
    status = R.run(spark, landing_small, root, AS_OF, group="all", as_of_events=events_day)
    assert {r["status"] for r in status.collect()} == {"ok"}
    for name in R.GROUPS["all"]:
        day = events_day if name == "agg_daily_engagement" else AS_OF
        got = _rows(R.read_mart(spark, root, name))
        want = sorted((tuple(r) for r in mart(landing_small, name, day).collect()), key=repr)
        cols = R.read_mart(spark, root, name).drop("_etl_loaded_at", "month").columns
        assert cols == mart(landing_small, name, day).columns, name
        assert got == want, name


def test_a_deleted_future_order_leaves_the_mart(spark):
    """The window has no upper bound: a later month that no longer has rows is emptied."""
    root = tempfile.mkdtemp(prefix="marts-", dir="/tmp")
    org = [{"id": 2, "state": "s", "city_name": "c"}]
    po = lambda day, deleted: {"id": 1, "buyer_org_id": 2, "supplier_org_id": 3, "po_date": day, "status": 5,
                               "total_amount": 10, "is_deleted": deleted}
    future = dt.datetime(2001, 10, 5)
    for deleted in (0, 1):
        L = make_landing(spark, {"fact_po_raw": [po(future, deleted)], "dim_organization_raw": org})
        R.refresh_mart(spark, L, "agg_daily_revenue_territory", AS_OF, root)
        assert R.read_mart(spark, root, "agg_daily_revenue_territory").count() == 1 - deleted


def test_marts_refreshed_at_the_same_time(spark, landing_small):
    one, three, broken = _root(), _root(), {"fact_rating_raw"}

    def raw(name):
        if name in broken:
            raise RuntimeError("landing table unavailable")
        return landing_small.raw(name)
    at_a_time = R.run(spark, Landing(raw), three, AS_OF, group="agg", as_of_events=dt.date(2024, 1, 30), parallel=3)
    status = {r["mart"]: r["status"] for r in at_a_time.collect()}
    assert {m for m, s in status.items() if s == "failed"} == {"agg_daily_buyer", "agg_daily_seller", "agg_daily_supplier_spend"}
    for name in ("agg_daily_category_spend", "agg_daily_revenue_territory"):
        R.refresh_mart(spark, landing_small, name, AS_OF, one)
        assert _rows(R.read_mart(spark, three, name)) == _rows(R.read_mart(spark, one, name))


def test_mart_row_counts_name_missing_tables(spark, landing_small, tmp_path):
    from tidemart.plans.reports import mart_row_counts
    name = "agg_daily_revenue_territory"
    n, _ = R.refresh_mart(spark, landing_small, name, AS_OF, str(tmp_path))
    got = {r["mart"]: (r["n_rows"], r["n_rows_readable"]) for r in mart_row_counts(
        spark, str(tmp_path), [name, "agg_daily_buyer"]).collect()}
    assert got == {name: (n, f"{n}.00"), "agg_daily_buyer": (None, None)}
