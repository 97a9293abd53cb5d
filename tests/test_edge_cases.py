"""Hand-made rows for the semantic traps (FIXTURES.md §5)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mart_helpers import make_landing

from tidemart.functions.exprs import hour_boundaries, readable_quantity, top1
from tidemart.operators.cdc import latest_live, latest_version
from tidemart.plans import marts as M
from tidemart.sources.rows import landing_rows

AS_OF = dt.date(2001, 8, 1)
DAY = "2001-07-20 10:00:00"


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()


def test_tombstone_then_older_version(spark):
    log = landing_rows(spark, "fact_po_raw", [
        {"id": 1, "buyer_org_id": 5, "po_date": DAY, "_cdc_version": 1},
        {"id": 1, "buyer_org_id": 5, "po_date": DAY, "_cdc_version": 2, "_cdc_is_deleted": 1},
    ])
    key = ("buyer_org_id", "po_date", "id")
    assert latest_live(log, key).count() == 0
    # filtering tombstones before the dedup brings the old version back: wrong
    wrong = latest_version(log.filter("_cdc_is_deleted = 0"), key)
    assert wrong.count() == 1


def test_equal_version_later_sync_wins(spark):
    log = landing_rows(spark, "fact_po_raw", [
        {"id": 1, "po_date": DAY, "status": 1, "_cdc_synced_at": "2024-02-01 00:00:00"},
        {"id": 1, "po_date": DAY, "status": 2, "_cdc_synced_at": "2024-02-02 00:00:00"},
    ])
    assert one(latest_live(log, ("buyer_org_id", "po_date", "id")))["status"] == 2


def test_key_drift_sort_key_vs_primary_key(spark):
    log = landing_rows(spark, "fact_po_raw", [
        {"id": 1, "buyer_org_id": 5, "po_date": DAY, "_cdc_version": 1},
        {"id": 1, "buyer_org_id": 6, "po_date": DAY, "_cdc_version": 2},
    ])
    assert latest_live(log, ("buyer_org_id", "po_date", "id")).count() == 2
    assert one(latest_live(log, ("id",)))["buyer_org_id"] == 6


@pytest.mark.parametrize("plan", ["factorised", "joins"])
def test_po_without_any_match(spark, plan):
    L = make_landing(spark, {"fact_po_raw": [
        {"id": 1, "buyer_org_id": 5, "status": 5, "total_amount": 100, "po_date": DAY}]})
    r = one(M.daily_buyer(L, AS_OF, plan=plan))
    assert r["po_count"] == 1 and r["rfq_count"] == 1 and r["invoice_count"] == 1
    assert r["on_time_delivery_rate"] == 1.0 and r["avg_supplier_rating"] == 0.0
    assert r["avg_quote_per_rfq"] is None
    assert r["total_spend"] == Decimal("100.0000") and r["approved_spend"] == Decimal("100.0000")


@pytest.mark.parametrize("plan", ["factorised", "joins"])
def test_fan_out_counts_joined_rows(spark, plan):
    L = make_landing(spark, {
        "fact_po_raw": [{"id": 1, "buyer_org_id": 5, "status": 1, "total_amount": 100, "po_date": DAY}],
        "fact_rfq_raw": [{"id": 11, "buyer_org_id": 5, "rfq_date": DAY, "quote_count": 2},
                         {"id": 12, "buyer_org_id": 5, "rfq_date": DAY, "quote_count": 0}],
        "fact_delivery_raw": [{"id": 21, "po_id": 1, "delay_days": 0}, {"id": 22, "po_id": 1, "delay_days": 3}],
    })
    r = one(M.daily_buyer(L, AS_OF, plan=plan))
    assert r["po_count"] == 4 and r["total_spend"] == Decimal("400.0000")
    assert r["rfq_count"] == 2 and r["quote_received"] == 4 and r["avg_quote_per_rfq"] == 2.0
    assert r["on_time_delivery_rate"] == 0.5


@pytest.mark.parametrize("plan", ["factorised", "joins"])
def test_rfq_without_quote_uses_epoch(spark, plan):
    L = make_landing(spark, {"fact_rfq_raw": [
        {"id": 1, "buyer_org_id": 5, "rfq_date": "2001-08-01 00:00:00", "total_budget": 10}]})
    r = one(M.daily_rfq_pipeline(L, AS_OF, plan=plan))
    hours = (dt.datetime(2001, 8, 1) - dt.datetime(1970, 1, 1)).total_seconds() / 3600
    assert r["avg_response_hours"] == -hours
    assert r["rfq_open"] == 1


def test_hour_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 1, 1, 0, 59), dt.datetime(2001, 1, 1, 2, 1))], "a timestamp, b timestamp")
    assert df.select(hour_boundaries("a", "b").alias("h")).first()["h"] == 2


def test_window_edges(spark):
    rows = [{"id": i, "buyer_org_id": 5, "supplier_org_id": 7, "total_amount": 1,
             "po_date": f"{d} 00:00:00"} for i, d in
            [(1, AS_OF - dt.timedelta(days=90)), (2, AS_OF - dt.timedelta(days=91)), (3, AS_OF + dt.timedelta(days=1))]]
    L = make_landing(spark, {"fact_po_raw": rows, "dim_organization_raw": [{"id": 5, "state": "S"}]})
    got = {r["metric_date"] for r in M.daily_revenue_territory(L, AS_OF).collect()}
    assert got == {AS_OF - dt.timedelta(days=90), AS_OF + dt.timedelta(days=1)}


def test_top1_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "x string")
    assert df.agg(top1("x").alias("t")).first()["t"] == "a"


def test_inventory_oversold_clamps(spark):
    L = make_landing(spark, {"fact_inventory_movement_raw": [
        {"id": 1, "org_id": 1, "warehouse_id": 1, "product_id": 1, "movement_type": "inbound", "quantity": 5, "unit_cost": 2},
        {"id": 2, "org_id": 1, "warehouse_id": 1, "product_id": 1, "movement_type": "outbound", "quantity": 3, "unit_cost": 2},
        {"id": 3, "org_id": 1, "warehouse_id": 1, "product_id": 1, "movement_type": "reserved", "quantity": 4, "unit_cost": 2},
    ]})
    r = one(M.snapshot_inventory_sku(L, AS_OF))
    assert r["qty_on_hand"] == Decimal("2.0000") and r["qty_available"] == Decimal("0.0000")
    assert r["total_value"] == Decimal("4.0000")


@pytest.mark.parametrize("plan", ["factorised", "joins"])
def test_chained_default_po_id_zero(spark, plan):
    # a quote whose supplier has no PO that day joins the default PO id 0,
    # which matches a delivery with po_id 0
    L = make_landing(spark, {
        "fact_rfq_quote_raw": [{"id": 1, "rfq_id": 9, "supplier_org_id": 7, "status": 6,
                                "quoted_at": DAY}],
        "fact_delivery_raw": [{"id": 5, "po_id": 0, "delay_days": 4}, {"id": 6, "po_id": 0, "delay_days": -1}],
    })
    r = one(M.daily_seller(L, AS_OF, plan=plan))
    assert r["quotes_submitted"] == 2 and r["quotes_won"] == 2
    assert r["po_fulfilled"] == 1 and r["on_time_delivery"] == 0.5
    assert r["po_received"] == 1 and r["rfq_received"] == 1


def test_deleted_right_rows_still_join(spark):
    L = make_landing(spark, {
        "fact_po_raw": [{"id": 1, "buyer_org_id": 5, "po_date": DAY}],
        "fact_invoice_raw": [{"id": 3, "po_id": 1, "status": "paid", "_cdc_is_deleted": 1}],
    })
    assert one(M.daily_buyer(L, AS_OF))["invoice_paid"] == 1


def test_readable_quantity(spark):
    df = spark.createDataFrame([(150,), (1660,), (1605,), (2_500_000,)], "n long")
    got = [r["q"] for r in df.select(readable_quantity("n").alias("q")).collect()]
    assert got == ["150.00", "1.66 thousand", "1.61 thousand", "2.50 million"]


def test_decimal_average_rounds_half_up_once(spark):
    L = make_landing(spark, {
        "fact_po_raw": [{"id": i, "buyer_org_id": 5, "supplier_org_id": 7, "po_date": DAY,
                         "total_amount": a} for i, a in [(1, "1.0001"), (2, "1.0002")]],
        "dim_organization_raw": [{"id": 5, "state": "S"}]})
    assert one(M.daily_revenue_territory(L, AS_OF))["avg_order_value"] == Decimal("1.0002")


def test_month_key(spark):
    from tidemart.functions.exprs import yyyymm
    df = spark.createDataFrame([(dt.date(2024, 3, 9),)], "d date")
    assert df.select(yyyymm("d").alias("m")).first()["m"] == 202403
    assert df.select(F.lit(1)).count() == 1


# --- strict semantics (FIXTURES.md §5, right-hand column) ----------------------

def test_strict_po_without_any_match(spark):
    from tidemart.plans import marts_strict as S
    L = make_landing(spark, {"fact_po_raw": [
        {"id": 1, "buyer_org_id": 5, "status": 5, "total_amount": 100, "po_date": DAY}]})
    r = one(S.daily_buyer(L, AS_OF))
    assert (r["rfq_count"], r["invoice_count"]) == (0, 0)
    assert r["on_time_delivery_rate"] is None and r["avg_supplier_rating"] is None


def test_strict_no_fan_out(spark):
    from tidemart.plans import marts_strict as S
    L = make_landing(spark, {
        "fact_po_raw": [{"id": 1, "buyer_org_id": 5, "status": 1, "total_amount": 100, "po_date": DAY}],
        "fact_rfq_raw": [{"id": 11, "buyer_org_id": 5, "rfq_date": DAY}, {"id": 12, "buyer_org_id": 5, "rfq_date": DAY}],
        "fact_delivery_raw": [{"id": 21, "po_id": 1, "delay_days": 0}, {"id": 22, "po_id": 1, "delay_days": 3}],
    })
    r = one(S.daily_buyer(L, AS_OF))
    assert r["po_count"] == 1 and r["total_spend"] == Decimal("100.0000") and r["rfq_count"] == 2
    assert r["on_time_delivery_rate"] == 0.5


def test_strict_rfq_without_quote_is_null(spark):
    from tidemart.plans import marts_strict as S
    L = make_landing(spark, {"fact_rfq_raw": [{"id": 1, "buyer_org_id": 5, "rfq_date": "2001-08-01 00:00:00"}]})
    assert one(S.daily_rfq_pipeline(L, AS_OF))["avg_response_hours"] is None


def test_strict_po_id_zero_does_not_match(spark):
    from tidemart.plans import marts_strict as S
    L = make_landing(spark, {
        "fact_rfq_quote_raw": [{"id": 1, "rfq_id": 9, "supplier_org_id": 7, "status": 6, "quoted_at": DAY}],
        "fact_delivery_raw": [{"id": 5, "po_id": 0, "delay_days": 4}],
    })
    r = one(S.daily_seller(L, AS_OF))
    assert r["quotes_submitted"] == 1 and r["po_fulfilled"] == 0 and r["on_time_delivery"] is None
    assert r["rfq_received"] == 0 and r["po_received"] == 0


def test_strict_key_drift_counts_once(spark):
    from tidemart.plans import marts_strict as S
    L = make_landing(spark, {"fact_po_raw": [
        {"id": 1, "buyer_org_id": 5, "status": 1, "total_amount": 100, "po_date": DAY, "_cdc_version": 1},
        {"id": 1, "buyer_org_id": 6, "status": 1, "total_amount": 100, "po_date": DAY, "_cdc_version": 2}]})
    assert [r["org_id"] for r in S.daily_buyer(L, AS_OF).collect()] == [6]
    assert M.daily_buyer(L, AS_OF).count() == 2


def test_top1_approx_sketch(spark):
    from tidemart.functions.exprs import top1_approx
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "x string")
    assert df.agg(top1_approx("x").alias("t")).first()["t"] == "b"


def test_public_api_semantics(spark):
    from tidemart import mart
    L = make_landing(spark, {"fact_po_raw": [
        {"id": 1, "buyer_org_id": 5, "status": 5, "total_amount": 100, "po_date": DAY}]})
    assert one(mart(L, "agg_daily_buyer", AS_OF))["rfq_count"] == 1
    assert one(mart(L, "agg_daily_buyer", AS_OF, plan="joins"))["rfq_count"] == 1
    assert one(mart(L, "agg_daily_buyer", AS_OF, semantics="strict"))["rfq_count"] == 0


def test_pretty_size(spark):
    from tidemart.functions.exprs import pretty_size
    df = spark.createDataFrame([(100,), (20480,), (15 * 1024 * 1024,)], "b long")
    assert [r[0] for r in df.select(pretty_size("b")).collect()] == ["100 bytes", "20 kB", "15 MB"]


def test_views_registered_for_sql(spark, landing_small):
    from tidemart.plans.views import register_views
    register_views(spark, landing_small)
    n = spark.sql("SELECT count(*) AS n FROM fact_po WHERE metric_date >= TIMESTAMP '2001-05-03'").first()["n"]
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    expected = orders.filter("o_orderdate >= TIMESTAMP '2001-05-03' AND o_orderkey % 97 <> 0").count()
    assert n == expected    # orders in the window, minus the soft-deleted ones


def test_engagement_approximate_option(spark, landing_small):
    from tidemart import mart
    as_of = dt.date(2024, 1, 30)
    exact = {(r["metric_date"], r["org_id"]): r for r in mart(landing_small, "agg_daily_engagement", as_of).collect()}
    approx = {(r["metric_date"], r["org_id"]): r
              for r in mart(landing_small, "agg_daily_engagement", as_of, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for k, e in exact.items():
        a = approx[k]
        assert abs(a["active_users"] - e["active_users"]) <= max(1, 0.05 * e["active_users"])
        assert a["page_views"] == e["page_views"]


def test_strict_engagement_accepts_approx(spark, landing_small):
    from tidemart import mart
    df = mart(landing_small, "agg_daily_engagement", dt.date(2024, 1, 30), semantics="strict", approx=True)
    assert df.count() == 397
