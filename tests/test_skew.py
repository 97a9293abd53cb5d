"""A hot key: one buyer owns a third of all POs and of all RFQs.

The literal joins for that buyer (POs x RFQs x movements on the buyer key)
would emit about 5e3 x 2.5e3 x 10 rows at sf0.01; the factorised plan
aggregates each side per key first and finishes in seconds. Its figures for the
hot buyer are checked against the fan-out formula computed from plain,
independent counts. (Making movements hot as well pushes the literal values past
Decimal(18,4); ANSI mode then raises instead of wrapping, as the DDL type does.)
"""

import datetime as dt
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mart_helpers import SF001

from tidemart.plans import marts as M
from tidemart.plans.landing import Landing

HOT = 2  # an organisation id of a customer: even
HOT_TABLES = {"fact_po_raw": "buyer_org_id", "fact_rfq_raw": "buyer_org_id"}


@pytest.fixture(scope="module")
def skewed(spark):
    base = Landing.materialized(spark, SF001)

    def raw(name):
        df = base.raw(name)
        col = HOT_TABLES.get(name)
        if col:
            df = df.withColumn(col, F.when(F.col("id") % 3 == 0, F.lit(HOT).cast("long")).otherwise(F.col(col)))
        return df
    return Landing(raw)


def test_hot_buyer_snapshot_is_linear_and_exact(spark, skewed):
    t0 = time.time()
    got = M.snapshot_org(skewed, dt.date(2001, 8, 1)).filter(F.col("org_id") == HOT).collect()
    assert time.time() - t0 < 120
    assert len(got) == 1
    row = got[0]

    po = skewed.live("fact_po_raw").filter("is_deleted = 0 AND buyer_org_id = 2")
    n_rfq = skewed.latest("fact_rfq_raw").filter("buyer_org_id = 2").count()
    open_rfq = skewed.latest("fact_rfq_raw").filter("buyer_org_id = 2 AND status NOT IN (3, 6, 12, 14)").count()
    mov = skewed.latest("fact_inventory_movement_raw").filter("org_id = 2")
    n_mov = mov.count()
    inv_value = mov.agg(F.sum(F.col("quantity") * F.col("unit_cost"))).first()[0]
    inv = skewed.latest("fact_invoice_raw").groupBy("po_id").agg(F.count(F.lit(1)).alias("ni"))
    per_po = po.join(inv, po.id == inv.po_id, "left").select(
        "status", "total_amount", F.greatest(F.coalesce("ni", F.lit(0)), F.lit(1)).alias("ni"))
    rows = per_po.collect()
    n_i_total = sum(r["ni"] for r in rows)
    open_n = sum(r["ni"] for r in rows if r["status"] in (1, 2, 4))
    open_value = sum((r["total_amount"] * r["ni"] for r in rows if r["status"] in (1, 2, 4)), Decimal(0))
    n_r, n_m = max(n_rfq, 1), max(n_mov, 1)

    assert n_rfq > 1000 and len(rows) > 3000          # a third of all POs and RFQs
    assert row["open_po_count"] == n_r * n_m * open_n
    assert row["open_po_value"] == (open_value * n_r * n_m).quantize(Decimal("0.0001"))
    assert row["open_rfq_count"] == (open_rfq if n_rfq else 1) * n_m * n_i_total
    assert row["inventory_value"] == (inv_value * n_r * n_i_total).quantize(Decimal("0.0001"))


def test_hot_buyer_daily_marts_finish(spark, skewed):
    t0 = time.time()
    for fn in (M.daily_buyer, M.daily_supplier_spend, M.daily_revenue_territory):
        fn(skewed, dt.date(2001, 8, 1)).write.format("noop").mode("overwrite").save()
    assert time.time() - t0 < 180


def test_one_very_large_buyer_does_not_fail_the_snapshot(spark):
    """110,000 RFQs x 110,000 POs of one buyer: weights of 1.21e10 joined rows."""
    from mart_helpers import make_landing
    n = 110_000
    empty = make_landing(spark, {})

    def grown(name, **cols):
        t = empty.raw(name)
        have = {"id": F.col("id") + 1, "_cdc_version": F.lit(1).cast("long"), **cols}
        base = spark.range(n)
        from tidemart.sources.schemas import type_default
        return base.select(*[have[f.name].cast(f.dataType).alias(f.name) if f.name in have
                             else type_default(f.dataType).alias(f.name) for f in t.schema.fields])
    po = grown("fact_po_raw", buyer_org_id=F.lit(2), status=F.lit(1), total_amount=F.lit(1), po_date=F.lit("2001-07-01"))
    rfq = grown("fact_rfq_raw", buyer_org_id=F.lit(2), status=F.lit(1), rfq_date=F.lit("2001-07-01"))
    mov = spark.range(1).select(*[
        {"id": F.lit(1), "org_id": F.lit(2), "quantity": F.lit("3"), "unit_cost": F.lit("0.0001")}.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        if f.name in ("id", "org_id", "quantity", "unit_cost") else __import__("tidemart.sources.schemas", fromlist=["x"]).type_default(f.dataType).alias(f.name)
        for f in empty.raw("fact_inventory_movement_raw").schema.fields])
    tables = {"fact_po_raw": po, "fact_rfq_raw": rfq, "fact_inventory_movement_raw": mov}
    land = Landing(lambda t: tables[t] if t in tables else empty.raw(t))
    row = M.snapshot_org(land, dt.date(2001, 8, 1)).first()
    assert row["open_po_count"] == n * n and row["open_rfq_count"] == n * n and row["pending_invoices"] == n * n
    assert row["open_po_value"] == Decimal(n * n) and row["inventory_value"] == Decimal(n * n) * Decimal("0.0003")
