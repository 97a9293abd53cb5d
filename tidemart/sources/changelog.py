"""A versioned change log of ``fact_po_raw`` and a ``po_details``-shaped source,
both derived from the ``orders`` input table (FIXTURES.md §2 and §4).

Change-log rules per order key k (versions resolve order, not arrival):

* version 1, live                               every order
* version 2, amount + 100, status 5             k % 3 == 0
* version 3, tombstone                          k % 11 == 0
* exact copy of version 1, one day later        k % 5 == 0
* version 2 with buyer_org_id + 1, two days later (key drift)
                                                k % 13 == 0 (only with ``drift``)

Arrival batch of a row: (k + version) % 4, so a tombstone can arrive before
the row it deletes.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.sources.fixtures import Fixtures
from tidemart.sources.schemas import D184, IS_DELETED, LANDING, SYNCED_AT, VERSION, ts_lit

# Arrival clock of the change log.
LOG_START = _dt.datetime(2024, 2, 1, 0, 0, 0)
BATCHES = 4


def _stamp(df: DataFrame, version: int, deleted: int, delay_days: int = 0) -> DataFrame:
    k = F.col("id") - 1
    batch = (k + F.lit(version)) % BATCHES
    synced = (ts_lit(LOG_START) + F.make_dt_interval(F.lit(delay_days), batch.cast("int")))
    return (df.withColumn(SYNCED_AT, synced.cast("timestamp"))
              .withColumn(IS_DELETED, F.lit(deleted))
              .withColumn(VERSION, F.lit(version).cast("long"))
              .withColumn("_batch", batch.cast("int")))


def po_change_log(fx: Fixtures | DataFrame, drift: bool = False, with_batch: bool = False) -> DataFrame:
    """The change log; ``fx`` is the fixture set or an already landed
    (single-version) ``fact_po_raw`` table to build it from."""
    po = fx if isinstance(fx, DataFrame) else fx.fact_po()
    base = po.drop(SYNCED_AT, IS_DELETED, VERSION)
    k = F.col("id") - 1
    v1 = _stamp(base, 1, 0)
    v2 = _stamp(base.filter(k % 3 == 0)
                .withColumn("total_amount", (F.col("total_amount") + F.lit(100)).cast(D184))
                .withColumn("status", F.lit(5)), 2, 0)
    v3 = _stamp(base.filter(k % 11 == 0), 3, 1)
    dup = _stamp(base.filter(k % 5 == 0), 1, 0, delay_days=1)
    parts = [v1, v2, v3, dup]
    if drift:
        parts.append(_stamp(base.filter(k % 13 == 0)
                            .withColumn("buyer_org_id", F.col("buyer_org_id") + 1), 2, 0, delay_days=2))
    log = parts[0]
    for p in parts[1:]:
        log = log.unionByName(p)
    cols = [f.name for f in LANDING["fact_po_raw"].schema.fields] + (["_batch"] if with_batch else [])
    return log.select(*cols)


def po_source(fx: Fixtures) -> DataFrame:
    """Rows shaped like the operational ``po_details`` table, with NULLs where
    that table allows them."""
    o = fx.src.read("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("int").alias("id"),
        F.concat(F.lit("PO-"), k.cast("string")).alias("po_number"),
        F.when(k % 6 != 0, F.col("o_orderstatus")).alias("source"),
        F.when(k % 3 != 0, F.lit("NEFT")).alias("payment_mode"),
        F.when(k % 7 != 0, F.to_date("o_orderdate")).alias("po_created_date"),
        F.date_add(F.to_date("o_orderdate"), 45).alias("expiry_date"),
        (k % 50).cast("int").alias("total_qty"),
        (F.col("o_custkey") + 1).cast("int").alias("buyer_org_id"),
        F.when(k % 17 != 0, (k % 100 + 1000000)).cast("int").alias("seller_org_id"),
        (F.lit(1) + k % 5).cast("int").alias("status"),
        F.when(k % 19 != 0, F.col("o_totalprice")).alias("total_amount"),
        F.col("o_orderdate").cast("timestamp").alias("created_date"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(1))).cast("timestamp").alias("updated_date"),
        F.when(k % 5 != 0, F.col("o_custkey") + 1).alias("buyer_user_id"),
        F.lit(None).cast("bigint").alias("seller_user_id"),
    )


def po_mapping() -> dict:
    """Our mapping of po_details onto fact_po_raw (FIXTURES.md §2); NULL -> default."""
    return {
        "id": F.col("id"),
        "buyer_org_id": F.col("buyer_org_id"),
        "supplier_org_id": F.col("seller_org_id"),
        "created_by": F.col("buyer_user_id"),
        "po_number": F.col("po_number"),
        "status": F.col("status"),
        "total_amount": F.col("total_amount"),
        "currency": F.lit("INR"),
        "po_date": F.coalesce(F.col("po_created_date").cast("timestamp"), F.col("created_date")),
        "expected_delivery": F.col("expiry_date"),
        "payment_terms": F.col("payment_mode"),
        "is_deleted": F.lit(0),
        "created_at": F.col("created_date"),
        "updated_at": F.col("updated_date"),
    }
