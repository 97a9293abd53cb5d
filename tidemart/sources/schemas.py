"""Landing (change-log) schemas, their dedup keys, typed defaults and mart schemas.

Every landing table holds every row version and ends with three metadata columns:
``_cdc_synced_at`` (arrival time), ``_cdc_is_deleted`` (1 = tombstone) and
``_cdc_version`` (source log position). An optional ``_cdc_seq`` (arrival order)
breaks the remaining ties.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

D184 = T.DecimalType(18, 4)
D84 = T.DecimalType(8, 4)

_TYPES = {
    "L": T.LongType(), "I": T.IntegerType(), "S": T.StringType(), "DBL": T.DoubleType(),
    "D184": D184, "D84": D84, "TS": T.TimestampType(), "DATE": T.DateType(),
}

SYNCED_AT, IS_DELETED, VERSION, SEQ = "_cdc_synced_at", "_cdc_is_deleted", "_cdc_version", "_cdc_seq"
META_FIELDS = [
    T.StructField(SYNCED_AT, T.TimestampType(), False),
    T.StructField(IS_DELETED, T.IntegerType(), False),
    T.StructField(VERSION, T.LongType(), False),
]


def _struct(spec: str) -> T.StructType:
    fields = []
    for item in spec.split(","):
        name, code = item.split()
        fields.append(T.StructField(name, _TYPES[code], False))
    return T.StructType(fields)


@dataclass(frozen=True)
class LandingTable:
    name: str
    data: T.StructType
    sort_key: tuple[str, ...]        # the dedup key the landing store sorts by
    primary_key: tuple[str, ...] = ("id",)
    month_of: str | None = None      # column whose month partitions the table

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.data.fields) + META_FIELDS)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.data.fields]

    def key(self, mode: str = "sort_key") -> tuple[str, ...]:
        if mode == "sort_key":
            return self.sort_key
        if mode == "primary_key":
            return self.primary_key
        raise ValueError(f"unknown key mode {mode!r}")


LANDING: dict[str, LandingTable] = {t.name: t for t in [
    LandingTable("dim_organization_raw", _struct(
        "id L, name S, business_type S, country S, state S, city_name S, industries S, "
        "annual_turnover S, no_of_employees S, business_size S, buyer_avg_rating DBL, "
        "supplier_avg_rating DBL, buyer_rating_count L, supplier_rating_count L, is_active I, "
        "is_blocked I, created_date TS, updated_date TS"), ("id",), month_of="created_date"),
    LandingTable("dim_user_raw", _struct(
        "id L, organization_id L, first_name S, last_name S, email S, user_type S, "
        "employee_type S, job_title S, is_active I, date_joined TS"), ("id",)),
    LandingTable("dim_category_raw", _struct(
        "id L, name S, code S, parent_id L, is_active I, created_at TS"), ("id",)),
    LandingTable("dim_product_raw", _struct(
        "id L, name S, code S, category_id L, brand S, uom S, hsn_code S, is_active I, "
        "created_at TS"), ("id",)),
    LandingTable("dim_warehouse_raw", _struct(
        "id L, org_id L, name S, city S, state S, pincode S, is_active I, created_at TS"), ("id",)),
    LandingTable("fact_po_raw", _struct(
        "id L, buyer_org_id L, supplier_org_id L, created_by L, po_number S, status I, "
        "total_amount D184, currency S, po_date TS, expected_delivery DATE, delivery_address S, "
        "payment_terms S, is_deleted I, created_at TS, updated_at TS"),
        ("buyer_org_id", "po_date", "id"), month_of="po_date"),
    LandingTable("fact_po_item_raw", _struct(
        "id L, po_id L, product_id L, category_id L, quantity D184, unit_price D184, "
        "total_price D184, uom S, hsn_code S, tax_rate D84, tax_amount D184, created_at TS"),
        ("po_id", "id"), month_of="created_at"),
    LandingTable("fact_rfq_raw", _struct(
        "id L, buyer_org_id L, category_id L, rfq_number S, status I, total_budget D184, "
        "currency S, rfq_date TS, close_date DATE, quote_count I, awarded_to L, created_at TS, "
        "updated_at TS"), ("buyer_org_id", "rfq_date", "id"), month_of="rfq_date"),
    LandingTable("fact_rfq_quote_raw", _struct(
        "id L, rfq_id L, supplier_org_id L, status I, quoted_amount D184, currency S, "
        "quoted_at TS, updated_at TS"), ("rfq_id", "id"), month_of="quoted_at"),
    LandingTable("fact_prf_raw", _struct(
        "id L, org_id L, requested_by L, category_id L, status I, estimated_value D184, "
        "currency S, request_date TS, required_by DATE, created_at TS"),
        ("org_id", "request_date", "id"), month_of="request_date"),
    LandingTable("fact_delivery_raw", _struct(
        "id L, po_id L, buyer_org_id L, supplier_org_id L, warehouse_id L, scheduled_date DATE, "
        "actual_date DATE, status S, delay_days I, created_at TS"),
        ("buyer_org_id", "scheduled_date", "id"), month_of="scheduled_date"),
    LandingTable("fact_invoice_raw", _struct(
        "id L, po_id L, buyer_org_id L, supplier_org_id L, invoice_number S, invoice_date DATE, "
        "due_date DATE, amount D184, tax_amount D184, paid_amount D184, status S, "
        "payment_date DATE, created_at TS"),
        ("buyer_org_id", "invoice_date", "id"), month_of="invoice_date"),
    LandingTable("fact_contract_raw", _struct(
        "id L, buyer_org_id L, supplier_org_id L, contract_number S, status S, total_value D184, "
        "currency S, start_date DATE, end_date DATE, signed_date DATE, created_at TS"),
        ("buyer_org_id", "start_date", "id"), month_of="start_date"),
    LandingTable("fact_inventory_movement_raw", _struct(
        "id L, org_id L, warehouse_id L, product_id L, movement_type S, quantity D184, "
        "unit_cost D184, movement_date DATE, po_id L, created_at TS"),
        ("org_id", "movement_date", "id"), month_of="movement_date"),
    LandingTable("fact_rating_raw", _struct(
        "id L, rater_org_id L, rated_org_id L, po_id L, rating DBL, comment S, rated_at TS"),
        ("rated_org_id", "rated_at", "id"), month_of="rated_at"),
    LandingTable("fact_engagement_raw", _struct(
        "id L, org_id L, user_id L, event_type S, page_url S, session_id S, duration_secs L, "
        "event_ts TS"), ("org_id", "event_ts", "id"), month_of="event_ts"),
]}


# The type default that a non-nullable column takes when the
# source has NULL or a left join finds no match (0, '', 1970-01-01).
EPOCH_DATE = _dt.date(1970, 1, 1)
EPOCH_TS = _dt.datetime(1970, 1, 1, 0, 0, 0)


def ts_lit(value) -> Column:
    """A timestamp literal read in the *session* time zone (a Python datetime
    literal would be converted with the Python process's local zone)."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    else:
        text = f"{value:%Y-%m-%d} 00:00:00"
    return F.lit(text).cast(T.TimestampType())


def type_default(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.DateType):
        return F.lit(EPOCH_DATE)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return ts_lit(EPOCH_TS).cast(dtype)
    if isinstance(dtype, T.DecimalType):
        return F.lit(Decimal(0)).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                          T.FloatType, T.DoubleType)):
        return F.lit(0).cast(dtype)
    raise TypeError(f"no default for {dtype}")


# Mart output schemas (grain columns first). Float32 rates are kept as DoubleType.
MART_KEYS: dict[str, tuple[str, ...]] = {
    "agg_daily_buyer": ("org_id", "metric_date"),
    "agg_daily_seller": ("org_id", "metric_date"),
    "agg_daily_category_spend": ("org_id", "category_id", "metric_date"),
    "agg_daily_supplier_spend": ("buyer_org_id", "supplier_org_id", "metric_date"),
    "agg_daily_rfq_pipeline": ("org_id", "metric_date"),
    "agg_daily_revenue_territory": ("org_id", "state", "city", "metric_date"),
    "agg_daily_engagement": ("org_id", "metric_date"),
    "snapshot_org_daily": ("org_id", "snapshot_date"),
    "snapshot_inventory_sku_daily": ("org_id", "warehouse_id", "product_id", "snapshot_date"),
}
MART_DATE_COL = {name: ("snapshot_date" if name.startswith("snapshot_") else "metric_date")
                 for name in MART_KEYS}
