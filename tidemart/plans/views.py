"""Clean views V1-V7: latest live version of a landing table, renamed columns.

Lazy DataFrames: Catalyst inlines them into whatever reads them, so column
pruning and key filters still reach the landing scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.plans.landing import Landing
from tidemart.plans.oracle_fixtures import latest_sql, with_fixtures
from tidemart.sources.schemas import LANDING, SYNCED_AT

# (landing table, [(source column, output name)], extra filter on live rows)
VIEW_SPECS: dict[str, tuple[str, list[tuple[str, str]], str | None]] = {
    "dim_organization": ("dim_organization_raw", [
        ("id", "org_id"), ("name", "company_name"), ("business_type", "business_type"),
        ("country", "country"), ("state", "state"), ("city_name", "city_name"),
        ("industries", "industries"), ("annual_turnover", "annual_turnover"),
        ("no_of_employees", "no_of_employees"), ("business_size", "business_size"),
        ("buyer_avg_rating", "buyer_avg_rating"), ("supplier_avg_rating", "supplier_avg_rating"),
        ("buyer_rating_count", "buyer_rating_count"), ("supplier_rating_count", "supplier_rating_count"),
        ("is_active", "is_active"), ("is_blocked", "is_blocked"),
        ("created_date", "created_date"), ("updated_date", "updated_date"),
        (SYNCED_AT, "_etl_loaded_at")], None),
    "dim_user": ("dim_user_raw", [
        ("id", "user_id"), ("organization_id", "org_id"), ("first_name", "first_name"),
        ("last_name", "last_name"), ("email", "email"), ("user_type", "user_type"),
        ("employee_type", "employee_type"), ("job_title", "job_title"), ("is_active", "is_active"),
        ("date_joined", "created_date"), (SYNCED_AT, "_etl_loaded_at")], None),
    "dim_category": ("dim_category_raw", [
        ("id", "category_id"), ("name", "category_name"), ("code", "category_code"),
        ("parent_id", "parent_id"), ("is_active", "is_active"), ("created_at", "created_at"),
        (SYNCED_AT, "_etl_loaded_at")], None),
    "dim_product": ("dim_product_raw", [
        ("id", "product_id"), ("name", "product_name"), ("code", "product_code"),
        ("category_id", "category_id"), ("brand", "brand"), ("uom", "uom"), ("hsn_code", "hsn_code"),
        ("is_active", "is_active"), ("created_at", "created_at"), (SYNCED_AT, "_etl_loaded_at")], None),
    "dim_warehouse": ("dim_warehouse_raw", [
        ("id", "warehouse_id"), ("org_id", "org_id"), ("name", "name"), ("city", "city"),
        ("state", "state"), ("pincode", "pincode"), ("is_active", "is_active"),
        ("created_at", "created_at"), (SYNCED_AT, "_etl_loaded_at")], None),
    "fact_po": ("fact_po_raw", [
        ("id", "po_id"), ("buyer_org_id", "buyer_org_id"), ("supplier_org_id", "supplier_org_id"),
        ("created_by", "created_by"), ("po_number", "po_number"), ("status", "status"),
        ("total_amount", "total_amount"), ("currency", "currency"), ("po_date", "metric_date"),
        ("expected_delivery", "expected_delivery"), ("delivery_address", "delivery_address"),
        ("payment_terms", "payment_terms"), ("created_at", "created_at"), ("updated_at", "updated_at"),
        (SYNCED_AT, "_etl_loaded_at")], "is_deleted = 0"),
    "fact_rfq": ("fact_rfq_raw", [
        ("id", "rfq_id"), ("buyer_org_id", "buyer_org_id"), ("category_id", "category_id"),
        ("rfq_number", "rfq_number"), ("status", "status"), ("total_budget", "total_budget"),
        ("currency", "currency"), ("rfq_date", "metric_date"), ("close_date", "close_date"),
        ("quote_count", "quote_count"), ("awarded_to", "awarded_to"), ("created_at", "created_at"),
        ("updated_at", "updated_at"), (SYNCED_AT, "_etl_loaded_at")], None),
}


def view(L: Landing, name: str) -> DataFrame:
    table, cols, extra = VIEW_SPECS[name]
    df = L.live(table)
    if extra:
        df = df.filter(F.expr(extra))
    return df.select(*[F.col(src).alias(dst) for src, dst in cols])


VIEWS = {name: (lambda L, _n=name: view(L, _n)) for name in VIEW_SPECS}


def register_views(spark, L: Landing) -> None:
    """Register every clean view as a temp view for ``spark.sql``."""
    for name in VIEW_SPECS:
        view(L, name).createOrReplaceTempView(name)


def view_sql(name: str) -> str:
    """Oracle SQL of a registered view query (portable output form)."""
    from tidemart.plans.cdc_queries import _dedup, _log_ctes
    table, cols, extra = VIEW_SPECS[name]
    types = {f.name: type(f.dataType).__name__ for f in LANDING[table].schema.fields}
    sel = []
    for src, dst in cols:
        tn = types[src]
        if tn == "DecimalType":
            sel.append(f"CAST({src} AS DOUBLE) AS {dst}")
        elif tn == "DateType":
            sel.append(f"strftime({src}, '%Y-%m-%d') AS {dst}")
        elif tn == "TimestampType":
            sel.append(f"strftime({src}, '%Y-%m-%d %H:%M:%S') AS {dst}")
        else:
            sel.append(f"{src} AS {dst}")
    where = f" WHERE {extra}" if extra else ""
    body = f"SELECT {', '.join(sel)} FROM live{where}"
    if name == "fact_po":
        key = ", ".join(LANDING[table].sort_key)
        return with_fixtures([table], body, _log_ctes() + [("live", _dedup("log", key, True))])
    return with_fixtures([table], body, [("live", latest_sql(table, True))])
