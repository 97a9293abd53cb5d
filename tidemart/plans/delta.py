"""R1 by changes: recompute only the mart groups that changes since the last refresh touch.

A mart row belongs to a group: a day and an organisation (snapshots: an organisation).
``touched_groups`` follows every changed row to the groups whose value it can alter:
the images of its key before and after the change, through every join of the mart.
``restricted`` cuts the landing tables down to what these groups read, always below the
dedup and only by whole keys; the mart's own plan then computes them, and they replace
their old rows in the months that hold them. All other rows and files stay.

Group sets are DataFrames; nothing but month numbers comes to the driver.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.exprs import day, yyyymm
from tidemart.operators.cdc import latest_version
from tidemart.plans import marts as M
from tidemart.plans import refresh as R
from tidemart.plans.landing import Landing
from tidemart.session import delete_path, scratch_path
from tidemart.sources.schemas import LANDING, MART_DATE_COL

DAY, ORG = "_day", "_org"


@dataclass(frozen=True)
class Own:
    """Rows of ``table`` belong to the group (day of ``ts``, ``org``)."""

    table: str
    ts: str | None
    org: str


@dataclass(frozen=True)
class Via:
    """Rows of ``table`` alter the groups of the rows of ``to`` whose ``key`` equals their ``fk``."""

    table: str
    fk: str
    to: Own
    key: str


@dataclass(frozen=True)
class Groups:
    """How changes reach a mart's groups (``paths``) and which tables its groups read (``reads``)."""

    org: str                                # output column of the group's organisation
    paths: tuple[Own | Via, ...]
    reads: tuple[Own, ...]
    refers: tuple[tuple[str, str, str], ...] = ()  # (table, column, table whose id it holds), read otherwise in full
    default_key: tuple[str, str] | None = None     # (table, column): value 0 meets every group without a match


_PO_BUYER, _PO_SUPPLIER = Own("fact_po_raw", "po_date", "buyer_org_id"), Own("fact_po_raw", "po_date", "supplier_org_id")
_RFQ, _QUOTE = Own("fact_rfq_raw", "rfq_date", "buyer_org_id"), Own("fact_rfq_quote_raw", "quoted_at", "supplier_org_id")
_RATER, _RATED = Own("fact_rating_raw", "rated_at", "rater_org_id"), Own("fact_rating_raw", "rated_at", "rated_org_id")
_EVENT = Own("fact_engagement_raw", "event_ts", "org_id")
_PO_ALL, _RFQ_ALL = Own("fact_po_raw", None, "buyer_org_id"), Own("fact_rfq_raw", None, "buyer_org_id")
_MOVES = Own("fact_inventory_movement_raw", None, "org_id")


def _of_po(table: str, po: Own) -> Via:
    return Via(table, "po_id", po, "id")


GROUPS: dict[str, Groups] = {
    "agg_daily_buyer": Groups("org_id", (
        _PO_BUYER, _RFQ, _of_po("fact_invoice_raw", _PO_BUYER), _of_po("fact_delivery_raw", _PO_BUYER), _RATER),
        (_PO_BUYER, _RFQ, _RATER)),
    "agg_daily_seller": Groups("org_id", (
        _QUOTE, Via("fact_rfq_raw", "id", _QUOTE, "rfq_id"), _PO_SUPPLIER, _of_po("fact_delivery_raw", _PO_SUPPLIER), _RATED),
        (_QUOTE, _PO_SUPPLIER, _RATED), default_key=("fact_delivery_raw", "po_id")),
    "agg_daily_category_spend": Groups("org_id", (_PO_BUYER, _of_po("fact_po_item_raw", _PO_BUYER)), (_PO_BUYER,)),
    "agg_daily_supplier_spend": Groups("buyer_org_id", (
        _PO_BUYER, _of_po("fact_delivery_raw", _PO_BUYER), _of_po("fact_invoice_raw", _PO_BUYER), _RATER), (_PO_BUYER, _RATER)),
    "agg_daily_rfq_pipeline": Groups("org_id", (_RFQ, Via("fact_rfq_quote_raw", "rfq_id", _RFQ, "id")), (_RFQ,)),
    "agg_daily_revenue_territory": Groups("org_id", (
        _PO_SUPPLIER, Via("dim_organization_raw", "id", _PO_SUPPLIER, "buyer_org_id")), (_PO_SUPPLIER,)),
    "agg_daily_engagement": Groups("org_id", (_EVENT,), (_EVENT,)),
    "snapshot_org_daily": Groups("org_id", (_PO_ALL, _RFQ_ALL, _of_po("fact_invoice_raw", _PO_ALL), _MOVES),
                                 (_PO_ALL, _RFQ_ALL, _MOVES), refers=(("fact_invoice_raw", "po_id", "fact_po_raw"),)),
    "snapshot_inventory_sku_daily": Groups("org_id", (_MOVES,), (_MOVES,)),
}


def with_changes(before: Landing, changes: dict[str, DataFrame]) -> Landing:
    """The landing tables with the changed rows appended."""
    def raw(name: str) -> DataFrame:
        old = before.raw(name)
        return old.unionByName(changes[name], allowMissingColumns=True) if name in changes else old
    return Landing(raw)


def _month_of(table: str, df: DataFrame) -> DataFrame:
    """``month`` of changed rows where the stored table has one, so that month pruning keeps them."""
    month = LANDING[table].month_of
    return df.withColumn("month", yyyymm(month)) if month else df


def _group(o: Own) -> list[Column]:
    return [*([day(o.ts).alias(DAY)] if o.ts else []), F.col(o.org).alias(ORG)]


def images(before: Landing, after: Landing, table: str, changed: DataFrame, columns: list[Column]) -> DataFrame:
    """Distinct values of ``columns`` in the newest version of every changed key, before and after the change."""
    key = LANDING[table].sort_key
    keys = changed.select(*key).distinct()
    rows = [latest_version(L.raw(table).join(keys, list(key), "left_semi"), key).select(*columns) for L in (before, after)]
    return rows[0].unionByName(rows[1]).distinct()


def touched_groups(before: Landing, after: Landing, changes: dict[str, DataFrame], name: str, start: _dt.date | None) -> DataFrame:
    """_day and _org (snapshots: _org) of every group that a changed row can alter, from ``start`` on."""
    spec, found = GROUPS[name], []
    for p in spec.paths:
        if p.table not in changes:
            continue
        if isinstance(p, Own):
            found.append(images(before, after, p.table, changes[p.table], _group(p)))
            continue
        fk = images(before, after, p.table, changes[p.table], [F.col(p.fk).alias(p.key)]).distinct()
        # every version of the rows referred to: a superset, and no dedup of the whole table
        to = after.raw(p.to.table)
        if p.to.ts and start is not None:
            to = _from(to, p.to, start)
        found.append(to.join(fk, p.key, "left_semi").select(*_group(p.to)))
        if spec.default_key == (p.table, p.fk):
            # a group without a match meets the rows of key 0: if one changed, every group is computed again
            zero = fk.where(F.col(p.key) == 0).select(F.lit(1).alias("_zero")).limit(1)
            own = spec.paths[0]
            rows = after.raw(own.table)
            rows = _from(rows, own, start) if start is not None else rows
            found.append(rows.withColumn("_zero", F.lit(1)).join(zero, "_zero", "left_semi").select(*_group(own)))
    if not found:
        return after.raw(spec.paths[0].table).select(*_group(spec.paths[0])).where("false")
    groups = reduce(DataFrame.unionByName, found).distinct()
    return groups.where(F.col(DAY) >= F.lit(start)) if start is not None and DAY in groups.columns else groups


def _from(df: DataFrame, o: Own, start: _dt.date) -> DataFrame:
    if "month" in df.columns and LANDING[o.table].month_of == o.ts:
        df = df.where(F.col("month") >= start.year * 100 + start.month)
    return df.where(F.to_date(o.ts) >= F.lit(start))


def restricted(after: Landing, name: str, groups: DataFrame, start: _dt.date | None) -> Landing:
    """The landing tables as far as these groups read them.

    A table is cut to the keys of which some version lies in a group: whole keys only, so the
    dedup that follows returns the same version as on the whole table.
    """
    spec = GROUPS[name]
    own = {o.table: o for o in spec.reads}
    refers = {t: (column, to) for t, column, to in spec.refers}
    cut: dict[str, DataFrame] = {}

    def rows_of(table: str) -> DataFrame:
        df, t = after.raw(table), LANDING[table]
        if table in own:
            o = own[table]
            if o.ts and o.ts in t.sort_key and start is not None:
                df = _from(df, o, start)
            wanted = [day(o.ts) == F.col(DAY)] if o.ts else []
            wanted.append(F.col(o.org) == F.col(ORG))
            in_group = df.join(groups, reduce(Column.__and__, wanted), "left_semi")
            if {o.org, *([o.ts] if o.ts else [])} <= set(t.sort_key):
                return in_group
            return df.join(in_group.select(*t.sort_key).distinct(), list(t.sort_key), "left_semi")
        if table in refers:
            column, to = refers[table]
            ids = raw(to).select(F.col("id").alias(column)).distinct()
            keys = df.join(ids, column, "left_semi").select(*t.sort_key).distinct()
            return df.join(keys, list(t.sort_key), "left_semi")
        return df

    def raw(table: str) -> DataFrame:
        if table not in cut:
            cut[table] = rows_of(table)
        return cut[table]
    return Landing(raw)


def refresh_changed(spark: SparkSession, before: Landing, changes: dict[str, DataFrame], name: str, as_of: _dt.date,
                    root: str, last: _dt.date, loaded_at: _dt.datetime | None = None) -> tuple[int, int]:
    """Bring a mart table that was refreshed on ``last`` from ``before`` up to ``as_of`` with the changed rows.

    ``before`` holds what the last refresh has read, ``changes`` the landing rows since then by table.
    Equal to ``refresh_mart`` over both, but only touched groups are computed and
    only their months are written. A snapshot of a later day starts from the last day's rows. Returns
    the number of touched groups and of rows written for them.
    """
    if as_of < last:
        raise ValueError(f"{name}: as_of {as_of} is before the last refresh {last}")
    path, date_col, spec = f"{root.rstrip('/')}/{name}", MART_DATE_COL[name], GROUPS[name]
    snapshot = name.startswith("snapshot_")
    start = None if snapshot else as_of - _dt.timedelta(days=M.WINDOW_DAYS)
    changes = {t: _month_of(t, df) if "month" in before.raw(t).columns else df for t, df in changes.items()}
    after = with_changes(before, changes)
    staging = scratch_path(spark, "staging", f"{name}-{uuid.uuid4().hex}")
    touched = touched_groups(before, after, changes, name, start)
    touched.write.mode("overwrite").parquet(f"{staging}/groups")
    groups = spark.read.schema(touched.schema).parquet(f"{staging}/groups")
    n_groups = groups.count()
    if not n_groups and (not snapshot or as_of == last):
        delete_path(spark, staging)
        return 0, 0
    mine = [F.col(spec.org) == F.col(ORG), *([] if snapshot else [F.col(date_col) == F.col(DAY)])]
    mine = reduce(Column.__and__, mine)
    result = R.mart_result(restricted(after, name, groups, start), name, as_of, loaded_at).join(groups, mine, "left_semi")
    result.write.mode("overwrite").parquet(f"{staging}/rows")
    new = spark.read.schema(result.schema).parquet(f"{staging}/rows")
    n_rows = new.count()
    stored = spark.read.schema(result.schema).parquet(path)
    if snapshot:
        affected = [as_of.year * 100 + as_of.month]
        rest = stored.where(F.col(date_col) == F.lit(last)).join(groups, mine, "left_anti").withColumn(
            date_col, F.lit(as_of)).withColumn("month", F.lit(affected[0])).select(*result.columns)
        others = stored.where(F.col("month").isin(affected) & (F.col(date_col) != F.lit(as_of)))
        merged = others.unionByName(rest).unionByName(new)
    else:
        affected = sorted(r[0] for r in groups.select(yyyymm(DAY)).distinct().collect())
        merged = stored.where(F.col("month").isin(affected)).join(groups, mine, "left_anti").select(*result.columns).unionByName(new)
    R.replace_months(spark, path, merged, affected)
    delete_path(spark, staging)
    return n_groups, n_rows
