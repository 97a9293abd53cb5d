"""The nine procurement marts over landing tables.

Semantics are the reference's ("literal"): the driving table is read as
latest-live, the joined tables as latest version (tombstones included), every
LEFT JOIN fills unmatched columns with type defaults, and aggregates count
joined rows, so chained many-sides multiply.

Two plans give the same rows:

* ``plan="joins"``: the chained default-filled LEFT JOINs, then GROUP BY.
  Joined rows grow as the product of the many-sides per key.
* ``plan="factorised"`` (default): every many-side is first aggregated on its
  own join key (partial aggregation, so a hot key collapses map-side), the
  joins are one row per key, and each metric is rebuilt as a product of per-side
  sums. Work is linear in the inputs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.exprs import (
    avg_if, count_if, count_rows, day, dec_avg, dec_div, greatest0, hour_boundaries, rate_if,
    ratio, shifted, sum_if, sum_or_zero, top1, top1_approx, uniq, uniq_approx,
)
from tidemart.operators.joins import left_join_default, prefixed
from tidemart.plans.landing import Landing
from tidemart.sources.schemas import D184, ts_lit

WINDOW_DAYS = 90
# Status codes used as predicates by the marts.
PO_APPROVED = 5
PO_PENDING = [1, 2, 4]
PO_CANCELLED = 3
RFQ_AWARDED = 14
RFQ_CLOSED = [12, 3]
RFQ_NOT_OPEN_PIPELINE = [14, 12, 3]
RFQ_NOT_OPEN_SNAPSHOT = [3, 6, 12, 14]
QUOTE_WON = [6, 11, 14]
INVOICE_SETTLED = ["paid", "cancelled"]

DEC_WIDE = T.DecimalType(38, 4)
INT38 = T.DecimalType(38, 0)


def window_start(as_of: _dt.date) -> _dt.date:
    return as_of - _dt.timedelta(days=WINDOW_DAYS)


def in_window(ts, as_of: _dt.date) -> Column:
    """``toDate(ts) >= today() - 90`` with ``today()`` fixed to ``as_of``.

    Written as ``ts >= <start> 00:00:00`` (same rows in the session time
    zone): a bare column comparison reaches the Parquet scan as a pushed
    filter, and below a dedup keyed on ``ts`` Catalyst moves it under the window.
    """
    start = window_start(as_of)
    return F.col(ts) >= ts_lit(start)


def _at_least_one(c: Column) -> Column:
    return F.greatest(F.coalesce(c, F.lit(0)), F.lit(1)).cast("long")


def _dec(c: Column) -> Column:
    """A value in the published Decimal(18,4); NULL in the one group whose value
    does not fit (``refresh.run`` names such groups), so others still load."""
    return c.try_cast(D184)


def _times(first: Column, *rest: Column) -> Column:
    """Product of weights in up to 38 digits (fan-out products leave BIGINT long
    before they leave that; beyond, NULL)."""
    out = first
    for c in rest:
        out = F.try_multiply(out, c.cast(INT38))
    return out


def _count(*weights: Column) -> Column:
    """A joined-row count as a product of weights, published as BIGINT (NULL in a
    group whose count does not fit)."""
    return _times(weights[0].cast(INT38), *weights[1:]).try_cast("long")


def _hour_index(ts) -> Column:
    """Whole hours since the epoch of the hour that contains ``ts``."""
    return F.floor(F.unix_seconds(F.date_trunc("hour", F.col(ts) if isinstance(ts, str) else ts)) / 3600).cast("long")


def _po_scope(L: Landing, as_of: _dt.date | None) -> DataFrame:
    if as_of is None:
        return L.live("fact_po_raw").filter(F.col("is_deleted") == 0)
    p = L.live("fact_po_raw", since=window_start(as_of)).filter(F.col("is_deleted") == 0)
    return p.filter(in_window("po_date", as_of))


def _po_ids(L: Landing, as_of: _dt.date) -> DataFrame:
    """po_id of every raw PO row of the window: a superset of the window's POs that
    costs a scan of two columns instead of a second dedup."""
    return L.raw_since("fact_po_raw", window_start(as_of)).select(F.col("id").alias("po_id"))


# ---------------------------------------------------------------------------
# M1 agg_daily_buyer
# ---------------------------------------------------------------------------

# The published columns of each mart (M1_COLS ... M8_COLS).
M1_COLS = ["metric_date", "org_id", "po_count", "po_approved_count", "po_pending_count",
           "po_cancelled_count", "total_spend", "approved_spend", "rfq_count", "rfq_awarded_count",
           "quote_received", "avg_quote_per_rfq", "invoice_count", "invoice_paid", "invoice_overdue",
           "on_time_delivery_rate", "avg_supplier_rating"]


def daily_buyer(L: Landing, as_of: _dt.date, plan: str = "factorised") -> DataFrame:
    p = _po_scope(L, as_of)
    start = window_start(as_of)
    # RFQs and ratings join on their own key date = the PO day (>= start): the
    # range goes below their dedup; invoices and deliveries join on po_id, so only
    # those that refer to a PO of the window are deduplicated
    r = L.latest("fact_rfq_raw", since=start)
    po_ids = _po_ids(L, as_of)
    i = L.latest_referring("fact_invoice_raw", po_ids)
    d = L.latest_referring("fact_delivery_raw", po_ids)
    rt = L.latest("fact_rating_raw", since=start)
    if plan == "joins":
        j = prefixed(p.select("id", "buyer_org_id", "po_date", "status", "total_amount"), "p_")
        j = left_join_default(j, prefixed(r.select("id", "buyer_org_id", "rfq_date", "status", "quote_count"), "r_"),
                              (F.col("r_buyer_org_id") == F.col("p_buyer_org_id")) & (day("r_rfq_date") == day("p_po_date")))
        j = left_join_default(j, prefixed(i.select("id", "po_id", "status"), "i_"), F.col("i_po_id") == F.col("p_id"))
        j = left_join_default(j, prefixed(d.select("po_id", "delay_days"), "d_"), F.col("d_po_id") == F.col("p_id"))
        j = left_join_default(j, prefixed(rt.select("rater_org_id", "rated_at", "rating"), "rt_"),
                              (F.col("rt_rater_org_id") == F.col("p_buyer_org_id")) & (day("rt_rated_at") == day("p_po_date")))
        st = F.col("p_status")
        out = j.groupBy(day("p_po_date").alias("metric_date"), F.col("p_buyer_org_id").alias("org_id")).agg(
            count_rows().alias("po_count"),
            count_if(st == PO_APPROVED).alias("po_approved_count"),
            count_if(st.isin(PO_PENDING)).alias("po_pending_count"),
            count_if(st == PO_CANCELLED).alias("po_cancelled_count"),
            _dec(sum_or_zero("p_total_amount")).alias("total_spend"),
            _dec(sum_if("p_total_amount", st == PO_APPROVED, D184)).alias("approved_spend"),
            uniq("r_id").alias("rfq_count"),
            count_if(F.col("r_status") == RFQ_AWARDED).alias("rfq_awarded_count"),
            sum_or_zero("r_quote_count").cast("long").alias("quote_received"),
            avg_if("r_quote_count", F.col("r_quote_count") > 0).alias("avg_quote_per_rfq"),
            uniq("i_id").alias("invoice_count"),
            count_if(F.col("i_status") == "paid").alias("invoice_paid"),
            count_if(F.col("i_status") == "overdue").alias("invoice_overdue"),
            rate_if(F.col("d_delay_days") <= 0).alias("on_time_delivery_rate"),
            F.avg("rt_rating").alias("avg_supplier_rating"),
        )
        return out.select(*M1_COLS)

    # factorised
    inv = i.groupBy("po_id").agg(count_rows().alias("ni"),
                                 count_if(F.col("status") == "paid").alias("paid"),
                                 count_if(F.col("status") == "overdue").alias("overdue"))
    dlv = d.groupBy("po_id").agg(count_rows().alias("nd"), count_if(F.col("delay_days") <= 0).alias("ot"))
    pp = (p.select("id", "buyer_org_id", "po_date", "status", "total_amount")
          .join(inv, p.id == inv.po_id, "left").drop("po_id")
          .join(dlv, p.id == dlv.po_id, "left").drop("po_id"))
    n_i, n_d = _at_least_one(F.col("ni")), _at_least_one(F.col("nd"))
    w = n_i * n_d
    st = F.col("status")
    ot_p = F.when(F.col("nd") > 0, F.col("ot")).otherwise(F.lit(1))
    per_g = pp.groupBy(day("po_date").alias("metric_date"), F.col("buyer_org_id").alias("org_id")).agg(
        F.sum(w).alias("W"),
        F.sum(F.when(st == PO_APPROVED, w).otherwise(0)).alias("W_appr"),
        F.sum(F.when(st.isin(PO_PENDING), w).otherwise(0)).alias("W_pend"),
        F.sum(F.when(st == PO_CANCELLED, w).otherwise(0)).alias("W_canc"),
        F.sum(F.col("total_amount") * w).alias("S"),
        sum_or_zero(F.when(st == PO_APPROVED, F.col("total_amount") * w), DEC_WIDE).alias("S_appr"),
        F.sum(F.coalesce(F.col("paid"), F.lit(0)) * n_d).alias("PAID"),
        F.sum(F.coalesce(F.col("overdue"), F.lit(0)) * n_d).alias("OVER"),
        F.sum(n_i * ot_p).alias("OT"),
        F.max(F.col("ni").isNull()).alias("po_without_invoice"),
    )
    # distinct invoice ids per group (not multiplied), plus the default id 0
    # when some PO of the group has no invoice. An inner join, so AQE can split
    # a skewed side (one PO with a huge number of invoices) either way.
    inv_ids = i.select(F.col("po_id").alias("i_po"), F.col("id").alias("iid")).distinct()
    uniq_inv = (p.select("id", "buyer_org_id", "po_date").join(inv_ids, p.id == inv_ids.i_po, "inner")
                .groupBy(day("po_date").alias("metric_date"), F.col("buyer_org_id").alias("org_id"))
                .agg(uniq("iid").alias("inv_ids"), F.max(F.col("iid") == 0).alias("has_id0")))
    rq = F.col("quote_count")
    rfq = r.groupBy(day("rfq_date").alias("metric_date"), F.col("buyer_org_id").alias("org_id")).agg(
        count_rows().alias("nr"), uniq("id").alias("r_ids"),
        count_if(F.col("status") == RFQ_AWARDED).alias("r_awarded"),
        F.sum(rq).alias("r_quotes"), avg_if(rq, rq > 0).alias("avg_quote_per_rfq"))
    rat = rt.groupBy(day("rated_at").alias("metric_date"), F.col("rater_org_id").alias("org_id")).agg(
        count_rows().alias("nt"), F.sum("rating").alias("st"))
    keys = ["metric_date", "org_id"]
    g = per_g.join(uniq_inv, keys, "left").join(rfq, keys, "left").join(rat, keys, "left")
    n_R, n_T = _at_least_one(F.col("nr")), _at_least_one(F.col("nt"))
    W = F.col("W")
    return g.select(
        "metric_date", "org_id",
        _count(n_R, n_T, W).alias("po_count"),
        _count(n_R, n_T, F.col("W_appr")).alias("po_approved_count"),
        _count(n_R, n_T, F.col("W_pend")).alias("po_pending_count"),
        _count(n_R, n_T, F.col("W_canc")).alias("po_cancelled_count"),
        _dec(_times(F.col("S"), n_R, n_T)).alias("total_spend"),
        _dec(_times(F.col("S_appr"), n_R, n_T)).alias("approved_spend"),
        F.when(F.col("nr") > 0, F.col("r_ids")).otherwise(F.lit(1)).alias("rfq_count"),
        _count(F.coalesce(F.col("r_awarded"), F.lit(0)), n_T, W).alias("rfq_awarded_count"),
        _count(F.coalesce(F.col("r_quotes"), F.lit(0)), n_T, W).alias("quote_received"),
        F.col("avg_quote_per_rfq"),
        (F.coalesce(F.col("inv_ids"), F.lit(0))
         + F.when(F.col("po_without_invoice") & ~F.coalesce(F.col("has_id0"), F.lit(False)), 1).otherwise(0)
         ).alias("invoice_count"),
        _count(n_R, n_T, F.col("PAID")).alias("invoice_paid"),
        _count(n_R, n_T, F.col("OVER")).alias("invoice_overdue"),
        (F.col("OT").cast("double") / W.cast("double")).alias("on_time_delivery_rate"),
        (F.coalesce(F.col("st"), F.lit(0.0)) / n_T.cast("double")).alias("avg_supplier_rating"),
    )


# ---------------------------------------------------------------------------
# M2 agg_daily_seller
# ---------------------------------------------------------------------------

M2_COLS = ["metric_date", "org_id", "rfq_received", "quotes_submitted", "quotes_won", "win_rate",
           "revenue", "avg_deal_size", "po_received", "po_fulfilled", "on_time_delivery",
           "avg_buyer_rating"]


def daily_seller(L: Landing, as_of: _dt.date, plan: str = "factorised") -> DataFrame:
    start = window_start(as_of)
    q = L.live("fact_rfq_quote_raw", since=start).filter(in_window("quoted_at", as_of))
    # only RFQs that a quote of the window refers to can match (id is in the RFQ
    # key). The key set comes from the raw quote rows of the window — a superset
    # of what the deduplicated quotes refer to, so the restriction stays exact
    # and costs a scan + distinct instead of a second dedup of the quotes
    quoted = L.raw_since("fact_rfq_quote_raw", start)
    r = L.latest_for_keys("fact_rfq_raw", quoted.select(F.col("rfq_id").alias("id")))
    # POs and ratings join on their key date = the quote day (>= start)
    p = L.latest("fact_po_raw", since=start)
    # deliveries of these POs, and of the default PO id 0
    po_ids = _po_ids(L, as_of)
    zero = L.raw("fact_delivery_raw").filter(F.col("po_id") == 0).select("po_id")
    d = L.latest_referring("fact_delivery_raw", po_ids.unionByName(zero))
    rt = L.latest("fact_rating_raw", since=start)
    won = F.col("q_status").isin(QUOTE_WON)
    if plan == "joins":
        j = prefixed(q.select("rfq_id", "supplier_org_id", "status", "quoted_at"), "q_")
        j = left_join_default(j, prefixed(r.select("id"), "r_"), F.col("r_id") == F.col("q_rfq_id"))
        j = left_join_default(j, prefixed(p.select("id", "supplier_org_id", "po_date", "total_amount"), "p_"),
                              (F.col("p_supplier_org_id") == F.col("q_supplier_org_id")) & (day("p_po_date") == day("q_quoted_at")))
        j = left_join_default(j, prefixed(d.select("po_id", "delay_days"), "d_"), F.col("d_po_id") == F.col("p_id"))
        j = left_join_default(j, prefixed(rt.select("rated_org_id", "rated_at", "rating"), "rt_"),
                              (F.col("rt_rated_org_id") == F.col("q_supplier_org_id")) & (day("rt_rated_at") == day("q_quoted_at")))
        out = j.groupBy(day("q_quoted_at").alias("metric_date"), F.col("q_supplier_org_id").alias("org_id")).agg(
            uniq("r_id").alias("rfq_received"),
            count_rows().alias("quotes_submitted"),
            count_if(won).alias("quotes_won"),
            ratio(count_if(won), count_rows()).alias("win_rate"),
            _dec(sum_or_zero("p_total_amount")).alias("revenue"),
            dec_avg("p_total_amount").alias("avg_deal_size"),
            uniq("p_id").alias("po_received"),
            count_if(F.col("d_delay_days") <= 0).alias("po_fulfilled"),
            rate_if(F.col("d_delay_days") <= 0).alias("on_time_delivery"),
            F.avg("rt_rating").alias("avg_buyer_rating"),
        )
        return out.select(*M2_COLS)

    # quote side: n_r(q) = max(1, rfq rows with that id)
    rn = r.groupBy(F.col("id").alias("r_id")).agg(count_rows().alias("nr"))
    qq = prefixed(q.select("rfq_id", "supplier_org_id", "status", "quoted_at"), "q_").join(
        rn, F.col("q_rfq_id") == F.col("r_id"), "left")
    n_r = _at_least_one(F.col("nr"))
    q_g = qq.groupBy(day("q_quoted_at").alias("metric_date"), F.col("q_supplier_org_id").alias("org_id")).agg(
        F.sum(n_r).alias("Q"), F.sum(F.when(won, n_r).otherwise(0)).alias("WON"),
        uniq(F.when(F.col("nr") > 0, F.col("q_rfq_id")).otherwise(F.lit(0))).alias("rfq_received"))
    # PO side per (supplier, day): deliveries per PO id, defaults for POs without any
    dlv = d.groupBy("po_id").agg(count_rows().alias("nd"), count_if(F.col("delay_days") <= 0).alias("ot"))
    pp = p.select("id", "supplier_org_id", "po_date", "total_amount").join(dlv, p.id == dlv.po_id, "left")
    n_d = _at_least_one(F.col("nd"))
    ot_p = F.when(F.col("nd") > 0, F.col("ot")).otherwise(F.lit(1))
    p_g = pp.groupBy(day("po_date").alias("metric_date"), F.col("supplier_org_id").alias("org_id")).agg(
        F.sum(n_d).alias("NP"), F.sum(F.col("total_amount") * n_d).alias("SA"),
        F.sum(ot_p).alias("OT"), uniq("id").alias("p_ids"))
    # a quote group without a PO joins the default PO id 0, which still meets
    # deliveries whose po_id is 0: at most one aggregated row, broadcast
    d0 = F.broadcast(dlv.filter(F.col("po_id") == 0).select(
        F.col("po_id").alias("d0_po"), F.col("nd").alias("nd0"), F.col("ot").alias("ot0")))
    rat = rt.groupBy(day("rated_at").alias("metric_date"), F.col("rated_org_id").alias("org_id")).agg(
        count_rows().alias("nt"), F.sum("rating").alias("st"))
    keys = ["metric_date", "org_id"]
    g = (q_g.join(p_g, keys, "left")
            .withColumn("dflt_po", F.when(F.col("NP").isNull(), F.lit(0).cast("long")))
            .join(d0, F.col("dflt_po") == F.col("d0_po"), "left")
            .join(rat, keys, "left"))
    has_p = F.col("NP").isNotNull()
    NP = F.when(has_p, F.col("NP")).otherwise(_at_least_one(F.col("nd0")))
    OT = F.when(has_p, F.col("OT")).otherwise(F.when(F.col("nd0") > 0, F.col("ot0")).otherwise(F.lit(1)))
    SA = F.when(has_p, F.col("SA")).otherwise(F.lit(0).cast(D184))
    n_T = _at_least_one(F.col("nt"))
    Q = F.col("Q")
    submitted = _count(Q, NP, n_T)
    won_n = _count(F.col("WON"), NP, n_T)
    return g.select(
        "metric_date", "org_id", "rfq_received",
        submitted.alias("quotes_submitted"),
        won_n.alias("quotes_won"),
        ratio(F.col("WON"), Q).alias("win_rate"),
        _dec(_times(SA, Q, n_T)).alias("revenue"),
        dec_div(SA, NP).alias("avg_deal_size"),
        F.when(has_p, F.col("p_ids")).otherwise(F.lit(1).cast("long")).alias("po_received"),
        _count(Q, n_T, OT).alias("po_fulfilled"),
        (OT.cast("double") / NP.cast("double")).alias("on_time_delivery"),
        (F.coalesce(F.col("st"), F.lit(0.0)) / n_T.cast("double")).alias("avg_buyer_rating"),
    )


# ---------------------------------------------------------------------------
# M3 agg_daily_category_spend (inner join, no fan-out)
# ---------------------------------------------------------------------------

def daily_category_spend(L: Landing, as_of: _dt.date) -> DataFrame:
    # po_id is in the item key: only items of the window's POs are deduplicated
    items = L.latest_for_keys("fact_po_item_raw", _po_ids(L, as_of), live=True)
    p = _po_scope(L, as_of).select("id", "buyer_org_id", "po_date")
    # pre-aggregate items per (PO, category) before the join shuffle
    pre = items.groupBy("po_id", "category_id").agg(
        count_rows().alias("n"), F.sum("total_price").alias("tp"), F.sum("unit_price").alias("up"))
    j = pre.join(p, pre.po_id == p.id, "inner")
    out = j.groupBy(day("po_date").alias("metric_date"), F.col("buyer_org_id").alias("org_id"), "category_id").agg(
        F.sum("n").alias("po_count"), F.sum("tp").alias("tp"), F.sum("up").alias("up"))
    return out.select("metric_date", "org_id", "category_id", "po_count",
                      _dec(F.col("tp")).alias("total_spend"),
                      dec_div(F.col("up"), F.col("po_count")).alias("avg_unit_price"))


# ---------------------------------------------------------------------------
# M4 agg_daily_supplier_spend
# ---------------------------------------------------------------------------

M4_COLS = ["metric_date", "buyer_org_id", "supplier_org_id", "po_count", "total_spend",
           "avg_delivery_days", "on_time_rate", "rating", "invoice_overdue_amt"]


def daily_supplier_spend(L: Landing, as_of: _dt.date, plan: str = "factorised") -> DataFrame:
    p = _po_scope(L, as_of)
    po_ids = _po_ids(L, as_of)
    d = L.latest_referring("fact_delivery_raw", po_ids)
    i = L.latest_referring("fact_invoice_raw", po_ids)
    rt = L.latest("fact_rating_raw", since=window_start(as_of))
    if plan == "joins":
        j = prefixed(p.select("id", "buyer_org_id", "supplier_org_id", "po_date", "total_amount"), "p_")
        j = left_join_default(j, prefixed(d.select("po_id", "delay_days"), "d_"), F.col("d_po_id") == F.col("p_id"))
        j = left_join_default(j, prefixed(i.select("po_id", "amount", "paid_amount", "status"), "i_"), F.col("i_po_id") == F.col("p_id"))
        j = left_join_default(j, prefixed(rt.select("rater_org_id", "rated_org_id", "rated_at", "rating"), "rt_"),
                              (F.col("rt_rater_org_id") == F.col("p_buyer_org_id"))
                              & (F.col("rt_rated_org_id") == F.col("p_supplier_org_id"))
                              & (day("rt_rated_at") == day("p_po_date")))
        dd = F.col("d_delay_days")
        out = j.groupBy(day("p_po_date").alias("metric_date"), F.col("p_buyer_org_id").alias("buyer_org_id"),
                        F.col("p_supplier_org_id").alias("supplier_org_id")).agg(
            count_rows().alias("po_count"),
            _dec(sum_or_zero("p_total_amount")).alias("total_spend"),
            F.avg(dd + greatest0(dd)).alias("avg_delivery_days"),
            rate_if(dd <= 0).alias("on_time_rate"),
            F.avg("rt_rating").alias("rating"),
            _dec(sum_if(F.col("i_amount") - F.col("i_paid_amount"), F.col("i_status") == "overdue", D184))
            .alias("invoice_overdue_amt"),
        )
        return out.select(*M4_COLS)

    dd = F.col("delay_days")
    dlv = d.groupBy("po_id").agg(count_rows().alias("nd"), count_if(dd <= 0).alias("ot"),
                                 F.sum(dd + greatest0(dd)).alias("fd"))
    inv = i.groupBy("po_id").agg(count_rows().alias("ni"), sum_if(
        F.col("amount") - F.col("paid_amount"), F.col("status") == "overdue", DEC_WIDE).alias("od"))
    pp = (p.select("id", "buyer_org_id", "supplier_org_id", "po_date", "total_amount")
          .join(dlv, p.id == dlv.po_id, "left").drop("po_id")
          .join(inv, p.id == inv.po_id, "left").drop("po_id"))
    n_d, n_i = _at_least_one(F.col("nd")), _at_least_one(F.col("ni"))
    ot_p = F.when(F.col("nd") > 0, F.col("ot")).otherwise(F.lit(1))
    keys = ["metric_date", "buyer_org_id", "supplier_org_id"]
    per_g = pp.groupBy(day("po_date").alias("metric_date"), "buyer_org_id", "supplier_org_id").agg(
        F.sum(n_d * n_i).alias("W"), F.sum(F.col("total_amount") * (n_d * n_i)).alias("S"),
        F.sum(n_i * F.coalesce(F.col("fd"), F.lit(0))).alias("FD"), F.sum(n_i * ot_p).alias("OT"),
        sum_or_zero(F.coalesce(F.col("od"), F.lit(0)) * n_d, DEC_WIDE).alias("OD"))
    rat = rt.groupBy(day("rated_at").alias("metric_date"), F.col("rater_org_id").alias("buyer_org_id"),
                     F.col("rated_org_id").alias("supplier_org_id")).agg(
        count_rows().alias("nt"), F.sum("rating").alias("st"))
    g = per_g.join(rat, keys, "left")
    n_T = _at_least_one(F.col("nt"))
    W = F.col("W").cast("double")
    return g.select(
        *keys,
        _count(n_T, F.col("W")).alias("po_count"),
        _dec(_times(F.col("S"), n_T)).alias("total_spend"),
        (F.col("FD").cast("double") / W).alias("avg_delivery_days"),
        (F.col("OT").cast("double") / W).alias("on_time_rate"),
        (F.coalesce(F.col("st"), F.lit(0.0)) / n_T.cast("double")).alias("rating"),
        _dec(_times(F.col("OD"), n_T)).alias("invoice_overdue_amt"),
    )


# ---------------------------------------------------------------------------
# M5 agg_daily_rfq_pipeline
# ---------------------------------------------------------------------------

M5_COLS = ["metric_date", "org_id", "rfq_open", "rfq_closed", "rfq_awarded", "avg_response_hours",
           "avg_quotes_per_rfq", "pipeline_value"]


def daily_rfq_pipeline(L: Landing, as_of: _dt.date, plan: str = "factorised") -> DataFrame:
    r = L.live("fact_rfq_raw", since=window_start(as_of)).filter(in_window("rfq_date", as_of))
    # only quotes of RFQs in the window can match (rfq_id is in the quote key);
    # key set from the raw RFQ rows of the window (a superset, see M2)
    in_win = L.raw_since("fact_rfq_raw", window_start(as_of))
    q = L.latest_for_keys("fact_rfq_quote_raw", in_win.select(F.col("id").alias("rfq_id")))
    st = F.col("status")
    if plan == "joins":
        j = left_join_default(r.select("id", "buyer_org_id", "status", "rfq_date", "quote_count", "total_budget"),
                              prefixed(q.select("rfq_id", "quoted_at"), "q_"), F.col("q_rfq_id") == F.col("id"))
        out = j.groupBy(day("rfq_date").alias("metric_date"), F.col("buyer_org_id").alias("org_id")).agg(
            count_if(~st.isin(RFQ_NOT_OPEN_PIPELINE)).alias("rfq_open"),
            count_if(st.isin(RFQ_CLOSED)).alias("rfq_closed"),
            count_if(st == RFQ_AWARDED).alias("rfq_awarded"),
            F.avg(hour_boundaries("rfq_date", "q_quoted_at")).alias("avg_response_hours"),
            F.avg("quote_count").alias("avg_quotes_per_rfq"),
            _dec(sum_or_zero("total_budget")).alias("pipeline_value"),
        )
        return out.select(*M5_COLS)

    # dateDiff('hour', a, b) = hour_index(b) - hour_index(a): sum quote hours per RFQ
    qa = q.groupBy(F.col("rfq_id")).agg(count_rows().alias("nq"), F.sum(_hour_index("quoted_at")).alias("hq"))
    rr = r.join(qa, r.id == qa.rfq_id, "left")
    n = F.coalesce(F.col("nq"), F.lit(0))
    w = _at_least_one(F.col("nq"))
    h_r = _hour_index("rfq_date")
    # an RFQ without a quote meets the default quoted_at 1970-01-01 00:00 (hour 0)
    hours = F.when(n > 0, F.col("hq") - n * h_r).otherwise(-h_r)
    out = rr.groupBy(day("rfq_date").alias("metric_date"), F.col("buyer_org_id").alias("org_id")).agg(
        F.sum(F.when(~st.isin(RFQ_NOT_OPEN_PIPELINE), w).otherwise(0)).alias("rfq_open"),
        F.sum(F.when(st.isin(RFQ_CLOSED), w).otherwise(0)).alias("rfq_closed"),
        F.sum(F.when(st == RFQ_AWARDED, w).otherwise(0)).alias("rfq_awarded"),
        F.sum(hours).alias("H"), F.sum(w).alias("W"),
        F.sum(F.col("quote_count") * w).alias("QC"),
        F.sum(F.col("total_budget") * w).alias("PV"))
    W = F.col("W").cast("double")
    return out.select("metric_date", "org_id", "rfq_open", "rfq_closed", "rfq_awarded",
                      (F.col("H").cast("double") / W).alias("avg_response_hours"),
                      (F.col("QC").cast("double") / W).alias("avg_quotes_per_rfq"),
                      _dec(F.col("PV")).alias("pipeline_value"))


# ---------------------------------------------------------------------------
# M6 agg_daily_revenue_territory (inner join to the buyer organisation)
# ---------------------------------------------------------------------------

def daily_revenue_territory(L: Landing, as_of: _dt.date) -> DataFrame:
    p = _po_scope(L, as_of)
    o = L.latest("dim_organization_raw").select(F.col("id").alias("o_id"), "state",
                                                 F.col("city_name").alias("city"))
    # pre-aggregate POs per (day, supplier, buyer) so the join moves one row per
    # buyer-supplier-day, not one per PO; AQE broadcasts the organisation side
    # at run time when its measured size is small
    pre = p.groupBy(day("po_date").alias("metric_date"), F.col("supplier_org_id").alias("org_id"),
                    "buyer_org_id").agg(F.sum("total_amount").alias("s"), count_rows().alias("n"))
    j = pre.join(o, pre.buyer_org_id == o.o_id, "inner")
    out = j.groupBy("metric_date", "org_id", "state", "city").agg(
        F.sum("s").alias("s"), F.sum("n").alias("order_count"))
    return out.select("metric_date", "org_id", "state", "city", _dec(F.col("s")).alias("revenue"),
                      "order_count", dec_div(F.col("s"), F.col("order_count")).alias("avg_order_value"))


# ---------------------------------------------------------------------------
# M7 agg_daily_engagement
# ---------------------------------------------------------------------------

def daily_engagement(L: Landing, as_of: _dt.date, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """``approx=True``: HyperLogLog++ distinct counts (relative error ``rsd``)
    and a top-k sketch for the most frequent event type — fixed-size state per
    group instead of exact distinct sets, for very large orgs."""
    e = L.live("fact_engagement_raw", since=window_start(as_of)).filter(in_window("event_ts", as_of))
    distinct = (lambda c: uniq_approx(c, rsd)) if approx else uniq
    top = top1_approx("event_type") if approx else top1("event_type")
    return e.groupBy(day("event_ts").alias("metric_date"), "org_id").agg(
        distinct("user_id").alias("active_users"),
        distinct("session_id").alias("sessions"),
        F.avg("duration_secs").alias("avg_session_secs"),
        count_rows().alias("page_views"),
        top.alias("top_event_type"),
    )


# ---------------------------------------------------------------------------
# M8 snapshot_org_daily (no date window; joins on org only)
# ---------------------------------------------------------------------------

M8_COLS = ["snapshot_date", "org_id", "open_po_count", "open_po_value", "open_rfq_count",
           "pending_invoices", "pending_invoice_amt", "inventory_value"]


def snapshot_org(L: Landing, as_of: _dt.date, plan: str = "factorised") -> DataFrame:
    p = _po_scope(L, None)
    r = L.latest("fact_rfq_raw")
    i = L.latest("fact_invoice_raw")
    im = L.latest("fact_inventory_movement_raw")
    snap = F.lit(as_of).alias("snapshot_date")
    if plan == "joins":
        j = prefixed(p.select("id", "buyer_org_id", "status", "total_amount"), "p_")
        # every join is on a column of the PO, so their order changes no row. The invoices come first: after
        # a join by organisation each PO would cross the network once per joined row. Then the largest
        # side by organisation: its shuffle deals the POs while they are single, and the RFQs (and the
        # grouping) meet them as dealt, also where they are broadcast
        j = left_join_default(j, prefixed(i.select("po_id", "status", "amount", "paid_amount"), "i_"),
                              F.col("i_po_id") == F.col("p_id"))
        j = left_join_default(j, prefixed(im.select("org_id", "quantity", "unit_cost"), "im_"),
                              F.col("im_org_id") == F.col("p_buyer_org_id"))
        j = left_join_default(j, prefixed(r.select("buyer_org_id", "status"), "r_"),
                              F.col("r_buyer_org_id") == F.col("p_buyer_org_id"))
        open_po = F.col("p_status").isin(PO_PENDING)
        pend = ~F.col("i_status").isin(INVOICE_SETTLED)
        out = j.groupBy(F.col("p_buyer_org_id").alias("org_id")).agg(
            count_if(open_po).alias("open_po_count"),
            _dec(sum_if("p_total_amount", open_po, D184)).alias("open_po_value"),
            count_if(~F.col("r_status").isin(RFQ_NOT_OPEN_SNAPSHOT)).alias("open_rfq_count"),
            count_if(pend).alias("pending_invoices"),
            _dec(sum_if(F.col("i_amount") - F.col("i_paid_amount"), pend, D184)).alias("pending_invoice_amt"),
            _dec(sum_or_zero(F.col("im_quantity") * F.col("im_unit_cost"))).alias("inventory_value"),
        )
        return out.select(snap, *M8_COLS[1:])

    pend = ~F.col("status").isin(INVOICE_SETTLED)
    inv = i.groupBy("po_id").agg(count_rows().alias("ni"), count_if(pend).alias("pi"),
                                 sum_if(F.col("amount") - F.col("paid_amount"), pend, DEC_WIDE).alias("pa"))
    pp = p.select("id", "buyer_org_id", "status", "total_amount").join(inv, p.id == inv.po_id, "left")
    n_i = _at_least_one(F.col("ni"))
    o_i = F.when(F.col("ni") > 0, F.col("pi")).otherwise(F.lit(1))
    open_po = F.col("status").isin(PO_PENDING)
    per_b = pp.groupBy(F.col("buyer_org_id").alias("org_id")).agg(
        F.sum(F.when(open_po, n_i).otherwise(0)).alias("OPEN"),
        sum_or_zero(F.when(open_po, F.col("total_amount") * n_i), DEC_WIDE).alias("OPENV"),
        F.sum(n_i).alias("NI"), F.sum(o_i).alias("OI"),
        sum_or_zero(F.coalesce(F.col("pa"), F.lit(0)), DEC_WIDE).alias("VI"))
    rfq = r.groupBy(F.col("buyer_org_id").alias("org_id")).agg(
        count_rows().alias("nr"), count_if(~F.col("status").isin(RFQ_NOT_OPEN_SNAPSHOT)).alias("or_"))
    mov = im.groupBy("org_id").agg(count_rows().alias("nm"),
                                   F.sum(F.col("quantity") * F.col("unit_cost")).alias("vm"))
    g = per_b.join(rfq, "org_id", "left").join(mov, "org_id", "left")
    n_R, n_M = _at_least_one(F.col("nr")), _at_least_one(F.col("nm"))
    o_R = F.when(F.col("nr") > 0, F.col("or_")).otherwise(F.lit(1))
    # V_M has 8 decimals: multiply as an integer of 10^-8 units by the integer
    # weight, round half-up once to 10^-4 units, then place the decimal point
    units = _times(shifted(F.coalesce(F.col("vm"), F.lit(0)).cast(T.DecimalType(38, 8)), 8), n_R, F.col("NI"))
    return g.select(
        snap, "org_id",
        _count(n_R, n_M, F.col("OPEN")).alias("open_po_count"),
        _dec(_times(F.col("OPENV"), n_R, n_M)).alias("open_po_value"),
        _count(o_R, n_M, F.col("NI")).alias("open_rfq_count"),
        _count(n_R, n_M, F.col("OI")).alias("pending_invoices"),
        _dec(_times(F.col("VI"), n_R, n_M)).alias("pending_invoice_amt"),
        dec_div(units.cast(DEC_WIDE), F.lit(100_000_000)).alias("inventory_value"),
    )


# ---------------------------------------------------------------------------
# M9 snapshot_inventory_sku_daily
# ---------------------------------------------------------------------------

def snapshot_inventory_sku(L: Landing, as_of: _dt.date) -> DataFrame:
    im = L.live("fact_inventory_movement_raw")
    mt = F.col("movement_type")
    g = im.groupBy("org_id", "warehouse_id", "product_id").agg(
        sum_if("quantity", mt == "inbound", DEC_WIDE).alias("qin"),
        sum_if("quantity", mt == "outbound", DEC_WIDE).alias("qout"),
        sum_if("quantity", mt == "reserved", DEC_WIDE).alias("qres"),
        dec_avg("unit_cost").alias("unit_cost"))
    on_hand = _dec(F.col("qin") - F.col("qout"))
    return g.select(
        F.lit(as_of).alias("snapshot_date"), "org_id", "warehouse_id", "product_id",
        on_hand.alias("qty_on_hand"),
        _dec(F.col("qres")).alias("qty_reserved"),
        _dec(F.greatest(F.col("qin") - F.col("qout") - F.col("qres"), F.lit(0).cast(DEC_WIDE))).alias("qty_available"),
        F.col("unit_cost"),
        _dec(on_hand * F.col("unit_cost")).alias("total_value"),
    )


MARTS = {
    "agg_daily_buyer": daily_buyer,
    "agg_daily_seller": daily_seller,
    "agg_daily_category_spend": daily_category_spend,
    "agg_daily_supplier_spend": daily_supplier_spend,
    "agg_daily_rfq_pipeline": daily_rfq_pipeline,
    "agg_daily_revenue_territory": daily_revenue_territory,
    "agg_daily_engagement": daily_engagement,
    "snapshot_org_daily": snapshot_org,
    "snapshot_inventory_sku_daily": snapshot_inventory_sku,
}
FACTORISED = {"agg_daily_buyer", "agg_daily_seller", "agg_daily_supplier_spend",
              "agg_daily_rfq_pipeline", "snapshot_org_daily"}
