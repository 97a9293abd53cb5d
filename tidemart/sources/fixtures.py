"""Landing tables derived from the TPC-H-style input tables (FIXTURES.md §4).

Every id is ``key + 1`` because 0 is also the default an unmatched left join
yields. Each derivation is a Spark plan over the input tables, so its cost grows
with them; nothing is generated on the driver.
"""

from __future__ import annotations

import contextlib
import datetime as _dt

from pyspark import StorageLevel

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.exprs import dec_div
from tidemart.sources.schemas import (
    D184, IS_DELETED, LANDING, SYNCED_AT, VERSION, ts_lit, type_default,
)
from tidemart.sources.tables import TableSource

# Arrival time and version of the base (single-version) fixtures.
BASE_SYNCED_AT = _dt.datetime(2024, 2, 1, 0, 0, 0)
BASE_VERSION = 1
# Id offsets that keep derived id ranges apart, and the spans of
# composed ids (order keys up to 10^10 fit BIGINT with each of them).
PART_SPAN = 300_000_000
SUPPLIER_SPAN = 100_000_000
LINE_SPAN = 100_000_000
RFQ_ID_OFFSET = 10_000_000
INVOICE_ID_OFFSET = 20_000_000
# Status code cycles (FIXTURES.md §4).
RFQ_STATUS_CYCLE = [1, 3, 6, 12, 14]
QUOTE_STATUS_CYCLE = [2, 6, 11, 14]


def K(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c) + F.lit(1)


def buyer_org(c) -> Column:
    """Organisation id of a customer: even, so no supplier ever shares it."""
    return K(c) * F.lit(2)


def supplier_org(c) -> Column:
    """Organisation id of a supplier: odd."""
    return (F.col(c) if isinstance(c, str) else c) * F.lit(2) + F.lit(1)


def D(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(D184)


def pick(cycle: list[int], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in cycle]), (idx + 1).cast("int"))


def half_up_div(num_d184: Column, den: Column) -> Column:
    """Quotient of two decimals (whole ``den``) rounded half-up once to 4 places."""
    return dec_div(num_d184, den)


def to_landing(df: DataFrame, table: str, synced_at=BASE_SYNCED_AT,
               version: int = BASE_VERSION) -> DataFrame:
    """Project derived columns onto the landing schema with metadata."""
    t = LANDING[table]
    have = set(df.columns)
    cols = [F.coalesce(F.col(f.name).cast(f.dataType), type_default(f.dataType)).alias(f.name)
            if f.name in have else type_default(f.dataType).alias(f.name)
            for f in t.data.fields]
    cols += [ts_lit(synced_at).alias(SYNCED_AT),
             F.lit(0).alias(IS_DELETED),
             F.lit(version).cast("long").alias(VERSION)]
    return df.select(*cols)


class Fixtures:
    """Landing tables for one input folder (``sf_dir``)."""

    def __init__(self, src: TableSource):
        self.src = src
        self._shared: DataFrame | None = None

    def _order_supplier(self) -> DataFrame:
        """Line items per (order, supplier): amount and last ship date. Feeds
        POs (smallest supplier), quotes, deliveries, ratings and contracts."""
        if self._shared is not None:
            return self._shared
        return (self._lines_by_order("l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate")
                .groupBy("l_orderkey", "l_suppkey")
                .agg(F.sum(D("l_extendedprice")).alias("amt"), F.max("l_shipdate").alias("shipped")))

    @contextlib.contextmanager
    def shared_aggregates(self):
        """While deriving several tables at once, compute the (order, supplier)
        aggregate once (persisted; lost blocks are recomputed from lineage)."""
        agg = self._order_supplier().persist(StorageLevel.MEMORY_AND_DISK)
        self._shared = agg
        try:
            yield self
        finally:
            self._shared = None
            agg.unpersist()

    # -- helpers ---------------------------------------------------------------
    def _orders(self, *cols: str) -> DataFrame:
        return self.src.read("orders", *cols)

    def _lineitem(self, *cols: str) -> DataFrame:
        return self.src.read("lineitem", *cols)

    def _lines_by_order(self, *cols: str) -> DataFrame:
        """Line items dealt by order. Grouping by the order and more keys, the window per order and the
        join to its order all keep this deal: the lines cross the network once, as narrow input
        rows. Their groups hold one or two lines, so aggregating before the shuffle would not shrink them: it
        would only hold (and spill) nearly every line in each reading task."""
        return self._lineitem(*cols).repartition("l_orderkey")

    def _min_supplier(self) -> DataFrame:
        """Per order: the smallest supplier key on its lines. A partial aggregate: what a task
        holds and sends is two keys per order it has read, never more than the lines' own two keys."""
        lines = self._lineitem("l_orderkey", "l_suppkey") if self._shared is None else self._shared
        return lines.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("min_supp"))

    def _po_supplier(self) -> DataFrame:
        """Per order: ``(o_orderkey, supplier_org_id)``; 0 for orders without lines."""
        o = self._orders("o_orderkey")
        s = self._min_supplier()
        return (o.join(s, o.o_orderkey == s.l_orderkey, "left")
                 .select("o_orderkey",
                         F.coalesce(supplier_org("min_supp"), F.lit(0))
                         .cast("long").alias("supplier_org_id")))

    def _category_index(self) -> DataFrame:
        """``(p_type, category_id)``: 1-based rank of the type name.

        Ranked over the distinct type names only — a dictionary whose size is
        the type cardinality, not the part count.
        """
        types = self.src.read("part", "p_type").distinct()
        return types.select("p_type",
                            F.dense_rank().over(Window.orderBy("p_type")).cast("long").alias("category_id"))

    # -- facts -----------------------------------------------------------------
    def fact_po(self) -> DataFrame:
        o = self._orders("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
        s = self._min_supplier()
        j = o.join(s, o.o_orderkey == s.l_orderkey, "left")
        k = F.col("o_orderkey")
        df = j.select(
            K(k).alias("id"),
            buyer_org("o_custkey").alias("buyer_org_id"),
            F.coalesce(supplier_org("min_supp"), F.lit(0)).alias("supplier_org_id"),
            K("o_custkey").alias("created_by"),
            F.concat(F.lit("PO-"), k.cast("string")).alias("po_number"),
            (F.lit(1) + k % 5).alias("status"),
            D("o_totalprice").alias("total_amount"),
            F.lit("INR").alias("currency"),
            F.col("o_orderdate").alias("po_date"),
            F.date_add(F.to_date("o_orderdate"), 30).alias("expected_delivery"),
            F.when(k % 97 == 0, 1).otherwise(0).alias("is_deleted"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )
        return to_landing(df, "fact_po_raw")

    def fact_po_item(self) -> DataFrame:
        li = self._lines_by_order("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
        g = (li.groupBy("l_orderkey", "l_partkey")
               .agg(F.sum(D("l_quantity")).alias("qty"), F.sum(D("l_extendedprice")).alias("total")))
        part = self.src.read("part", "p_partkey", "p_type")
        cat = self._category_index()
        pc = part.join(cat, "p_type").select("p_partkey", "category_id")
        j = g.join(pc, g.l_partkey == pc.p_partkey, "left")
        df = j.select(
            (K("l_orderkey") * F.lit(PART_SPAN) + F.col("l_partkey")).alias("id"),
            K("l_orderkey").alias("po_id"),
            K("l_partkey").alias("product_id"),
            F.col("category_id"),
            F.col("qty").alias("quantity"),
            half_up_div(F.col("total"), F.col("qty")).alias("unit_price"),
            F.col("total").alias("total_price"),
            F.lit("EA").alias("uom"),
        )
        return to_landing(df, "fact_po_item_raw")

    def fact_rfq(self) -> DataFrame:
        o = self._orders("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").filter(F.col("o_orderkey") % 2 == 0)
        k = F.col("o_orderkey")
        df = o.select(
            (F.lit(RFQ_ID_OFFSET) + k).alias("id"),
            buyer_org("o_custkey").alias("buyer_org_id"),
            (F.lit(1) + k % 6).alias("category_id"),
            F.concat(F.lit("RFQ-"), k.cast("string")).alias("rfq_number"),
            pick(RFQ_STATUS_CYCLE, F.floor(k / 2) % 5).alias("status"),
            D("o_totalprice").alias("total_budget"),
            F.lit("INR").alias("currency"),
            F.col("o_orderdate").alias("rfq_date"),
            F.date_add(F.to_date("o_orderdate"), 14).alias("close_date"),
            (k % 4).alias("quote_count"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )
        return to_landing(df, "fact_rfq_raw")

    def _lines_of_orders(self, even_only: bool = False) -> DataFrame:
        o = self._orders("o_orderkey", "o_custkey", "o_orderdate")
        if even_only:
            o = o.filter(F.col("o_orderkey") % 2 == 0)
        return o

    def fact_rfq_quote(self) -> DataFrame:
        o = self._lines_of_orders(even_only=True)
        li = self._order_supplier().select("l_orderkey", "l_suppkey", "amt")
        j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        quoted = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("l_suppkey") % 72).cast("int"))
        df = j.select(
            (K("l_orderkey") * F.lit(SUPPLIER_SPAN) + F.col("l_suppkey")).alias("id"),
            (F.lit(RFQ_ID_OFFSET) + F.col("l_orderkey")).alias("rfq_id"),
            supplier_org("l_suppkey").alias("supplier_org_id"),
            pick(QUOTE_STATUS_CYCLE, F.col("l_suppkey") % 4).alias("status"),
            F.col("amt").alias("quoted_amount"),
            F.lit("INR").alias("currency"),
            quoted.alias("quoted_at"),
            quoted.alias("updated_at"),
        )
        return to_landing(df, "fact_rfq_quote_raw")

    def fact_delivery(self) -> DataFrame:
        o = self._lines_of_orders()
        li = self._order_supplier().select("l_orderkey", "l_suppkey", "shipped")
        j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        sched = F.date_add(F.to_date("o_orderdate"), 30)
        actual = F.to_date("shipped")
        df = j.select(
            (K("l_orderkey") * F.lit(SUPPLIER_SPAN) + F.col("l_suppkey")).alias("id"),
            K("l_orderkey").alias("po_id"),
            buyer_org("o_custkey").alias("buyer_org_id"),
            supplier_org("l_suppkey").alias("supplier_org_id"),
            (F.lit(1) + F.col("l_suppkey") % 2).alias("warehouse_id"),
            sched.alias("scheduled_date"),
            actual.alias("actual_date"),
            F.lit("delivered").alias("status"),
            F.datediff(actual, sched).alias("delay_days"),
            F.col("o_orderdate").alias("created_at"),
        )
        return to_landing(df, "fact_delivery_raw")

    def fact_invoice(self) -> DataFrame:
        o = (self._orders("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
             .filter(F.col("o_orderkey") % 4 != 3))
        amount = D("o_totalprice")
        st = F.col("o_orderstatus")
        inv_date = F.date_add(F.to_date("o_orderdate"), 7)
        df = o.select(
            (F.lit(INVOICE_ID_OFFSET) + F.col("o_orderkey")).alias("id"),
            K("o_orderkey").alias("po_id"),
            buyer_org("o_custkey").alias("buyer_org_id"),
            F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string")).alias("invoice_number"),
            inv_date.alias("invoice_date"),
            F.date_add(inv_date, 30).alias("due_date"),
            amount.alias("amount"),
            F.when(st == "F", amount).when(st == "O", F.lit(0).cast(D184))
             .otherwise(F.floor(amount / 2).cast(D184)).alias("paid_amount"),
            F.when(st == "F", "paid").when(st == "O", "overdue").otherwise("pending").alias("status"),
            F.when(st == "F", inv_date).alias("payment_date"),
            F.col("o_orderdate").alias("created_at"),
        )
        return to_landing(df, "fact_invoice_raw")

    def fact_rating(self) -> DataFrame:
        o = (self._orders("o_orderkey", "o_custkey", "o_orderdate").filter(F.col("o_orderkey") % 3 == 0))
        sup = self._po_supplier()
        j = o.join(sup, "o_orderkey", "left")
        k = F.col("o_orderkey")
        df = j.select(
            K(k).alias("id"),
            buyer_org("o_custkey").alias("rater_org_id"),
            F.coalesce(F.col("supplier_org_id"), F.lit(0)).alias("rated_org_id"),
            K(k).alias("po_id"),
            (F.lit(1) + k % 5).cast("double").alias("rating"),
            F.col("o_orderdate").alias("rated_at"),
        )
        return to_landing(df, "fact_rating_raw")

    def fact_inventory_movement(self) -> DataFrame:
        o = self._lines_of_orders()
        li = self._lines_by_order("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                  "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
        # Lines with equal keys (they occur) are one movement; its id is the order
        # and the movement's number in it: the four keys do not fit one BIGINT.
        # smallest return flag as an int code (A < N < R): a string min would
        # force a sort-based aggregate
        rf = F.col("l_returnflag")
        code = F.when(rf == "A", 1).when(rf == "N", 2).when(rf == "R", 3)
        g = (li.groupBy("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
               .agg(F.sum(D("l_quantity")).alias("qty"), F.sum(D("l_extendedprice")).alias("ext"),
                    F.min(code).alias("flag"), F.max("l_shipdate").alias("shipped")))
        number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_linenumber"))
        g = g.withColumn("id", K("l_orderkey") * F.lit(LINE_SPAN) + number)
        j = g.join(o, g.l_orderkey == o.o_orderkey, "inner")
        flag = F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), F.col("flag"))
        df = j.select(
            "id",
            buyer_org("o_custkey").alias("org_id"),
            (F.lit(1) + F.col("l_suppkey") % 2).alias("warehouse_id"),
            K(F.col("l_partkey") % 5).alias("product_id"),
            F.when(flag == "A", "inbound").when(flag == "R", "outbound")
             .when(flag == "N", "reserved").otherwise("").alias("movement_type"),
            F.col("qty").alias("quantity"),
            half_up_div(F.col("ext"), F.col("qty")).alias("unit_cost"),
            F.to_date("shipped").alias("movement_date"),
            K("l_orderkey").alias("po_id"),
            F.col("shipped").alias("created_at"),
        )
        return to_landing(df, "fact_inventory_movement_raw")

    def fact_engagement(self) -> DataFrame:
        e = self.src.read("events", "event_id", "ts", "user_id", "event_type", "value")
        df = e.select(
            K("event_id").alias("id"),
            (F.lit(1) + F.col("user_id") % 20).alias("org_id"),
            K("user_id").alias("user_id"),
            F.col("event_type"),
            F.concat(F.lit("/"), F.col("event_type")).alias("page_url"),
            F.concat(F.col("user_id").cast("string"), F.lit("-"),
                     F.to_date("ts").cast("string")).alias("session_id"),
            F.floor("value").cast("long").alias("duration_secs"),
            F.date_trunc("second", F.col("ts")).alias("event_ts"),
        )
        return to_landing(df, "fact_engagement_raw")

    def fact_prf(self) -> DataFrame:
        o = self._orders("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").filter(F.col("o_orderkey") % 7 == 0)
        df = o.select(
            K("o_orderkey").alias("id"), buyer_org("o_custkey").alias("org_id"),
            K("o_custkey").alias("requested_by"), (F.lit(1) + F.col("o_orderkey") % 6).alias("category_id"),
            (F.col("o_orderkey") % 3).alias("status"), D("o_totalprice").alias("estimated_value"),
            F.lit("INR").alias("currency"), F.col("o_orderdate").alias("request_date"),
            F.date_add(F.to_date("o_orderdate"), 21).alias("required_by"),
            F.col("o_orderdate").alias("created_at"))
        return to_landing(df, "fact_prf_raw")

    def fact_contract(self) -> DataFrame:
        o = self._orders("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").filter(F.col("o_orderkey") % 11 == 0)
        sup = self._po_supplier()
        j = o.join(sup, "o_orderkey", "left")
        start = F.to_date("o_orderdate")
        df = j.select(
            K("o_orderkey").alias("id"), buyer_org("o_custkey").alias("buyer_org_id"),
            F.coalesce("supplier_org_id", F.lit(0)).alias("supplier_org_id"),
            F.concat(F.lit("CT-"), F.col("o_orderkey").cast("string")).alias("contract_number"),
            F.lit("active").alias("status"), D("o_totalprice").alias("total_value"),
            F.lit("INR").alias("currency"), start.alias("start_date"),
            F.date_add(start, 365).alias("end_date"), start.alias("signed_date"),
            F.col("o_orderdate").alias("created_at"))
        return to_landing(df, "fact_contract_raw")

    # -- dimensions ------------------------------------------------------------
    def dim_organization(self) -> DataFrame:
        nation = self.src.read("nation", "n_nationkey", "n_name", "n_regionkey")
        region = self.src.read("region", "r_regionkey", "r_name")
        # nation/region are fixed-size dictionaries (25 / 5 rows by definition)
        geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        geo = F.broadcast(geo.select("n_nationkey", "n_name", "r_name"))
        c = self.src.read("customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        s = self.src.read("supplier", "s_suppkey", "s_name", "s_nationkey")
        buyers = c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select(
            buyer_org("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.lit("buyer").alias("business_type"), F.col("r_name").alias("country"),
            F.col("n_name").alias("state"), F.col("c_mktsegment").alias("city_name"))
        sellers = s.join(geo, s.s_nationkey == geo.n_nationkey, "left").select(
            supplier_org("s_suppkey").alias("id"), F.col("s_name").alias("name"),
            F.lit("supplier").alias("business_type"), F.col("r_name").alias("country"),
            F.col("n_name").alias("state"), F.lit("").alias("city_name"))
        df = buyers.unionByName(sellers).withColumn("is_active", F.lit(1))
        return to_landing(df, "dim_organization_raw")

    def dim_category(self) -> DataFrame:
        df = self._category_index().select(
            F.col("category_id").alias("id"), F.col("p_type").alias("name"),
            F.upper(F.regexp_replace("p_type", " ", "_")).alias("code"), F.lit(1).alias("is_active"))
        return to_landing(df, "dim_category_raw")

    def dim_product(self) -> DataFrame:
        part = self.src.read("part", "p_partkey", "p_name", "p_brand", "p_type")
        cat = self._category_index()
        df = part.join(cat, "p_type", "left").select(
            K("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("code"), F.col("category_id"), F.col("p_brand").alias("brand"),
            F.lit("EA").alias("uom"), F.lit(1).alias("is_active"))
        return to_landing(df, "dim_product_raw")

    def dim_user(self) -> DataFrame:
        e = self.src.read("events", "user_id", "ts")
        df = e.groupBy("user_id").agg(F.min("ts").alias("joined")).select(
            K("user_id").alias("id"), (F.lit(1) + F.col("user_id") % 20).alias("organization_id"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("first_name"),
            F.lit("buyer").alias("user_type"), F.lit(1).alias("is_active"),
            F.col("joined").alias("date_joined"))
        return to_landing(df, "dim_user_raw")

    def dim_warehouse(self) -> DataFrame:
        li = self.src.read("lineitem", "l_suppkey")
        df = li.select((F.lit(1) + F.col("l_suppkey") % 2).alias("id")).distinct().select(
            "id", F.concat(F.lit("WH-"), F.col("id").cast("string")).alias("name"),
            F.lit(1).alias("is_active"))
        return to_landing(df, "dim_warehouse_raw")

    def table(self, name: str) -> DataFrame:
        """Landing table by its name, e.g. ``fact_po_raw``."""
        return getattr(self, name.removesuffix("_raw"))()
