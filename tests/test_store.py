"""Landing store: base plus tail equals the whole log, compaction rewrites only affected months, replays and
crashes change nothing, and marts follow the store's positions."""

import datetime as dt
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from mart_helpers import make_landing

from tidemart.operators.cdc import latest_live, latest_version
from tidemart.plans import refresh as R
from tidemart.plans.store import LandingStore, ManifestConflict, refresh_from_store
from tidemart.sources.rows import landing_rows
from tidemart.sources.schemas import LANDING

AS_OF = dt.date(2001, 8, 1)
PO, QUOTE = LANDING["fact_po_raw"], LANDING["fact_rfq_quote_raw"]


def _rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def _po(i, day, version=1, deleted=0, **more):
    return {"id": i, "buyer_org_id": i % 3, "supplier_org_id": 7, "status": 5, "total_amount": 10 + version, "po_date": f"2001-{day} 00:00:00",
            "_cdc_version": version, "_cdc_is_deleted": deleted, **more}


def _store(spark):
    return LandingStore(spark, tempfile.mkdtemp(prefix="store-", dir="/tmp"))


def _files(store, table):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{store.root}/{table}/base/*/month=*/*.parquet")}


def test_base_and_tail_equal_the_log_and_untouched_months_keep_their_files(spark):
    store, columns = _store(spark), [f.name for f in PO.schema.fields]
    first = [_po(i, f"{5 + i % 3:02d}-{10 + i}") for i in range(1, 13)]
    second = [_po(1, "06-11", 2), _po(4, "06-14", 3, 1), _po(30, "06-02"), _po(7, "06-17", 0)]  # June only; 7 comes late
    store.append("fact_po_raw", landing_rows(spark, "fact_po_raw", first), "a")
    assert store.compact("fact_po_raw") == [200105, 200106, 200107]
    files = _files(store, "fact_po_raw")
    store.append("fact_po_raw", landing_rows(spark, "fact_po_raw", second), "b")
    log = landing_rows(spark, "fact_po_raw", first + second)

    def same():
        L = store.landing()
        assert _rows(L.latest("fact_po_raw"), columns) == _rows(latest_version(log, PO.sort_key), columns)
        assert _rows(L.live("fact_po_raw"), columns) == _rows(latest_live(log, PO.sort_key), columns)
        assert _rows(L.live("fact_po_raw", "primary_key"), columns) == _rows(latest_live(log, ("id",)), columns)
        since = dt.date(2001, 6, 15)
        assert _rows(L.live("fact_po_raw", since=since), columns) == _rows(
            latest_live(log, PO.sort_key).where(F.col("po_date") >= F.lit(since)), columns)
    same()
    assert store.compact("fact_po_raw") == [200106]
    same()
    now = _files(store, "fact_po_raw")
    assert all(now[f] == t for f, t in files.items() if "200106" not in f)
    assert store.compact("fact_po_raw") == []
    assert store.vacuum("fact_po_raw", keep=1) > 0
    assert not [f for f in _files(store, "fact_po_raw") if "gen=2/month=200106" in f]
    same()


def test_a_key_whose_date_moves_to_another_month_leaves_the_old_one(spark):
    store, columns = _store(spark), [f.name for f in QUOTE.schema.fields]
    quote = lambda i, day, version: {"id": i, "rfq_id": 5, "supplier_org_id": 7, "quoted_at": f"2001-{day} 00:00:00", "_cdc_version": version}
    first = [quote(1, "05-01", 1), quote(2, "05-02", 1), quote(3, "07-01", 1)]
    moved = [quote(1, "06-01", 2), quote(3, "05-05", 0)]
    store.append("fact_rfq_quote_raw", landing_rows(spark, "fact_rfq_quote_raw", first), "a")
    store.compact("fact_rfq_quote_raw")
    store.append("fact_rfq_quote_raw", landing_rows(spark, "fact_rfq_quote_raw", moved), "b")
    want = _rows(latest_version(landing_rows(spark, "fact_rfq_quote_raw", first + moved), QUOTE.sort_key), columns)
    assert _rows(store.landing().latest("fact_rfq_quote_raw"), columns) == want
    assert store.compact("fact_rfq_quote_raw") == [200105, 200106, 200107]
    assert _rows(store.landing().latest("fact_rfq_quote_raw"), columns) == want
    assert store.landing().raw("fact_rfq_quote_raw").count() == 3


def test_replayed_batches_crashes_and_rival_writers(spark):
    store, rows = _store(spark), landing_rows(spark, "fact_po_raw", [_po(1, "06-01")])
    for _ in range(2):
        store.append("fact_po_raw", rows, "a")
    assert store.position("fact_po_raw") == 1
    store.compact("fact_po_raw")
    store.append("fact_po_raw", rows, "a")  # delivered again after its compaction
    assert store.position("fact_po_raw") == 2
    # a compaction that died before its manifest leaves files that nobody reads
    rows.withColumn("month", F.lit(200106)).write.partitionBy("month").parquet(f"{store.root}/fact_po_raw/base/gen=3")
    assert store.landing().raw("fact_po_raw").count() == 1
    with pytest.raises(ManifestConflict):
        store._publish("fact_po_raw", 2, {})
    assert store.landing().latest("dim_user_raw").count() == 0  # a table without any batch


def test_unpartitioned_table(spark):
    store = _store(spark)
    user = lambda i, v, name: {"id": i, "first_name": name, "_cdc_version": v}
    store.append("dim_user_raw", landing_rows(spark, "dim_user_raw", [user(1, 1, "a"), user(2, 1, "b")]), "a")
    store.compact("dim_user_raw")
    store.append("dim_user_raw", landing_rows(spark, "dim_user_raw", [user(1, 2, "c")]), "b")
    want = [(1, "c"), (2, "b")]
    assert _rows(store.landing().live("dim_user_raw"), ["id", "first_name"]) == want
    store.compact("dim_user_raw")
    assert _rows(store.landing().live("dim_user_raw"), ["id", "first_name"]) == want
    assert "month" not in store.landing().live("dim_user_raw").columns


def test_marts_follow_the_positions_of_the_store(spark):
    name = "agg_daily_revenue_territory"
    store, root = _store(spark), tempfile.mkdtemp(prefix="marts-", dir="/tmp")
    org = [{"id": i, "state": f"s{i}"} for i in range(3)]
    batches = [[_po(i, f"06-{10 + i}") for i in range(1, 9)], [_po(2, "06-12", 2), _po(20, "07-01")], [_po(3, "06-13", 2, 1)]]
    store.append("dim_organization_raw", landing_rows(spark, "dim_organization_raw", org), "a")
    seen = []
    for i, batch in enumerate(batches):
        store.append("fact_po_raw", landing_rows(spark, "fact_po_raw", batch), str(i))
        if i == 1:
            store.compact("fact_po_raw")
        kind, n = refresh_from_store(spark, store, root, name, AS_OF)
        seen.append(kind)
        whole = make_landing(spark, {"fact_po_raw": sum(batches[:i + 1], []), "dim_organization_raw": org})
        full = tempfile.mkdtemp(prefix="marts-", dir="/tmp")
        R.refresh_mart(spark, whole, name, AS_OF, full)
        columns = R.read_mart(spark, full, name).drop("_etl_loaded_at", "month").columns
        assert _rows(R.read_mart(spark, root, name), columns) == _rows(R.read_mart(spark, full, name), columns)
    assert seen == ["full", "changes", "changes"]
    assert refresh_from_store(spark, store, root, name, AS_OF) == ("changes", 0)
    store.append("fact_po_raw", landing_rows(spark, "fact_po_raw", [_po(40, "07-02")]), "9")
    store.vacuum("fact_po_raw", keep=1)  # the position of the last refresh is gone
    assert refresh_from_store(spark, store, root, name, AS_OF)[0] == "full"
