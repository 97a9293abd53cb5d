"""Refresh by changes equals a full refresh, for random changes of every landing table."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from mart_helpers import make_landing
from test_factorised import AS_OF, DAYS, random_tables

from tidemart.plans import delta as D
from tidemart.plans import marts as M
from tidemart.plans import refresh as R
from tidemart.sources.rows import landing_rows
from tidemart.sources.schemas import LANDING

LATER = AS_OF + dt.timedelta(days=3)


def _root():
    return tempfile.mkdtemp(prefix="delta-", dir="/tmp")


def _rows(df):
    return sorted((tuple(r) for r in df.drop("_etl_loaded_at", "month").collect()), key=repr)


def more_tables(seed):
    rng, tables = random.Random(seed), random_tables(seed)
    tables["fact_po_item_raw"] = [
        {"id": 800 + i, "po_id": rng.randrange(1, 7), "category_id": rng.randrange(1, 3), "total_price": f"{rng.randrange(1, 99)}.5",
         "unit_price": "2.25", "created_at": dt.datetime(2001, 7, 1)} for i in range(rng.randrange(0, 8))]
    tables["dim_organization_raw"] = [{"id": i, "state": f"s{i % 2}", "city_name": "c"} for i in (1, 2, 3)]
    tables["fact_engagement_raw"] = [
        {"id": 900 + i, "org_id": rng.choice([1, 2]), "user_id": rng.randrange(3), "session_id": f"s{rng.randrange(3)}",
         "event_type": rng.choice("ab"), "duration_secs": rng.randrange(60),
         "event_ts": dt.datetime.combine(rng.choice(DAYS), dt.time(rng.randrange(24)))} for i in range(rng.randrange(0, 9))]
    return tables


def random_changes(seed, tables):
    """New versions (tombstones, other parents, organisations and days), late old versions and new rows."""
    rng, fresh, out = random.Random(seed + 1000), more_tables(seed + 500), {}
    for name, rows in tables.items():
        if rng.random() < 0.3:
            continue
        changed = []
        for row in rows:
            if rng.random() < 0.4 and name != "dim_organization_raw" or rng.random() < 0.2:
                new = dict(row, _cdc_version=rng.choice([0, 2, 3]), _cdc_is_deleted=int(rng.random() < 0.3))
                other = rng.choice(fresh.get(name) or [row])
                for column in ("status", "po_id", "rater_org_id", "supplier_org_id", "delay_days", "rating", "quoted_at",
                               "total_amount", "state", "org_id", "duration_secs"):
                    if column in other and rng.random() < 0.5:
                        new[column] = other[column]
                if name == "dim_organization_raw":
                    new["state"] = "new"
                changed.append(new)
        changed += [dict(r, id=r["id"] + rng.choice([0, 0, 5000])) for r in fresh.get(name, [])[:rng.randrange(0, 3)]]
        if changed:
            out[name] = changed
    return out


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("mart", sorted(M.MARTS))
def test_refresh_of_changes_equals_full_refresh(spark, mart, seed):
    tables = more_tables(seed)
    changes = random_changes(seed, tables)
    before = make_landing(spark, tables)
    changed = {t: landing_rows(spark, t, rows) for t, rows in changes.items()}
    after = make_landing(spark, {t: tables.get(t, []) + changes.get(t, []) for t in {*tables, *changes}})
    by_change, in_full = _root(), _root()
    for root in (by_change, in_full):
        R.refresh_mart(spark, before, mart, AS_OF, root)
    D.refresh_changed(spark, before, changed, mart, LATER if seed % 2 else AS_OF, by_change, last=AS_OF)
    R.refresh_mart(spark, after, mart, LATER if seed % 2 else AS_OF, in_full)
    assert _rows(R.read_mart(spark, by_change, mart)) == _rows(R.read_mart(spark, in_full, mart))


def test_a_delivery_of_order_0_reaches_every_group_without_an_order(spark):
    quote = {"id": 300, "rfq_id": 100, "supplier_org_id": 7, "status": 6, "quoted_at": dt.datetime(2001, 7, 20)}
    before = make_landing(spark, {"fact_rfq_quote_raw": [quote]})
    late = {"id": 500, "po_id": 0, "delay_days": 3}
    root = _root()
    R.refresh_mart(spark, before, "agg_daily_seller", AS_OF, root)
    n, _ = D.refresh_changed(spark, before, {"fact_delivery_raw": landing_rows(spark, "fact_delivery_raw", [late])},
                             "agg_daily_seller", AS_OF, root, last=AS_OF)
    assert n == 1
    assert R.read_mart(spark, root, "agg_daily_seller").first()["on_time_delivery"] == 0.0


def test_only_touched_groups_are_computed_and_only_their_months_written(spark, landing_small):
    import glob
    import os
    root, name = _root(), "agg_daily_buyer"
    R.refresh_mart(spark, landing_small, name, AS_OF, root)
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/{name}/month=*/*.parquet")}
    po = landing_small.live("fact_po_raw").where("po_date >= '2001-07-01' AND is_deleted = 0").orderBy("id").limit(1)
    one = po.withColumn("total_amount", F.col("total_amount") + 1).withColumn("_cdc_version", F.lit(9).cast("long"))
    one = spark.createDataFrame(one.collect(), LANDING["fact_po_raw"].schema)
    n, rows = D.refresh_changed(spark, landing_small, {"fact_po_raw": one}, name, AS_OF, root, last=AS_OF)
    assert (n, rows) == (1, 1)
    now = set(glob.glob(f"{root}/{name}/month=*/*.parquet"))
    assert all(f in now and os.path.getmtime(f) == t for f, t in files.items() if "month=200107" not in f)
    after = D.with_changes(landing_small, {"fact_po_raw": one})
    full = _root()
    R.refresh_mart(spark, after, name, AS_OF, full)
    assert _rows(R.read_mart(spark, root, name)) == _rows(R.read_mart(spark, full, name))


def test_no_change_writes_nothing_and_going_back_is_refused(spark, landing_small):
    root, name = _root(), "agg_daily_revenue_territory"
    R.refresh_mart(spark, landing_small, name, AS_OF, root)
    assert D.refresh_changed(spark, landing_small, {}, name, AS_OF, root, last=AS_OF) == (0, 0)
    with pytest.raises(ValueError):
        D.refresh_changed(spark, landing_small, {}, name, AS_OF, root, last=LATER)
