"""Readings shared by the marts of a refresh: one dedup per table, dealt by ranges of its key."""

from mart_helpers import make_landing

from tidemart.plans import refresh as R
from tidemart.plans import stateful_queries as Q
from tidemart.plans.landing import Landing, SharedReadings

MOVEMENTS = [dict(id=k, org_id=k % 5, movement_date="2001-07-01", quantity=k, movement_type="inbound") for k in range(50)] + [
    # a newer version, and a tombstone that must not bring version 1 back
    dict(id=7, org_id=2, movement_date="2001-07-01", quantity=700, movement_type="inbound", _cdc_version=2),
    dict(id=8, org_id=3, movement_date="2001-07-01", _cdc_version=2, _cdc_is_deleted=1)]
TABLE = "fact_inventory_movement_raw"


def _rows(df):
    return sorted(tuple(r) for r in df.select("id", "org_id", "quantity").collect())


def test_latest_and_live_share_one_reading(spark):
    L = make_landing(spark, {TABLE: MOVEMENTS})
    shared = SharedReadings(L)
    try:
        assert _rows(shared.latest(TABLE)) == _rows(L.latest(TABLE))
        assert _rows(shared.live(TABLE)) == _rows(L.live(TABLE))
        assert len(_rows(shared.live(TABLE))) == 49
        assert len(shared._memo) == 1
    finally:
        shared.release()


def test_range_dedup_needs_no_second_shuffle(spark):
    L = make_landing(spark, {TABLE: MOVEMENTS})
    plan = L.latest_by_range(TABLE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(") >= 1 and "hashpartitioning(" not in plan


def test_passes_over_one_state_share_their_readings(spark, tmp_path):
    L = make_landing(spark, {TABLE: MOVEMENTS})
    reads = []

    class Counting(Landing):
        def latest_by_range(self, name, key_mode="sort_key", since=None):
            reads.append(name)
            return super().latest_by_range(name, key_mode, since)
    shared = SharedReadings(Counting(L.raw))
    try:
        for day in (Q.DAY_BEFORE, Q.AS_OF):
            assert {r["status"] for r in R.run(spark, shared, str(tmp_path), day, group="snapshot").collect()} == {"ok"}
    finally:
        shared.release()
    assert reads.count(TABLE) == 1
    assert R.read_mart(spark, str(tmp_path), "snapshot_inventory_sku_daily").count() == 10
