"""Scale properties of the physical plans (checked on sf0.001, they hold at any size)."""

import contextlib
import datetime as dt
import io
import re
import tempfile

import pytest

from mart_helpers import SF0001

from tidemart.operators.cdc import latest_live, write_compacted
from tidemart.plans import marts as M
from tidemart.plans.landing import Landing
from tidemart.plans.registry import all_queries

QUERIES = all_queries()


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF0001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dedup_limits_versions_before_the_shuffle(spark, landing_small):
    plan = plan_of(latest_live(landing_small.raw("fact_po_raw"), ("buyer_org_id", "po_date", "id")))
    tree = plan.split("\n\n")[0]
    lines = [ln.strip(" :+-") for ln in tree.splitlines()]
    # bottom-up: a partial WindowGroupLimit sits below the Exchange that feeds the window
    idx_ex = min(i for i, ln in enumerate(lines) if ln.startswith("Exchange"))  # the dedup shuffle
    assert any(ln.startswith("WindowGroupLimit") for ln in lines[idx_ex + 1:])


def test_factorised_plans_do_not_join_raw_many_sides(spark, landing_small):
    # every join input of the factorised snapshot is aggregated per key first:
    # the literal plan joins four raw sides, the factorised one none
    lit = plan_of(M.snapshot_org(landing_small, dt.date(2001, 8, 1), plan="joins"))
    fac = plan_of(M.snapshot_org(landing_small, dt.date(2001, 8, 1)))
    def aggregates(p):
        return len(re.findall(r"^\(\d+\) (Hash|Sort|ObjectHash)Aggregate", p, re.M))
    assert aggregates(fac) > aggregates(lit)


def test_stored_landing_scan_is_pruned_and_filtered(spark, landing_small):
    root = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    for t in ["fact_po_raw", "dim_organization_raw"]:
        write_compacted(landing_small.raw(t), t, f"{root}/{t}")
    L = Landing.from_path(spark, root)
    plan = plan_of(M.daily_revenue_territory(L, dt.date(2001, 8, 1)))
    scan = next(b for b in plan.split("\n\n") if "Scan parquet" in b and "fact_po_raw" in b)
    assert "PartitionFilters: [isnotnull(month" in scan and "(month" in scan and ">= 200105" in scan
    assert "GreaterThanOrEqual(po_date,2001-05-03" in scan
    read = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert "po_number" not in read and "delivery_address" not in read   # unused columns not read


def test_session_is_configured_for_scale(spark):
    from tidemart.session import scale_conf
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    conf = scale_conf(100 * 2 ** 40)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 100 * 2 ** 40 // (512 * 2 ** 20)


def test_bucketed_landing_dedups_without_shuffle(spark, landing_small):
    from tidemart.plans.landing import write_bucketed
    from tidemart.session import scratch_path
    root = scratch_path(spark, "bucketed", tempfile.mkdtemp(prefix="b-", dir="/tmp").rsplit("/", 1)[-1])
    for t in ["fact_po_raw", "dim_organization_raw"]:
        write_bucketed(landing_small.raw(t), t, f"tm_test_{t}", f"{root}/{t}", buckets=8)
    L = Landing.from_tables(spark, "tm_test_")
    key = ("buyer_org_id", "po_date", "id")
    tree = plan_of(latest_live(L.raw("fact_po_raw"), key)).split("\n\n")[0]
    assert "Window" in tree and "Exchange" not in tree          # clustered by the bucket key
    got = sorted(map(tuple, M.daily_revenue_territory(L, dt.date(2001, 8, 1)).collect()), key=repr)
    want = sorted(map(tuple, M.daily_revenue_territory(landing_small, dt.date(2001, 8, 1)).collect()), key=repr)
    assert got == want


def test_materialized_bucketed_store_matches_plain(spark):
    from tidemart.plans.landing import Landing as _L
    plain = _L.materialized(spark, SF0001)
    bucketed = _L.materialized(spark, SF0001, bucketed=True)
    a = sorted(map(tuple, M.snapshot_org(plain, dt.date(2001, 8, 1)).collect()), key=repr)
    b = sorted(map(tuple, M.snapshot_org(bucketed, dt.date(2001, 8, 1)).collect()), key=repr)
    assert a == b


def test_key_sets_of_joined_sides_open_only_the_months_of_the_window(spark, landing_small):
    import tempfile

    from tidemart.plans.landing import write_landing
    root = tempfile.mkdtemp(prefix="months-", dir="/tmp")
    for t in ("fact_po_raw", "fact_po_item_raw"):
        write_landing(landing_small.raw(t), t, f"{root}/{t}", by_month=True)
    L = Landing.from_path(spark, root)
    plan = M.daily_category_spend(L, dt.date(2001, 8, 1))._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan parquet" in x and "po_date" in x]
    assert len(scans) >= 2 and all("month" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)
