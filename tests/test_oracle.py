"""Every registered query against its DuckDB oracle on the sf0.001 inputs."""

import pytest

from mart_helpers import SF0001
from oracle import compare, duck

from tidemart.plans.registry import all_oracle_sql, all_queries

QUERIES = all_queries()
ORACLE = all_oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF0001), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


# group counts of the fixture mapping (FIXTURES.md, sf0.001)
EXPECTED_GROUPS = {
    "agg_daily_buyer": 57, "agg_daily_seller": 107, "agg_daily_category_spend": 177,
    "agg_daily_supplier_spend": 57, "agg_daily_rfq_pipeline": 33, "agg_daily_revenue_territory": 57,
    "agg_daily_engagement": 397, "snapshot_org_daily": 150, "snapshot_inventory_sku_daily": 1449,
}


@pytest.mark.parametrize("name", sorted(EXPECTED_GROUPS))
def test_group_counts(spark, name):
    assert QUERIES[name](spark, SF0001).count() == EXPECTED_GROUPS[name]


def test_entry_runs(spark):
    import importlib.util
    import os
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    # the optional queries of the training-data operators may lack SQL
    assert set(QUERIES) <= set(mod.oracle_sql()) <= set(mod.queries())


def test_results_do_not_depend_on_the_python_time_zone(spark, con):
    import os
    import time
    old = os.environ.get("TZ")
    os.environ["TZ"] = "Asia/Kolkata"
    time.tzset()
    try:
        for name in ["cdc_snapshot_plus_tail", "report_cdc_lag", "cdc_map_po", "agg_daily_buyer"]:
            ok, msg = compare(QUERIES[name](spark, SF0001), con, ORACLE[name])
            assert ok, f"{name}: {msg}"
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()
