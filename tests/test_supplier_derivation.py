"""The smallest supplier per order is aggregated before its shuffle."""

from mart_helpers import SF0001

from tidemart.sources.fixtures import Fixtures
from tidemart.sources.tables import TableSource


def test_min_supplier_is_reduced_before_the_shuffle(spark):
    df = Fixtures(TableSource(spark, SF0001))._min_supplier()
    lines = [ln.strip(" +-:") for ln in df._jdf.queryExecution().executedPlan().toString().splitlines()]
    exchange = next(i for i, ln in enumerate(lines) if ln.startswith("Exchange"))
    assert "partial_min" in lines[exchange + 1]
    want = {}
    for r in TableSource(spark, SF0001).read("lineitem", "l_orderkey", "l_suppkey").collect():
        want[r[0]] = min(r[1], want.get(r[0], r[1]))
    assert {r[0]: r[1] for r in df.collect()} == want
