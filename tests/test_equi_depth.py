"""Snapshot ranges of equal depth (S1): skewed keys, every row once."""

import pytest
from pyspark.sql import functions as F

from tidemart.sources.copy import key_bounds, range_predicates, snapshot_by_depth


def _skewed(spark):
    """20,000 unique ids: most in a narrow range, the others over twelve decimal places."""
    return spark.range(20_000).select(F.expr("CASE WHEN id % 20 > 0 THEN id ELSE id * id * 10000 + 50000 END").alias("id"), F.col("id").alias("v"))


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_parts_within_twice_of_each_other(spark, parts):
    df = _skewed(spark)
    bounds = key_bounds(df, "id", parts)
    counts = [df.filter(p).count() for p in range_predicates("id", bounds)]
    assert len(counts) == parts and sum(counts) == 20_000 and max(counts) <= 2 * min(counts)
    if parts == 40:  # even ranges, as a plain split of the key gives: nearly all in one
        low, high = df.agg(F.min("id"), F.max("id")).first()
        assert df.filter(F.col("id") < low + (high - low) / parts).count() > 18_000


def test_every_row_once(spark):
    df = spark.createDataFrame([(None,), (None,), (3,), (3,), (3,), (-5,), (9,)], "id long")
    for parts in (1, 2, 3, 50):
        assert sorted(map(repr, snapshot_by_depth(df, "id", parts).collect())) == sorted(map(repr, df.collect()))
    for empty in (df.limit(0), df.filter("id IS NULL")):  # no keys, no bounds
        assert key_bounds(empty, "id", 4) == [] and snapshot_by_depth(empty, "id", 4).count() == empty.count()


def test_ranges_reach_the_scan(spark, tmp_path):
    _skewed(spark).write.parquet(f"{tmp_path}/t")
    plan = snapshot_by_depth(spark.read.parquet(f"{tmp_path}/t"), "id", 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(id,") == 3 and "Exchange" not in plan
