"""Result limits within the job (S11): N rows pass, N + 1 throw, a refused result changes nothing."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tidemart.session import child_names
from tidemart.sources.copy import ResultTooLarge, collect_within, write_within


@pytest.mark.parametrize("parts", [1, 5])
def test_write_rows(spark, parts):
    base = tempfile.mkdtemp(prefix="limits-", dir="/tmp")
    df = spark.range(0, 100, 1, parts)
    write_within(df, f"{base}/t", max_rows=100)
    assert spark.read.parquet(f"{base}/t").count() == 100
    with pytest.raises(ResultTooLarge):
        write_within(spark.range(0, 101, 1, parts), f"{base}/t", max_rows=100)
    assert spark.read.parquet(f"{base}/t").count() == 100 and child_names(spark, base) == ["t"]
    write_within(df.limit(0), f"{base}/t", max_rows=0)  # a smaller result replaces it
    assert spark.read.parquet(f"{base}/t").count() == 0


def test_write_bytes(spark):
    base = tempfile.mkdtemp(prefix="limits-", dir="/tmp")
    df = spark.range(0, 10, 1, 3).select(F.lit("x" * 20).alias("s"))  # {"s":"..."}: 28 bytes a row
    write_within(df, f"{base}/t", max_bytes=280)
    for limit in (279, 27):  # the total, and one row by itself
        with pytest.raises(ResultTooLarge):
            write_within(df, f"{base}/t", max_bytes=limit)
    assert spark.read.parquet(f"{base}/t").count() == 10


def test_a_task_over_the_limit_stops_early(spark):
    base = tempfile.mkdtemp(prefix="limits-", dir="/tmp")
    rows = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b
    df = spark.range(0, 2_000_000, 1, 1).mapInArrow(seen, "id long")
    with pytest.raises(ResultTooLarge):
        write_within(df, f"{base}/t", max_rows=10)
    assert rows.value < 2_000_000 and child_names(spark, base) == []


def test_other_errors_stay_what_they_are(spark):
    base = tempfile.mkdtemp(prefix="limits-", dir="/tmp")
    with pytest.raises(Exception, match="not today") as e:
        write_within(spark.range(5).select(F.raise_error(F.lit("not today")).alias("x")), f"{base}/t")
    assert not isinstance(e.value, ResultTooLarge)
    with pytest.raises(ValueError):
        write_within(spark.range(5).withColumnRenamed("id", "_row"), f"{base}/t")


def test_collect(spark):
    df = spark.range(0, 10, 1, 4)
    assert len(collect_within(df, max_rows=10)) == 10
    with pytest.raises(ResultTooLarge):
        collect_within(df, max_rows=9)
    assert len(collect_within(df, max_bytes=80)) == 10  # {"id":0}: 8 bytes a row
    with pytest.raises(ResultTooLarge):
        collect_within(df, max_bytes=79)
    assert collect_within(df.limit(0), max_rows=0) == []
