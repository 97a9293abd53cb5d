"""Snapshot reads, bounded copies and load modes."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemart.session import _fs, delete_path


def jdbc_snapshot(spark: SparkSession, url: str, table: str, pk: str, lower: int, upper: int,
                  rows: int, rows_per_partition: int = 50_000, properties: dict | None = None) -> DataFrame:
    """Initial snapshot split into primary-key ranges, one task per range
    (``snapshot_num_rows_per_partition``). Needs the database's JDBC driver jar."""
    parts = max(1, math.ceil(rows / rows_per_partition))
    return spark.read.jdbc(url, table, column=pk, lowerBound=lower, upperBound=upper,
                           numPartitions=parts, properties=properties or {})


def key_bounds(df: DataFrame, key: str, parts: int) -> list:
    """Up to ``parts`` - 1 keys that cut ``df`` into ranges of about equal row counts, whatever gaps the key has: quantiles
    from one mergeable sketch (rank error under 1 / (20 * parts) of the rows)."""
    if parts < 2:
        return []
    cuts = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, F.array(*[F.lit(c) for c in cuts]), 20 * parts).alias("q")).first()["q"]
    return sorted(set(found or []))


def range_predicates(key: str, bounds: Sequence) -> list[str]:
    """One SQL condition per range of ``bounds`` (numbers); together they hold each row once, NULL keys in the first."""
    if not bounds:
        return ["1 = 1"]
    inner = [f"{key} > {a} AND {key} <= {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} <= {bounds[0]} OR {key} IS NULL", *inner, f"{key} > {bounds[-1]}"]


def jdbc_snapshot_by_depth(spark: SparkSession, url: str, table: str, pk: str, lower: int, upper: int, rows: int,
                           rows_per_partition: int = 50_000, properties: dict | None = None) -> DataFrame:
    """S1 for keys with gaps: a first pass reads the keys only, in even ranges; the snapshot then has one task per
    range of about ``rows_per_partition`` rows. Needs the database's JDBC driver jar."""
    keys = jdbc_snapshot(spark, url, f"(SELECT {pk} FROM {table}) k", pk, lower, upper, rows, rows_per_partition, properties)
    bounds = key_bounds(keys, pk, max(1, math.ceil(rows / rows_per_partition)))
    return spark.read.jdbc(url, table, predicates=range_predicates(pk, bounds), properties=properties or {})


def snapshot_by_depth(df: DataFrame, key: str, parts: int) -> DataFrame:
    """S1 over files or tables: the same ranges as filters that reach each scan (row groups outside a range are
    skipped in files sorted by the key); the parts are read independently."""
    out = None
    for p in range_predicates(key, key_bounds(df, key, parts)):
        part = df.filter(p)
        out = part if out is None else out.unionByName(part)
    return out


def bounded_copy(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """``SELECT * ... LIMIT n`` made deterministic by an order (the source
    order is unspecified). Planned as a per-task top-n then a merge of n rows
    per task, so the bound is the feature, not a shortcut."""
    return df.orderBy(*order_by).limit(n)


def insert_if_absent(new: DataFrame, existing: DataFrame, pk: Sequence[str],
                     first_by: Sequence[str | Column] | None = None) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: the rows of ``new`` whose key
    is not in ``existing``; among new rows sharing a key the first by
    ``first_by`` wins. Returns only the rows to append."""
    cand = _first_per_key(new, pk, first_by) if first_by else new.dropDuplicates(list(pk))
    return cand.join(existing.select(*pk), list(pk), "left_anti").select(*new.columns)


def _first_per_key(df: DataFrame, pk: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    from pyspark.sql import Window
    w = Window.partitionBy(*pk).orderBy(*order)
    return df.withColumn("_rk", F.row_number().over(w)).filter("_rk = 1").drop("_rk")


def truncate_and_load(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table's content (no foreign keys, so load order is free)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


class ResultTooLarge(RuntimeError):
    pass


def guard_result_size(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 10 * 2 ** 30) -> DataFrame:
    """``max_result_rows`` / ``max_result_bytes`` with overflow = throw,
    checked before any collect by one partial aggregation over the result (rows,
    and bytes of the rows as JSON text)."""
    row = df.select(F.octet_length(F.to_json(F.struct(*df.columns))).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    if row["n"] > max_rows:
        raise ResultTooLarge(f"result has {row['n']} rows, more than {max_rows} rows")
    if row["b"] > max_bytes:
        raise ResultTooLarge(f"result has {row['b']} bytes, more than {max_bytes} bytes")
    return df


def _row_bytes(columns: Sequence[str]) -> Column:
    return F.octet_length(F.to_json(F.struct(*columns)))


def collect_within(df: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 10 * 2 ** 30) -> list:
    """S11 for results that go to the driver, in one execution: at most ``max_rows`` + 1 rows are taken, and the
    bytes of each task's rows (as JSON text) are observed as they pass."""
    seen = Observation()
    rows = df.limit(max_rows + 1).observe(seen, F.sum(_row_bytes(df.columns)).alias("b")).collect()
    if len(rows) > max_rows:
        raise ResultTooLarge(f"result has more than {max_rows} rows")
    size = seen.get["b"] or 0
    if size > max_bytes:
        raise ResultTooLarge(f"result has {size} bytes, more than {max_bytes} bytes")
    return rows


def write_within(df: DataFrame, path: str, max_rows: int = 1_000_000, max_bytes: int = 10 * 2 ** 30) -> None:
    """S11 for results that are written, in one execution: Parquet at ``path`` if the result is within its limits.

    A task that passes the row limit by itself, or meets a row larger than the byte limit, fails the job there; the totals
    are observed in the same job. The rows go to a folder beside ``path`` that takes its place only if the
    totals hold, so a refused result leaves what stood at ``path``."""
    spark, path = df.sparkSession, path.rstrip("/")
    if "_bytes" in df.columns or "_row" in df.columns:
        raise ValueError("the names _bytes and _row are taken by the guard")
    # the low 33 bits of this id number the rows of a task
    rows = df.withColumn("_bytes", _row_bytes(df.columns)).withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    over = (F.col("_row") >= max_rows) | (F.col("_bytes") > max_bytes)
    note = F.lit(f"result has more than {max_rows} rows or {max_bytes} bytes")
    seen, new = Observation(), f"{path}.new-{uuid.uuid4().hex}"
    guarded = rows.filter(F.when(over, F.raise_error(note).cast("boolean")).otherwise(True)).observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b")).drop("_bytes", "_row")
    try:
        guarded.write.parquet(new)
        n, b = seen.get["n"], seen.get["b"] or 0
        if n > max_rows or b > max_bytes:
            raise ResultTooLarge(f"result has {n} rows and {b} bytes, more than {max_rows} rows or {max_bytes} bytes")
    except Exception as exc:
        delete_path(spark, new)
        if not isinstance(exc, ResultTooLarge) and "result has more than" in str(exc):
            raise ResultTooLarge(f"result has more than {max_rows} rows or {max_bytes} bytes") from exc
        raise
    target, fs = _fs(spark, path)
    fs.delete(target, True)
    if not fs.rename(_fs(spark, new)[0], target):
        raise OSError(f"could not move {new} to {path}")


# Destination type names the mirror definitions accept, and how
# each is written from Spark here ("jdbc" needs the database's driver jar on
# the classpath; the others have no connector in this build).
TARGET_FORMATS = {
    "PARQUET": "parquet",
    "POSTGRES": "jdbc",
    "MYSQL": "jdbc",
    "CLICKHOUSE": "jdbc",
    "SNOWFLAKE": None,
    "BIGQUERY": None,
    "MONGO": None,
}


def write_target(df: DataFrame, target: str, location: str, mode: str = "append",
                 options: dict | None = None) -> None:
    """Write to a destination named by type. ``location`` is a path for
    PARQUET and a table name for JDBC targets (``options`` carries url, user,
    password, driver)."""
    fmt = TARGET_FORMATS.get(target.upper())
    if fmt is None:
        raise ValueError(f"no connector for target type {target!r} in this build; "
                         f"supported: {[k for k, v in TARGET_FORMATS.items() if v]}")
    w = df.write.mode(mode).options(**(options or {}))
    if fmt == "parquet":
        w.parquet(location)
    else:
        w.format("jdbc").option("dbtable", location).save()
