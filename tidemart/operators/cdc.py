"""Change-data-capture operators over append-only landing tables.

A landing table keeps every row version. Reading it "as of now" means: per
dedup key keep the highest ``_cdc_version`` (ties: later ``_cdc_synced_at``,
then later ``_cdc_seq``), and only then drop tombstones.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.sources.schemas import (
    IS_DELETED, LANDING, SEQ, SYNCED_AT, VERSION, LandingTable, type_default,
)


def _order_cols(df: DataFrame, version_col: str, content_tiebreak: bool = False) -> list[Column]:
    cols = [F.col(version_col).desc()]
    if SYNCED_AT in df.columns and version_col != SYNCED_AT:
        cols.append(F.col(SYNCED_AT).desc())
    if SEQ in df.columns:
        cols.append(F.col(SEQ).desc())
    if content_tiebreak:
        # for feeds that may carry *different* rows under the same version and
        # arrival time: a content hash makes every task attempt (a partition
        # recomputed after an executor loss) pick the same row. Off by default:
        # it reads every column, defeating column pruning, and a log position
        # version never repeats except for byte-identical replays.
        cols.append(F.xxhash64(*[F.col(c) for c in df.columns]).desc())
    return cols


def version_rank(df: DataFrame, key: Sequence[str], version_col: str = VERSION,
                 content_tiebreak: bool = False) -> DataFrame:
    """Adds ``_cdc_rank``: 1 for the newest version of each key, 2 for the one before..."""
    w = Window.partitionBy(*key).orderBy(*_order_cols(df, version_col, content_tiebreak))
    return df.withColumn("_cdc_rank", F.row_number().over(w))


def latest_version(df: DataFrame, key: Sequence[str], version_col: str = VERSION,
                   content_tiebreak: bool = False) -> DataFrame:
    """The newest version of each key, tombstones included.

    ``row_number() = 1`` over the key: Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle (a map-side reduction, so a key with
    millions of versions does not land whole in one task), pushes filters on
    key columns below the window and prunes unused columns.
    """
    return (version_rank(df, key, version_col, content_tiebreak)
            .filter(F.col("_cdc_rank") == 1)
            .drop("_cdc_rank"))


def latest_live(df: DataFrame, key: Sequence[str], version_col: str = VERSION,
                content_tiebreak: bool = False) -> DataFrame:
    """C1 + C2: newest version per key, then drop the key if that version is a
    tombstone. The tombstone filter must come after the dedup; before it, an
    older live version would come back."""
    return latest_version(df, key, version_col, content_tiebreak).filter(F.col(IS_DELETED) == 0)


def read_latest(df: DataFrame, table: str | LandingTable, live: bool = True,
                key_mode: str = "sort_key") -> DataFrame:
    """Latest (live) rows of a landing table, keyed by its sort key
    (the reference's behaviour) or by its primary key."""
    t = LANDING[table] if isinstance(table, str) else table
    key = t.key(key_mode)
    return latest_live(df, key) if live else latest_version(df, key)


def latest_by_max(df: DataFrame, key: Sequence[str], cols: Sequence[str],
                  version_col: str = VERSION) -> DataFrame:
    """C1 as a hash/sort aggregate: ``max_by(struct(cols), struct(version, ...))``.

    Partial aggregation collapses versions map-side. Name the columns: a
    ``struct('*')`` would defeat column pruning.
    """
    order = [version_col] + [c for c in (SYNCED_AT, SEQ) if c in df.columns and c != version_col]
    payload = [c for c in cols if c not in key]
    agg = F.max_by(F.struct(*payload), F.struct(*order)).alias("_v")
    return df.groupBy(*key).agg(agg).select(*key, *[F.col("_v")[c].alias(c) for c in payload])


def drop_columns(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    """C4: ``column_exclude_list``."""
    return df.drop(*list(exclude))


def fill_defaults(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NULL -> type default (0, '', 1970-01-01) for non-nullable landing columns."""
    targets = set(cols) if cols is not None else set(df.columns)
    return df.select(*[
        F.coalesce(F.col(f.name), type_default(f.dataType)).alias(f.name)
        if f.name in targets else F.col(f.name)
        for f in df.schema.fields
    ])


def map_to_landing(src: DataFrame, table: str | LandingTable,
                   mapping: Mapping[str, Column | str],
                   synced_at: Column | None = None, version: Column | None = None,
                   is_deleted: Column | None = None) -> DataFrame:
    """C5 + C6 + S5: project a source row onto a landing schema.

    ``mapping`` gives, per landing column, a source column name or an
    expression; unmapped columns take the type default. Casts follow the landing
    schema (e.g. double -> Decimal(18,4), timestamptz -> timestamp) and NULLs
    become defaults. Metadata defaults: now, version 0, not deleted.
    """
    t = LANDING[table] if isinstance(table, str) else table
    out = []
    for f in t.data.fields:
        m = mapping.get(f.name)
        e = type_default(f.dataType) if m is None else (F.col(m) if isinstance(m, str) else m)
        out.append(F.coalesce(e.cast(f.dataType), type_default(f.dataType)).alias(f.name))
    out.append((synced_at if synced_at is not None else F.current_timestamp())
               .cast(T.TimestampType()).alias(SYNCED_AT))
    out.append((is_deleted if is_deleted is not None else F.lit(0)).cast("int").alias(IS_DELETED))
    out.append((version if version is not None else F.lit(0)).cast("long").alias(VERSION))
    return src.select(*out)


def snapshot_plus_tail(snapshot: DataFrame, changes: DataFrame, key: Sequence[str],
                       live: bool = True) -> DataFrame:
    """Start from a snapshot (version 0) and apply the change tail.

    Overlap is harmless: a change with a higher version wins, an identical
    replay collapses in the dedup.
    """
    snap = snapshot
    if VERSION not in snap.columns:
        snap = snap.withColumn(VERSION, F.lit(0).cast("long"))
    if IS_DELETED not in snap.columns:
        snap = snap.withColumn(IS_DELETED, F.lit(0))
    if SYNCED_AT not in snap.columns:
        snap = snap.withColumn(SYNCED_AT, F.lit("1970-01-01 00:00:00").cast("timestamp"))
    both = snap.unionByName(changes, allowMissingColumns=True)
    return latest_live(both, key) if live else latest_version(both, key)


def compact(df: DataFrame, key: Sequence[str], keep_tombstones: bool = True) -> DataFrame:
    """C7 + C8: rewrite a change log to one row per key.

    ``keep_tombstones=True`` keeps the deleting version (the landing table's
    behaviour, so a later replay of an older version still loses to it);
    ``False`` drops deleted keys physically (``soft_delete`` off).
    """
    return latest_version(df, key) if keep_tombstones else latest_live(df, key)


def write_compacted(df: DataFrame, table: str | LandingTable, path: str,
                    keep_tombstones: bool = True) -> None:
    """C8 as a batch job: one version per key, month-partitioned, sorted by
    the key inside each file so Parquet min/max statistics prune key lookups."""
    t = LANDING[table] if isinstance(table, str) else table
    out = compact(df, t.sort_key, keep_tombstones)
    parts: list[str] = []
    if t.month_of:
        out = out.withColumn(
            "month", (F.year(t.month_of) * 100 + F.month(t.month_of)).cast("int"))
        parts = ["month"]
    # Range partitioning on (month, key): balanced by sampling even when one
    # org dominates (the key ends in the unique id), few month folders per
    # task, and sorted runs for row-group statistics.
    writer_df = out.repartitionByRange(*parts, *t.sort_key).sortWithinPartitions(*parts, *t.sort_key)
    w = writer_df.write.mode("overwrite")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def latest_live_incremental(base: DataFrame, tail: DataFrame, key: Sequence[str]) -> DataFrame:
    """C8 + C9 at scale: live rows of ``base`` (compacted: one version per key,
    tombstones kept) with a change ``tail`` applied.

    Only keys present in the tail are re-deduplicated. The tail's distinct keys
    are an aggregate, so AQE broadcasts them when their measured size is small
    and the (large, compacted) base is then filtered map-side by a semi and an
    anti join; otherwise the same joins run as shuffles.
    Equal to ``latest_live(base ∪ tail)``, including tail rows older than the
    base version (late replays lose to the base).
    """
    keys = tail.select(*key).distinct()
    touched = base.join(keys, list(key), "left_semi")
    untouched = base.join(keys, list(key), "left_anti")
    merged = latest_version(touched.unionByName(tail), key)
    return untouched.unionByName(merged).filter(F.col(IS_DELETED) == 0).select(*base.columns)
