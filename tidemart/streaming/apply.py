"""Structured Streaming ingest of change records into landing tables.

A change feed is a directory of Parquet files, each holding change records in
an envelope (one stream for many tables):

    _table STRING, _cdc_version LONG, _cdc_is_deleted INT,
    _cdc_synced_at TIMESTAMP, payload STRING (JSON row image)

``land_changes`` runs one streaming query whose ``foreachBatch`` splits each
micro-batch by table, parses the row image with the table's landing schema,
turns NULLs into type defaults and writes the rows of each table present to a
folder of its own stream and batch, by month. Nothing of a batch is held in
memory between its jobs. Malformed records and records of
unlisted tables are kept under ``<root>/_rejected``. The stream's checkpoint holds
the source offsets (the "log position"); after a failure Spark replays the same
batch id with the same files, and the overwrite of that batch folder makes the
replay idempotent.
Duplicate or out-of-order records are resolved by version when the landing
table is read (``latest_live``), never by arrival order.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions.exprs import yyyymm
from tidemart.operators.cdc import fill_defaults
from tidemart.session import child_names, delete_path, move_path, path_exists, scratch_path
from tidemart.sources.schemas import IS_DELETED, LANDING, SYNCED_AT, VERSION

REJECTED, STAGED = "_rejected", "_staged"
ENVELOPE = T.StructType([
    T.StructField("_table", T.StringType(), False),
    T.StructField(VERSION, T.LongType(), False),
    T.StructField(IS_DELETED, T.IntegerType(), False),
    T.StructField(SYNCED_AT, T.TimestampType(), False),
    T.StructField("payload", T.StringType(), False),
])


def to_envelope(landing_rows: DataFrame, table: str, keep: Iterable[Column] = ()) -> DataFrame:
    """Wrap landing-shaped rows as change records (the feed producer's side), with columns to ``keep`` in front."""
    cols = LANDING[table].columns
    return landing_rows.select(
        *keep,
        F.lit(table).alias("_table"), F.col(VERSION), F.col(IS_DELETED), F.col(SYNCED_AT),
        F.to_json(F.struct(*cols)).alias("payload"))


CORRUPT = "_corrupt_record"


def parsed_records(batch: DataFrame, table: str) -> DataFrame:
    """Change records of one table with their row image (C5: typed): ``r``, the
    metadata columns, and ``_corrupt_record``: the payload if it does not parse as
    the table's schema (a wrong type in one field is enough), else NULL."""
    t = LANDING[table]
    schema = T.StructType([*t.data.fields, T.StructField(CORRUPT, T.StringType())])
    r = F.from_json("payload", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = batch.filter(F.col("_table") == table).select(
        "*", r.alias("r"))
    bad = F.col("r").isNull() | F.col("r")[CORRUPT].isNotNull()
    return rows.withColumn(CORRUPT, F.when(bad, F.coalesce("payload", F.lit("null"))))


def checked_records(batch: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Each record once, with the row image of its table (``_row_<table>``, NULL for other tables) and
    ``reason``: why it cannot be landed (of a table that is not listed: C3 leaves it out, but counts it; or with a
    malformed payload), else NULL. Every reading of it parses the payloads again."""
    tables = list(tables)
    listed = F.coalesce(F.col("_table").isin(tables), F.lit(False))
    images, good = {}, F
    for name in tables:
        mine, t = F.col("_table") == name, LANDING[name]
        schema = T.StructType([*t.data.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        images[_row(name)] = F.when(mine, F.from_json("payload", schema, options))
        good = good.when(mine, F.col(_row(name)).isNotNull() & F.col(_row(name))[CORRUPT].isNull())
    reason = F.when(~listed, F.lit("unlisted table")).when(~(good.otherwise(True) if tables else F.lit(True)), F.lit("malformed payload"))
    return batch.withColumns(images).withColumn("reason", reason)


def _row(table: str) -> str:
    return f"_row_{table}"


def checked_rows(checked: DataFrame, table: str) -> DataFrame:
    """Landing rows of the well-formed records of a table (C5/C6: typed, defaults)."""
    t = LANDING[table]
    rows = checked.filter((F.col("_table") == table) & F.col("reason").isNull())
    return fill_defaults(rows.select(*[F.col(_row(table))[c].alias(c) for c in t.columns], SYNCED_AT, IS_DELETED, VERSION), t.columns)


def counted(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """The records; the action that reads them counts the ``rejected`` ones. Filters stay above the
    counter: pushed below it they would parse a payload again."""
    seen = Observation()
    return checked.observe(seen, F.count("reason").alias("rejected")), seen


def parse_envelope(batch: DataFrame, table: str) -> DataFrame:
    """Well-formed change records of one table -> landing rows (C5/C6: typed, defaults)."""
    t = LANDING[table]
    parsed = parsed_records(batch, table).filter(F.col(CORRUPT).isNull())
    rows = parsed.select(*[F.col("r")[c].alias(c) for c in t.columns], SYNCED_AT, IS_DELETED, VERSION)
    return fill_defaults(rows, t.columns)


def change_feed(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the change-record directory (schema fixed, no inference)."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


class TooManyRejects(RuntimeError):
    """More of a batch is malformed than the stated rate."""


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a stream's checkpoint: the same after a restart, new
    if the checkpoint was lost."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def batch_writer(root: str, tables: Iterable[str], stream: str, checkpoint: str,
                 max_malformed: float = 0.01):
    """``foreachBatch`` function that lands a batch (C12: one stream, many tables).

    Rows go to ``<root>/<table>/stream=<name>-<id>/batch=<n>/month=<yyyymm>``. The
    stream's id is in its checkpoint, so a restart rewrites its own batch, while
    other feeds, and a feed whose checkpoint was lost, write elsewhere and erase
    nothing (records landed twice collapse when read). Only tables with records
    are written. Records that cannot be landed go to ``<root>/_rejected``; a batch
    with a larger share of malformed ones than ``max_malformed`` fails.

    A table's records are parsed and written in one pass that counts the malformed ones on
    its way, to ``<root>/_staged``; they are moved into place when all counts are known. Tasks stream
    their rows, so executors need no more memory for a larger batch. Only the records of tables
    with malformed ones are parsed again, to keep those aside.
    """
    root, tables = root.rstrip("/"), list(tables)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"stream={stream}-{stream_id(spark, checkpoint)}/batch={batch_id}"
        staged = f"{root}/{STAGED}/{own.replace('/', '-')}"
        listed = F.when(F.col("_table").isin(tables), F.col("_table"))  # NULL for all others: few groups
        counts = {r["_table"]: r["n"] for r in batch.groupBy(listed.alias("_table")).agg(F.count(F.lit(1)).alias("n")).collect()}
        unlisted, malformed = counts.pop(None, 0), {}
        try:
            for t in (t for t in tables if counts.get(t)):
                checked, seen = counted(checked_records(batch.filter(F.col("_table") == t), [t]))
                rows, month = checked_rows(checked, t), LANDING[t].month_of
                if month:
                    rows = rows.withColumn("month", yyyymm(month))
                w = rows.write.mode("overwrite")
                (w.partitionBy("month") if month else w).parquet(f"{staged}/{t}")
                malformed[t] = seen.get["rejected"]
            bad, total = sum(malformed.values()), sum(counts.values())
            if bad > max_malformed * total:
                raise TooManyRejects(f"batch {batch_id}: {bad} of {total} records are malformed")
            if bad or unlisted:
                clean = F.coalesce(F.col("_table").isin([t for t, n in malformed.items() if not n]), F.lit(False))
                checked, _ = counted(checked_records(batch.filter(~clean), tables))
                checked.filter(F.col("reason").isNotNull()).select(*batch.columns, "reason").write.mode("overwrite").parquet(f"{staged}/{REJECTED}")
            for name in [*([REJECTED] if bad or unlisted else []), *malformed]:
                move_path(spark, f"{staged}/{name}", f"{root}/{name}/{own}")
        finally:
            delete_path(spark, staged)
    return write


def land_changes(feed: DataFrame, root: str, checkpoint: str | None, tables: Iterable[str],
                 processing_time: str | None = None, name: str = "landing",
                 max_malformed: float = 0.01) -> StreamingQuery:
    """S4 + C11 + C12: start the landing query.

    ``processing_time=None`` drains what is there (``availableNow``) and stops;
    a duration such as ``"10 seconds"`` keeps running (the idle flush).
    ``checkpoint=None`` puts the offsets under the shared checkpoint folder
    (``<spark.checkpoint.dir>/streams/<name>``).
    """
    if checkpoint is None:
        checkpoint = scratch_path(feed.sparkSession, "streams", name)
    w = (feed.writeStream.foreachBatch(batch_writer(root, tables, name, checkpoint, max_malformed))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def read_landed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Landed rows of a table (all versions, streams and batches), with ``month`` if
    the table has a partition date; no rows if none have been landed."""
    t = LANDING[table]
    path = f"{root.rstrip('/')}/{table}"
    names = [f.name for f in t.schema.fields]
    if not path_exists(spark, path):
        return spark.createDataFrame([], t.schema)
    return spark.read.parquet(path).select(*names, *(["month"] if t.month_of else []))


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Records that could not be landed, with their reason."""
    path = f"{root.rstrip('/')}/{REJECTED}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([*ENVELOPE.fields, T.StructField("reason", T.StringType())]))
    return spark.read.parquet(path)


# --- second way: merge each micro-batch into a current-state table --------------

def _generations(spark: SparkSession, state_root: str) -> list[tuple[int, str]]:
    """Complete generations, oldest first: Spark's commit leaves ``_SUCCESS`` last."""
    out = []
    for name in child_names(spark, state_root):
        if name.startswith("gen-") and path_exists(spark, f"{state_root}/{name}/_SUCCESS"):
            out.append((int(name.split("-")[1]), name))
    return sorted(out)


def read_state(spark: SparkSession, state_root: str, table: str) -> DataFrame | None:
    """Current state (one row per key, tombstones kept) of an upserted table."""
    done = _generations(spark, state_root)
    if not done:
        return None
    t = LANDING[table]
    return spark.read.parquet(f"{state_root}/{done[-1][1]}").select(*[f.name for f in t.schema.fields])


def upsert_writer(state_root: str, table: str, checkpoint: str, key_mode: str = "sort_key"):
    """``foreachBatch`` function: state = newest version per key of the last state
    and the batch, written as a new generation ``gen-<n>-<stream id>-<batch>``.

    A generation counts once Spark has committed it; nothing is overwritten or named
    by a pointer, so a crash at any point leaves the last complete state in
    place. A replayed batch that is already in the last generation changes nothing;
    a lost checkpoint applies its records again, which the versions absorb. The
    last two generations are kept (readers may still be on the older). Only keys in
    the batch are re-deduplicated; suited to dimension-sized state — large facts
    use append + dedup on read + compaction."""
    from tidemart.operators.cdc import latest_version

    t = LANDING[table]
    key = t.key(key_mode)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done, tag = _generations(spark, state_root), f"{stream_id(spark, checkpoint)}-{batch_id}"
        if done and done[-1][1].endswith(f"-{tag}"):
            return
        rows = parse_envelope(batch, table)
        if not done:
            state = latest_version(rows, key)
        else:
            prev = spark.read.parquet(f"{state_root}/{done[-1][1]}").select(*rows.columns)
            keys = rows.select(*key).distinct()
            touched = prev.join(keys, list(key), "left_semi")
            untouched = prev.join(keys, list(key), "left_anti")
            state = untouched.unionByName(latest_version(touched.unionByName(rows), key)).select(*rows.columns)
        n = done[-1][0] + 1 if done else 0
        state.write.mode("overwrite").parquet(f"{state_root}/gen-{n:09d}-{tag}")
        for _, old in done[:-1]:
            delete_path(spark, f"{state_root}/{old}")
    return write


def upsert_changes(feed: DataFrame, state_root: str, table: str, checkpoint: str | None = None,
                   key_mode: str = "sort_key") -> StreamingQuery:
    """Keyed upsert by version into ``state_root`` (availableNow)."""
    if checkpoint is None:
        checkpoint = scratch_path(feed.sparkSession, "streams", f"upsert-{table}")
    return (feed.writeStream.foreachBatch(upsert_writer(state_root, table, checkpoint, key_mode))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
