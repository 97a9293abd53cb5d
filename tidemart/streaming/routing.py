"""One-pass landing of many tables from one change feed, and the progress of such streams.

``land_changes`` parses a batch once per listed table. Here the payload is parsed once, to a
VARIANT, and a batch is written by a single job, partitioned by table and month:

    <root>/route=<table>/stream=<name>-<id>/batch=<n>/month=<yyyymm>/   (month 0: table without a date)
    <root>/route=_rejected/...                                        payload as it came, with its reason

The typed columns are taken from the VARIANT when a table is read (``read_routed``). The write replaces
the partitions of its own stream and batch (dynamic overwrite), so a replayed batch changes nothing.
The counters of a batch (records, newest version and arrival by table) are observed in the
same job and kept in one small file per stream, ``<root>/_progress/<stream>/<batch>.json``.

Malformed is: a payload that is no JSON object, a field that does not read as its column's type, an integer
column with anything but an integer. An integer in quotes is accepted (``land_changes`` refuses it).
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemart.functions.exprs import yyyymm
from tidemart.operators.cdc import fill_defaults
from tidemart.plans.landing import Landing
from tidemart.plans.store import read_small, write_small
from tidemart.session import child_names, delete_path, path_exists, scratch_path
from tidemart.sources.schemas import IS_DELETED, LANDING, SYNCED_AT, VERSION, LandingTable, type_default
from tidemart.streaming.apply import REJECTED, TooManyRejects, stream_id

ROW, NO_MONTH, PROGRESS = "row", 0, "_progress"
INTEGERS = (T.IntegerType, T.LongType)
STORED = (f"{VERSION} bigint, {IS_DELETED} int, {SYNCED_AT} timestamp, {ROW} variant, reason string, sent_to string, payload string, "
          "route string, stream string, batch bigint, month int")
PROGRESS_ROWS = T.StructType([T.StructField("stream", T.StringType()), T.StructField("table_name", T.StringType()), T.StructField("last_batch", T.LongType()),
                              T.StructField("records", T.LongType()), T.StructField("version", T.LongType()), T.StructField("synced_at", T.TimestampType())])


def _image(t: LandingTable, texts: bool = False) -> Column:
    """The row image as a struct of the table's types, or of texts; NULL for what does not read so."""
    kinds = ((f.name, "string" if texts else f.dataType.simpleString()) for f in t.data.fields)
    return F.try_variant_get(F.col(ROW), "$", "struct<" + ",".join(f"`{n}`:{k}" for n, k in kinds) + ">")


def _typed(name: str) -> str:
    return f"_typed_{name}"


def _text(name: str) -> str:
    return f"_text_{name}"


def _malformed(name: str) -> Column:
    typed, text = F.col(_typed(name)), F.col(_text(name))

    def wrong(f: T.StructField) -> Column:
        lost = typed[f.name].isNull()
        if isinstance(f.dataType, INTEGERS):
            lost = lost | (typed[f.name].cast("string") != text[f.name])
        return text[f.name].isNotNull() & lost
    # what is no object (an array, a scalar, no JSON at all) does not read as a struct
    return text.isNull() | reduce(Column.__or__, (wrong(f) for f in LANDING[name].data.fields))


def _by_table(tables: Iterable[str], value, otherwise: Column) -> Column:
    out = F
    for name in tables:
        out = out.when(F.col("_table") == name, value(name))
    return out.otherwise(otherwise)


def _month(name: str) -> Column:
    t = LANDING[name]
    if not t.month_of:
        return F.lit(NO_MONTH)
    field = next(f for f in t.data.fields if f.name == t.month_of)
    return yyyymm(F.coalesce(F.col(_typed(name))[t.month_of], type_default(field.dataType)))


def routed(batch: DataFrame, tables: Iterable[str]) -> DataFrame:
    """Each record once: its ``route`` (the table, or ``_rejected`` with a ``reason``), ``month`` and parsed row."""
    tables = list(tables)
    parsed = batch.withColumn(ROW, F.try_parse_json("payload"))
    # both images are read once a record, in a projection of their own; written into the checks of
    # each field they would be read again for every field, as common parts of CASE branches are not shared
    images = {}
    for name in tables:
        mine = F.col("_table") == name
        images[_typed(name)] = F.when(mine, _image(LANDING[name]))
        images[_text(name)] = F.when(mine, _image(LANDING[name], texts=True))
    listed = F.coalesce(F.col("_table").isin(tables), F.lit(False))
    reason = F.when(~listed, F.lit("unlisted table")).when(_by_table(tables, _malformed, F.lit(False)), F.lit("malformed payload"))
    kept = parsed.withColumns(images).withColumn("reason", reason).withColumn("month", F.when(
        F.col("reason").isNull(), _by_table(tables, _month, F.lit(NO_MONTH))).otherwise(NO_MONTH).cast("int"))
    good = F.col("reason").isNull()
    return kept.select(
        F.when(good, F.col("_table")).otherwise(REJECTED).alias("route"), "month", VERSION, IS_DELETED, SYNCED_AT,
        F.when(good, F.col(ROW)).alias(ROW), "reason", F.when(~good, F.col("_table")).alias("sent_to"),
        F.when(~good, F.col("payload")).alias("payload"))


def routing_writer(root: str, tables: Iterable[str], stream: str, checkpoint: str, max_malformed: float = 0.01):
    """``foreachBatch`` function: one job that reads a batch once and writes all its tables.

    A batch with a larger share of malformed records than ``max_malformed`` fails and takes its partitions back.
    """
    root, tables = root.rstrip("/"), list(tables)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, f"{stream}-{stream_id(batch.sparkSession, checkpoint)}"
        seen, here = Observation(f"routing {own} {batch_id}"), lambda t: F.col("route") == t
        counters = [F.count_if(F.col("reason") == "malformed payload").alias("malformed"), F.count_if(here(REJECTED)).alias("rejected")]
        for t in tables:
            counters += [F.count_if(here(t)).alias(f"{t}.records"), F.max(F.when(here(t), F.col(VERSION))).alias(f"{t}.version"),
                         F.max(F.when(here(t), F.unix_micros(SYNCED_AT))).alias(f"{t}.synced")]
        # AQE splits a large table's month over several tasks and merges small ones; observed above
        # the exchange, in the tasks whose results count once
        rows = routed(batch, tables).withColumn("stream", F.lit(own)).withColumn("batch", F.lit(batch_id).cast("long"))
        (rows.hint("rebalance", "route", "month").observe(seen, *counters).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("route", "stream", "batch", "month").parquet(root))
        got = {k: v or 0 for k, v in seen.get.items()}
        total = sum(got[f"{t}.records"] for t in tables) + got["malformed"]
        if got["malformed"] > max_malformed * total:
            for route in [*tables, REJECTED]:
                delete_path(spark, f"{root}/route={route}/stream={own}/batch={batch_id}")
            raise TooManyRejects(f"batch {batch_id}: {got['malformed']} of {total} records are malformed")
        _advance(spark, f"{root}/{PROGRESS}/{own}", batch_id, {
            t: {k: got[f"{t}.{k}"] for k in ("records", "version", "synced")} for t in tables if got[f"{t}.records"]})
    return write


def route_changes(feed: DataFrame, root: str, checkpoint: str | None, tables: Iterable[str], processing_time: str | None = None,
                  name: str = "routing", max_malformed: float = 0.01) -> StreamingQuery:
    """Start the landing stream; without ``processing_time`` it takes what is there (availableNow) and stops."""
    if checkpoint is None:
        checkpoint = scratch_path(feed.sparkSession, "streams", name)
    w = (feed.writeStream.foreachBatch(routing_writer(root, tables, name, checkpoint, max_malformed))
         .option("checkpointLocation", checkpoint))
    return (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()


# --- reading -----------------------------------------------------------------------------------

def _read_route(spark: SparkSession, root: str, route: str) -> DataFrame:
    root = root.rstrip("/")
    path = f"{root}/route={route}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).option("basePath", root).parquet(path)


def read_routed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Landed rows of a table (all versions, streams and batches) in its types, NULL as the type's default;
    with ``month`` if the table has a partition date. No rows if none have been landed."""
    t = LANDING[table]
    rows = _read_route(spark, root, table).withColumn("r", _image(t))
    month = ["month"] if t.month_of else []
    typed = rows.select(*[F.col("r")[c].alias(c) for c in t.columns], SYNCED_AT, IS_DELETED, VERSION, *month)
    return fill_defaults(typed, t.columns)


def routed_landing(spark: SparkSession, root: str) -> Landing:
    """The routed tables as the marts read them."""
    return Landing(lambda table: read_routed(spark, root, table))


def read_routed_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Records that could not be landed: ``table_name`` as sent, ``reason``, metadata and payload."""
    return _read_route(spark, root, REJECTED).select(
        F.col("sent_to").alias("table_name"), VERSION, IS_DELETED, SYNCED_AT, "payload", "reason")


# --- progress and lag -----------------------------------------------------------------------------

def _states(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-len(".json")]) for n in child_names(spark, path) if n.endswith(".json") and not n.startswith("_"))


def _advance(spark: SparkSession, path: str, batch_id: int, counted: dict) -> None:
    """Totals after batch ``batch_id``: those before it plus ``counted``. A replay starts from the same totals
    before it, as the files of the last two batches are kept."""
    numbers = _states(spark, path)
    before = [n for n in numbers if n < batch_id]
    totals = json.loads(read_small(spark, f"{path}/{before[-1]:012d}.json")) if before else {}
    for t, c in counted.items():
        old = totals.get(t, {"records": 0, "version": c["version"], "synced": c["synced"]})
        totals[t] = {"records": old["records"] + c["records"], "version": max(old["version"], c["version"]),
                     "synced": max(old["synced"], c["synced"])}
    write_small(spark, f"{path}/{batch_id:012d}.json", json.dumps(totals), replace=True)
    for n in before[:-1]:
        delete_path(spark, f"{path}/{n:012d}.json")


def landed_progress(spark: SparkSession, root: str) -> DataFrame:
    """A row per stream and table: last batch, records landed, newest version and arrival. Reads the small files only."""
    root, rows = root.rstrip("/"), []
    for stream in child_names(spark, f"{root}/{PROGRESS}"):
        path = f"{root}/{PROGRESS}/{stream}"
        numbers = _states(spark, path)
        if numbers:
            totals = json.loads(read_small(spark, f"{path}/{numbers[-1]:012d}.json"))
            rows += [(stream, t, numbers[-1], c["records"], c["version"],
                      _dt.datetime.fromtimestamp(c["synced"] / 1e6, _dt.timezone.utc)) for t, c in totals.items()]
    return spark.createDataFrame(rows, PROGRESS_ROWS)


def log_end(log: DataFrame) -> DataFrame:
    """A row per table of a change log in envelope form: records, newest version and arrival."""
    return log.groupBy(F.col("_table").alias("table_name")).agg(
        F.count(F.lit(1)).alias("log_records"), F.max(VERSION).alias("log_version"), F.max(SYNCED_AT).alias("log_synced_at"))


def stream_lag(end: DataFrame, progress: DataFrame) -> DataFrame:
    """R7 while streams run: per table, how far what all streams have landed trails the log's end.

    ``pending_records`` counts rejected records too, as they are not landed; a table of which nothing
    has been landed has all its records pending and NULL versions."""
    landed = progress.groupBy("table_name").agg(F.sum("records").alias("landed_records"), F.max("version").alias("landed_version"),
                                                F.max("synced_at").alias("landed_synced_at"))
    j = end.join(landed, "table_name", "left").withColumn("landed_records", F.coalesce("landed_records", F.lit(0).cast("long")))
    return j.select("table_name", "log_records", "landed_records", (F.col("log_records") - F.col("landed_records")).alias("pending_records"),
                    "log_version", "landed_version", (F.col("log_version") - F.col("landed_version")).alias("version_lag"),
                    (F.unix_seconds("log_synced_at") - F.unix_seconds("landed_synced_at")).alias("lag_secs"))
