"""Line dedup: levelled sorted runs of line hashes, compacted periodically.

Documents arrive in batches. The keys (hashes of normalised lines) of all earlier
batches are kept in *runs*: tables bucketed and sorted by key, so that a batch's
keys are merge-anti-joined with a run without reshuffling it. The keys that no run
holds form a new run of level 0; when a level has ``fanout`` runs they are merged
into one run of the next level. Only DataFrame operations are used.

Recovery: every run and every staged batch is a table in the shared checkpoint
folder, written by Spark's committers, so lost executors only repeat tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import LOWER, UPPER, id_order, scratch, shuffle_partitions, stored

STRIP = " \t\n\x0b\f\r"


class LineRuns:
    """Sorted runs of (key), by level, in one folder.

    ``buckets`` should match the shuffle partitions of the session: then the
    anti-join of a batch with a run needs no exchange on the run's side.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, fanout: int = 3):
        self.spark, self.path, self.fanout = spark, path, fanout
        self.buckets = buckets or shuffle_partitions(spark)
        self.levels: list[list[str]] = [[]]

    def runs(self) -> list[str]:
        """Names of all runs, the newest level first."""
        return [r for level in self.levels for r in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """Rows of ``keys`` whose key no run holds."""
        for run in self.runs():
            keys = keys.join(self.spark.table(run).select("key"), "key", "left_anti")
        return keys

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (keys.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key")
         .option("path", f"{self.path}/{name}").format("parquet").saveAsTable(name))
        return name

    def add(self, new: DataFrame) -> DataFrame:
        """Store keys that no run holds as a run of level 0; returns the run."""
        name = self._write(new)
        rows = self.spark.table(name)
        self.levels[0].append(name)
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= self.fanout:
                self._compact(k)
        return rows

    def _compact(self, k: int) -> None:
        merged = None
        for run in self.levels[k]:
            part = self.spark.table(run)
            merged = part if merged is None else merged.unionByName(part)
        if k + 1 == len(self.levels):
            self.levels.append([])
        self.levels[k + 1].append(self._write(merged))
        self.levels[k] = []


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIP)), UPPER, LOWER)


def _rows(documents: DataFrame) -> DataFrame:
    """_doc, doc_id, _row (tells rows of one doc_id apart), lines. A null text is one empty line."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text")).select(
        "doc_id", id_order(F.col("doc_id")).alias("_doc"), F.xxhash64("_text").alias("_row"),
        F.split("_text", "\n", -1).alias("_lines"))


def repeated_lines(documents: DataFrame, path: str, batches: int = 4, min_chars: int = 10,
                   fanout: int = 3) -> DataFrame:
    """(_doc, _row, pos): lines that an earlier document holds, by number from 0.

    Documents are taken in ``batches`` ascending ranges of doc_id, so that the
    first batch (and in it the smallest doc_id) that holds a key keeps it.
    """
    spark = documents.sparkSession
    rows = _rows(documents)
    cuts = documents.select(id_order(F.col("doc_id")).alias("_doc")).approxQuantile(
        "_doc", [i / batches for i in range(1, batches)], 0.001) if batches > 1 else []
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + (F.col("_doc") > F.lit(int(cut))).cast("int")
    lines = (rows.select("_doc", "_row", batch.alias("batch"), F.posexplode("_lines").alias("pos", "_line"))
             .withColumn("_key", line_key(F.col("_line")))
             .where(F.char_length("_key") >= min_chars)
             .select("_doc", "_row", "batch", "pos", F.unhex(F.md5("_key")).alias("key")))
    staged = f"{path}/lines"
    lines.write.partitionBy("batch").parquet(staged)
    lines = spark.read.schema(lines.select("_doc", "_row", "pos", "key", "batch").schema).parquet(staged)
    runs = LineRuns(spark, f"{path}/runs", fanout=fanout)
    dropped = f"{path}/dropped"
    for b in range(len(cuts) + 1):
        part = lines.where(F.col("batch") == b).drop("batch")
        first = part.groupBy("key").agg(F.min("_doc").alias("_doc"))
        new = runs.add(runs.unseen(first))
        (part.join(new, ["key", "_doc"], "left_anti").select("_doc", "_row", "pos")
         .write.parquet(f"{dropped}/batch={b}"))
    return spark.read.schema("_doc long, _row long, pos int").parquet(
        *[f"{dropped}/batch={b}" for b in range(len(cuts) + 1)])


def dedup_lines(documents: DataFrame, batches: int = 4, min_chars: int = 10, fanout: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (kept lines joined by newline), one row per input row.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased.
    Keys of at least ``min_chars`` code points that several documents hold stay
    only in the smallest doc_id holding them. A null or empty text is one empty
    line; a null doc_id counts as one document behind all others; rows with the
    same doc_id are one document's; other columns are ignored.
    """
    path = scratch(documents.sparkSession, "line_dedup")
    gone = repeated_lines(documents, path, batches, min_chars, fanout)
    gone = gone.groupBy("_doc", "_row").agg(F.collect_set("pos").alias("_gone"))
    rows = _rows(documents).join(gone, ["_doc", "_row"], "left")
    keep = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.array_join("_lines", "\n")).otherwise(
        F.array_join(F.transform(keep, lambda i: F.get(F.col("_lines"), i)), "\n"))
    return rows.select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("text"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = """
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line),
first AS (SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
  SELECT k.*, coalesce(f.holder <> k.doc_id, false) AS gone
  FROM keyed k LEFT JOIN first f ON k.key = f.key AND length(k.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
