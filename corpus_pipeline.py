"""Corpus pipeline: documents -> clean, deduplicated, decontaminated, mixed token files.

``STAGES`` are functions (spark, docs, sf_dir) -> DataFrame; ``run`` writes each
stage's rows as Parquet in the shared checkpoint folder and rereads them as the
next one's documents, so a lost executor repeats tasks of one stage only. All
but the last return the columns of ``documents``.

``ORACLE_SQL`` is None: the learned score, the SimHash search and the tokenizer have no
SQL form; tests/llm/test_pipeline.py compares the stages with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import read_table, scratch, stored, text_key
from tidemart.llm.decontaminate import contaminated_rows
from tidemart.llm.jaccard_join import first_of_components
from tidemart.llm.mixing import mix
from tidemart.llm.token_output import token_files
from tidemart.llm.toxicity import keep_clean, learn

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5; the model is fitted on the labels of the rows given."""
    return keep_clean(docs, learn(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each component of 5-word shingle Jaccard similarity 0.8 or more.

    Rows with the same doc_id are one document and stay or go together; texts
    without words link with nothing and stay. A row without an id is a document of its
    own: it goes if its component has a doc_id, else one row of the component stays.
    """
    stay = first_of_components(docs, words=5, num=80, den=100).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "single")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & text_key(F.col("doc_id"), F.col("text")).eqNullSafe(F.col("_key"))
    # equal texts without an id: the first row by a hash of the row
    turn = Window.partitionBy(text_key(F.col("doc_id"), F.col("text"))).orderBy(F.xxhash64(*docs.columns))
    one = docs.where("doc_id IS NULL").join(stay.where("single"), same, "left_semi").withColumn(
        "_turn", F.row_number().over(turn)).where("_turn = 1").select(*docs.columns)
    return docs.join(stay.where("NOT single"), same, "left_semi").unionByName(one)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window similar (0.8 or more) to a benchmark item.

    Rows with the same doc_id are one document; rows without one are judged by their own text.
    """
    found = contaminated_rows(docs, read_table(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    key = text_key(F.col("doc_id"), F.col("text"))
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & key.eqNullSafe(F.col("_key")), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights: a document taken k times stands k times, one not taken goes.

    Equal rows are taken alike.
    """
    row = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    plan = mix(docs.withColumn("_row", row), keep=("_row",)).where("repeats > 0").groupBy(
        F.col("doc_id").alias("_id"), "_row").agg(F.max("repeats").alias("_repeats"))
    both = docs.withColumn("_row2", row).join(
        plan, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_row2")))
    return both.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_repeats")))).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows; returns doc_id, start, n_tokens, ids_crc32 as read back from them."""
    return token_files(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read_table(spark, sf_dir, "documents"), scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"{path}/{name}")
    return docs
