"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a fixed pseudo-random order, replayed
up to ``max_repeats`` times. A document's virtual finish time is the source's
cumulative words (itself included) divided by the source's target; the mix is all
(document, repeat) items in order of finish time, cut at the total budget.

Cumulative sums are taken in two levels so that no source, however large, lies in
one task: hash buckets of a source are summed first, and each bucket is then ranked
on its own. The cut is found by range bins of finish time, summed and refined
twice, so that only the rows of one fine bin are sorted. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import scratch, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
COARSE, FINE = 1 << 10, 1 << 20
HEX_DIGITS = 3


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """source, source_size, target from rows of (source, size).

    Sources in code-point order, null last, take the weights in turn. Shares of
    the total above ``max_repeats`` times a source's size are given to the others
    by weight, until none is above: target = min(cap, level * weight). The table
    has a row per source, which is what the windows here see.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn.cast("int") + 1)
    per = per.withColumn("_w", w).withColumn("_cap", F.col("source_size") * max_repeats)
    rank = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before, every = rank.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
             / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    per = per.withColumn("_level", level).withColumn("_free", F.col("_level") <= F.col("_cap") / F.col("_w"))
    found = F.min(F.when(F.col("_free"), F.struct(F.col("_cap") / F.col("_w"), F.col("_level").alias("l")))).over(every)
    target = F.least(F.col("_cap").cast("double"), F.coalesce(found["l"] * F.col("_w"), F.col("_cap").cast("double")))
    return per.select("source", "source_size", target.alias("target"))


def _cut(items: DataFrame, budget: int, max_repeats: int) -> float:
    """Largest finish time up to which the items, in order of finish time, fit the budget."""
    done, low = 0, None
    for step, inside in ((COARSE, None), (FINE, COARSE)):
        part = items if inside is None else items.where(F.floor(F.col("finish") * inside) == low)
        bins = part.groupBy(F.floor(F.col("finish") * step).alias("bin")).agg(F.sum("size").alias("size"))
        run = F.sum("size").over(Window.orderBy("bin"))
        over = bins.withColumn("_run", run + F.lit(done)).where(F.col("_run") > budget).orderBy("bin").first()
        if over is None:
            return float("inf")
        low, done = over["bin"], over["_run"] - over["size"]
    last = items.where(F.floor(F.col("finish") * FINE) == low)
    run = F.sum("size").over(Window.orderBy("finish")) + F.lit(done)
    best = last.withColumn("_run", run).where(F.col("_run") <= budget).agg(F.max("finish")).first()[0]
    if best is None:
        best = items.where(F.floor(F.col("finish") * FINE) < low).agg(F.max("finish")).first()[0]
    return -1.0 if best is None else float(best)


def mix(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = 3,
        keep: tuple[str, ...] = (), seed: str = "mix") -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, repeats, finish, taken, + ``keep``.

    ``size`` is the number of white-space separated words (null text: 0),
    ``repeats`` how often the mix takes the document (whole, 0 to max_repeats
    times), ``taken`` = size * repeats, ``finish`` the finish time of its first
    turn. The order inside a source is that of md5(seed:doc_id), so reruns agree;
    equal rows take neighbouring turns. Null ids and sources are ordinary values;
    documents of size 0 fall where their turn falls. Columns not in ``keep`` are ignored.
    """
    spark = documents.sparkSession
    path = scratch(spark, "mixing")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    base = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("_key"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    base = stored(base.withColumn("_bucket", F.substring("_key", 1, HEX_DIGITS)), f"{path}/base")
    per = stored(source_targets(base.select("source", "size"), weights, max_repeats), f"{path}/targets")
    budget = per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # offset of each (source, bucket): a window over at most 16 ** HEX_DIGITS rows a source
    buckets = base.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("source", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    offsets = buckets.withColumnRenamed("source", "_s").join(
        per.withColumnRenamed("source", "_s2"), F.col("_s").eqNullSafe(F.col("_s2"))).drop("_s2")
    inner = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = base.withColumn("_in", F.sum("size").over(inner))
    ranked = ranked.join(offsets.withColumnRenamed("_bucket", "_b"),
                         F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    # a source of size 0 has nothing to take: its turns come at time 0
    finish = [F.when(F.col("target") > 0, (F.col("_offset") + F.col("_in") + F.col("source_size") * e)
                     / F.col("target")).otherwise(F.lit(0.0)) for e in range(max_repeats)]
    ranked = stored(ranked.select("doc_id", "source", "size", "source_size", "target",
                                  F.array(*finish).alias("_finish"), *[f"_keep_{c}" for c in keep]), f"{path}/ranked")
    items = ranked.where(F.col("size") > 0).select("size", F.explode("_finish").alias("finish"))
    cut = _cut(items, budget, max_repeats)
    repeats = F.size(F.filter("_finish", lambda x: x <= F.lit(cut)))
    return ranked.select(
        "doc_id", "source", "size", "source_size", "target", repeats.alias("repeats"),
        F.element_at("_finish", 1).alias("finish"), (F.col("size") * repeats).alias("taken"),
        *[F.col(f"_keep_{c}").alias(c) for c in keep])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = """
WITH doc AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM doc GROUP BY source),
lev AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(w) OVER ()
               - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM per),
found AS (SELECT arg_min(level, cap / w) AS l FROM lev WHERE level <= cap / w),
target AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(l * w, cap::DOUBLE)) AS target FROM lev, found),
turn AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS run
  FROM doc d JOIN target t ON d.source IS NOT DISTINCT FROM t.source),
item AS (
  SELECT size, (run + source_size * e)::DOUBLE / target AS finish
  FROM turn, (SELECT unnest([0, 1, 2])::BIGINT AS e) WHERE size > 0),
seen AS (SELECT finish, sum(size) OVER (ORDER BY finish) AS used FROM item),
cut AS (SELECT max(finish) AS f FROM seen WHERE used <= (SELECT sum(size) FROM doc))
SELECT doc_id, size, source_size, target,
       (size * ((run::DOUBLE / target <= f)::BIGINT + ((run + source_size)::DOUBLE / target <= f)::BIGINT
                + ((run + 2 * source_size)::DOUBLE / target <= f)::BIGINT))::BIGINT AS taken
FROM turn, cut
"""
