"""Exact top-k inner-product search with KD-trees per shard.

Rows are dealt to shards by a hash of vec_id. Each shard's rows are ordered by a
KD-tree: median splits on the widest dimension down to small leaves, each with its
tight bounding box. A query's score on any row of a box is at most
sum(max(q_i * low_i, q_i * high_i)); a query visits the leaves best bound first and
stops when no bound reaches its current k-th score. Queries that visit the same leaf
in the same round are scored by one matrix product.

Search runs in two waves over (query block, shard) pairs: every block is first
searched in one home shard; its k-th scores are then propagated to the block's
searches in all other shards, where they prune from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import read_table, scratch, stored

LEAF = 128
SHARD_ROWS = 8192
BLOCK_QUERIES = 2048
NO_SCORE, NO_ID = -2 ** 63, 2 ** 63 - 1
EXACT = 2.0 ** 53


def _quantised(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, lists = b.column(0), b.column(1)
            values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes NaN
            offsets = lists.offsets.to_numpy()
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            ok = (bad[offsets[1:]] == bad[offsets[:-1]]) & ~np.asarray(lists.is_null()) & ~np.asarray(ids.is_null())
            with np.errstate(invalid="ignore", over="ignore"):
                grid = np.floor(values * scale)
            rows = np.flatnonzero(ok)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)), pa.array([grid[offsets[r]:offsets[r + 1]].tobytes() for r in rows], pa.binary())],
                names=["vec_id", "vec"])
    return run


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """vec_id, vec: each component x as floor(scale * x), packed as doubles (exact integers).

    Rows with a null id, a null vector, or a null or non-finite component are left
    out; rows equal in id and vector count once.
    """
    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vec_col).cast("array<double>").alias("embedding"))
    return src.mapInArrow(_quantised(scale), "vec_id long, vec binary").dropDuplicates(["vec_id", "vec"])


def _matrix(vecs, dim: int | None = None) -> np.ndarray:
    rows = [np.frombuffer(v, np.float64) for v in vecs]
    dim = max([dim or 0, *map(len, rows)])
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def kd_order(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Row order in which every leaf is contiguous, and the leaf ends."""
    order, ends, todo = np.arange(len(x)), [], [(0, len(x))]
    while todo:
        a, b = todo.pop()
        part = x[order[a:b]]
        spread = part.max(0) - part.min(0) if b > a and x.shape[1] else np.zeros(1)
        if b - a <= leaf or spread.max() == 0:  # a heap of equal rows is cut into leaves without splitting planes
            ends += [*range(min(a + leaf, b), b, leaf), b]
            continue
        mid = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, int(spread.argmax())], mid, kind="introselect")]
        todo += [(a + mid, b), (a, a + mid)]
    return order, np.array(ends, np.int64)


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id", kind="stable")
    x, ids = _matrix(pdf["vec"]), pdf["vec_id"].to_numpy(np.int64)
    order, ends = kd_order(x)
    x, ids = x[order], ids[order]
    return pd.DataFrame([{"shard": int(pdf["shard"].iloc[0]), "dim": x.shape[1], "ids": ids.tobytes(),
                          "vecs": x.tobytes(), "ends": ends.tobytes()}])


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["vec_id", "vec"], kind="stable")
    x = _matrix(pdf["vec"])
    return pd.DataFrame([{"block": int(pdf["block"].iloc[0]), "q_dim": x.shape[1],
                          "q_ids": pdf["vec_id"].to_numpy(np.int64).tobytes(), "q_vecs": x.tobytes()}])


def _scores(q: np.ndarray, x: np.ndarray, safe: bool) -> np.ndarray:
    if safe:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
    exact = whole(q).dot(whole(x).T)
    return np.array([[max(NO_SCORE + 1, min(NO_ID, int(s))) for s in r] for r in exact], np.int64).reshape(len(q), len(x))


def search(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, ends: np.ndarray, k: int,
           bound: np.ndarray, bound_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores (queries x k, best first, padded) of rows that can be among the k best.

    ``bound``/``bound_id``: a k-th best known from other shards; rows behind it may be left out.
    """
    dim = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, dim - m.shape[1]))) for m in (q, x))
    starts = np.concatenate([[0], ends[:-1]])
    low = np.stack([x[a:b].min(0) for a, b in zip(starts, ends)])
    high = np.stack([x[a:b].max(0) for a, b in zip(starts, ends)])
    least_id = np.array([ids[a:b].min() for a, b in zip(starts, ends)])
    safe = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(dim, 1) < EXACT
    up = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T if safe else np.full((len(q), len(ends)), np.inf)
    visit = np.lexsort((np.broadcast_to(least_id, up.shape), -up), axis=-1)
    best = np.full((len(q), k), NO_SCORE, np.int64)
    best_id = np.full((len(q), k), NO_ID, np.int64)
    active = np.arange(len(q))
    for turn in range(len(ends)):
        leaf = visit[active, turn]
        reach = up[active, leaf]
        kth, kth_id = best[active, -1], best_id[active, -1]
        other = (bound[active] > kth) | ((bound[active] == kth) & (bound_id[active] < kth_id))
        kth, kth_id = np.where(other, bound[active], kth), np.where(other, bound_id[active], kth_id)
        # leaves come best bound first: once a bound is below the k-th score, all later ones are
        go_on = (kth == NO_SCORE) | (reach >= kth)
        useful = go_on & ((reach > kth) | (least_id[leaf] < kth_id) | (kth == NO_SCORE))
        doing, leaves = active[useful], leaf[useful]
        for f in np.unique(leaves):
            who, a, b = doing[leaves == f], starts[f], ends[f]
            s = np.concatenate([best[who], _scores(q[who], x[a:b], safe)], axis=1)
            i = np.concatenate([best_id[who], np.broadcast_to(ids[a:b], (len(who), b - a))], axis=1)
            own = i == q_ids[who][:, None]
            s[own], i[own] = NO_SCORE, NO_ID
            top = np.lexsort((i, -s.astype(np.float64)) if np.abs(s[s != NO_SCORE]).max(initial=0) < EXACT
                             else (i, ~s), axis=-1)[:, :k]
            best[who], best_id[who] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)
        active = active[go_on]
        if not len(active):
            break
    return best_id, best


def _search_pairs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                t = b.slice(r, 1).to_pylist()[0]
                q_ids, ids = np.frombuffer(t["q_ids"], np.int64), np.frombuffer(t["ids"], np.int64)
                q = np.frombuffer(t["q_vecs"], np.float64).reshape(len(q_ids), t["q_dim"])
                x = np.frombuffer(t["vecs"], np.float64).reshape(len(ids), t["dim"])
                if t["bound"] is None:
                    bound, bound_id = np.full(len(q), NO_SCORE), np.full(len(q), NO_ID)
                else:
                    bound, bound_id = (np.frombuffer(t[c], np.int64).reshape(len(q), k)[:, -1] for c in ("bound", "bound_id"))
                found, score = search(q_ids, q, ids, x, np.frombuffer(t["ends"], np.int64), k, bound, bound_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t["block"]], pa.int32()), pa.array([t["shard"]], pa.int32()),
                     *[pa.array([v], pa.binary()) for v in (t["q_ids"], found.tobytes(), score.tobytes())]],
                    names=["block", "shard", "q_ids", "found", "score"])
    return run


def _hits(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q, f, s in zip(*(b.column(i).to_pylist() for i in range(3))):
                q, f, s = (np.frombuffer(v, np.int64) for v in (q, f, s))
                ok = s != NO_SCORE
                yield pa.RecordBatch.from_arrays([pa.array(v[ok]) for v in (np.repeat(q, k), f, s)],
                                                 names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 64.0, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query's row, ties to smaller vec_id.

    ``is_query`` is a condition on vec_id. Every row with another vec_id is a
    candidate; shorter vectors are padded with zeros; fewer than k candidates
    give fewer rows. Scores outside 64 bits saturate. See ``quantised`` for nulls.
    """
    spark = vectors.sparkSession
    path = scratch(spark, "topk")
    rows = stored(quantised(vectors, id_col, vec_col, scale), f"{path}/rows")
    queries = rows.where(is_query)
    n, nq = rows.count(), queries.count()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(nq / block_queries))
    deal = lambda seed, m: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m)).cast("int")
    trees = stored(rows.withColumn("shard", deal("row", shards)).groupBy("shard").applyInPandas(
        _build, "shard int, dim int, ids binary, vecs binary, ends binary"), f"{path}/trees")
    asked = stored(queries.withColumn("block", deal("query", blocks)).groupBy("block").applyInPandas(
        _block, "block int, q_dim int, q_ids binary, q_vecs binary"), f"{path}/queries")
    # the home shard of a block is one that has rows
    home = trees.agg(F.sort_array(F.collect_list("shard")).alias("homes"))  # shard numbers only
    asked = asked.crossJoin(home).withColumn(
        "home", F.element_at("homes", F.col("block") % F.greatest(F.size("homes"), F.lit(1)) + 1)).drop("homes")
    kinds = "block int, shard int, q_ids binary, found binary, score binary"
    none = F.lit(None).cast("binary")
    first = stored(trees.join(asked, trees["shard"] == asked["home"]).drop("home").withColumn("bound", none)
                   .withColumn("bound_id", none).mapInArrow(_search_pairs(k), kinds), f"{path}/first")
    carried = asked.join(first.select("block", F.col("score").alias("bound"), F.col("found").alias("bound_id")), "block")
    pairs = carried.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(
        F.col("shard") != F.col("home")).drop("home")
    rest = trees.join(pairs, "shard").mapInArrow(_search_pairs(k), kinds)
    hits = first.unionByName(rest).select("q_ids", "found", "score").mapInArrow(
        _hits(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
