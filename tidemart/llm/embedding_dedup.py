"""Embedding near-dedup: cosine links within a label by int8 tile products with error bounds.

Vectors equal in every component are one class. Classes are ordered by label and a
coarse position code and cut into tiles; a tile carries its unit vectors as int8 numbers with
a scale each, and the length of what this rounding lost. The product of two tiles of int8 numbers is
exact, and the true cosine differs from it by at most |e_u| + |e_v| (1 + |e_u|): pairs whose
upper bound is below the threshold are done with, those whose lower bound is above it
are links, and only the rest is recomputed in double precision.

Tiles whose bounding boxes (of 16 orthogonal projections) are further apart than linked
vectors can be never meet. A pair of tiles returns its links as sums per vector and a spanning
forest, never as pairs, so a group of near copies costs as many rows as it has vectors in the tile.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import prepare_workers, read_table, scratch, stored
from tidemart.llm.components import components

TILE = 1024
TILE_BYTES = 1 << 21
NODE_BITS = 12
DIRECTIONS = 16
SLACK = 1e-9


@lru_cache(maxsize=8)
def directions(dim: int) -> np.ndarray:
    """Orthogonal directions (dim x at most 16), the same in every task."""
    q, _ = np.linalg.qr(np.random.default_rng(11).normal(size=(dim, dim if dim < DIRECTIONS else DIRECTIONS)))
    return q


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so that no square over- or underflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def position_codes(unit: np.ndarray) -> np.ndarray:
    """Order along a Z-curve over the first 8 projections, 4 bits each: near vectors tend to be near in it."""
    p = unit @ directions(unit.shape[1])[:, :8]
    cell = np.clip((p * math.sqrt(unit.shape[1]) * 3 + 8).astype(np.int64), 0, 15)
    code = np.zeros(len(unit), np.int64)
    for bit in (3, 2, 1, 0):
        for k in range(cell.shape[1]):
            code = (code << 1) | ((cell[:, k] >> bit) & 1)
    return code


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, the scale of each, and an upper bound on the length of unit - scale * int8."""
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(unit - scale[:, None] * q, axis=1) * (1 + 1e-12) + 1e-15


def _usable(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components, offsets, and which vectors are not null, not zero and finite throughout."""
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes NaN
    offsets = lists.offsets.to_numpy().astype(np.int64)
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    full = np.append(0, np.cumsum(values != 0))
    ok = (bad[offsets[1:]] == bad[offsets[:-1]]) & (full[offsets[1:]] > full[offsets[:-1]])
    return values, offsets, ok & ~np.asarray(lists.is_null())


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label, and dim, position code, 128-bit key and packed components of a usable vector (else null)."""
    for b in batches:
        values, offsets, ok = _usable(b.column(2))
        ok &= ~np.asarray(b.column(1).is_null())
        dim = np.diff(offsets)
        code = np.zeros(b.num_rows, np.int64)
        for d in np.unique(dim[ok]):
            rows = np.flatnonzero(ok & (dim == d))
            code[rows] = position_codes(unit_vectors(values[offsets[rows][:, None] + np.arange(d)]))
        values = values + 0.0  # -0.0 is 0.0
        raw = [values[offsets[r]:offsets[r + 1]].tobytes() if ok[r] else None for r in range(b.num_rows)]
        key = [hashlib.blake2b(v, digest_size=16).digest() if v is not None else None for v in raw]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(dim.astype(np.int32), mask=~ok), pa.array(code, mask=~ok),
             pa.array(key, pa.binary()), pa.array(raw, pa.binary())],
            names=["vec_id", "label", "dim", "code", "key", "vec"])


def _tile_schema(label: str) -> str:
    return (f"tile long, label {label}, dim int, n int, ids array<long>, many array<long>, keys array<binary>, "
            "low array<double>, high array<double>, scale binary, err binary, q binary, x binary")


def _cut_tiles(rows: int, label_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by label, dim and code; a tile never spans two labels or dims."""
        tile = TaskContext.get().partitionId() << 24
        held: list[dict] = []

        def out() -> pa.RecordBatch:
            nonlocal tile
            dim = held[0]["dim"]
            x = np.frombuffer(b"".join(r["vec"] for r in held), np.float64).reshape(len(held), dim)
            unit = unit_vectors(x)
            q, scale, err = quantised(unit)
            at = unit @ directions(dim)
            single = np.array_equal(x, x.astype(np.float32))
            row = {"tile": tile, "label": held[0]["label"], "dim": dim, "n": len(held), "ids": [r["vec_id"] for r in held],
                   "many": [r["many"] for r in held], "keys": [r["key"] for r in held],
                   "low": at.min(0).tolist(), "high": at.max(0).tolist(),
                   "scale": scale.tobytes(), "err": err.tobytes(), "q": q.tobytes(),
                   "x": (x.astype(np.float32) if single else x).tobytes()}
            tile += 1
            held.clear()
            kinds = [pa.int64(), label_type, pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.list_(pa.binary()), pa.list_(pa.float64()), pa.list_(pa.float64()), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))

        for b in batches:
            for r in b.to_pylist():
                full = held and len(held) >= max(1, min(rows, 1 << NODE_BITS, TILE_BYTES // (8 * held[0]["dim"])))
                if full or held and (r["label"], r["dim"]) != (held[0]["label"], held[0]["dim"]):
                    yield out()
                held.append(r)
        if held:
            yield out()
    return run


def tile_links(a: dict, b: dict, threshold: float, strip: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked rows (i of a, j of b) of two tiles, by strips of a; within one tile i < j.

    A tile has q (int8), scale, err and x (components as given).
    """
    same = a is b
    exact = np.float32 if 127 * 127 * a["q"].shape[1] < 1 << 24 else np.float64  # integer sums stay exact in this type
    qb, xa, xb = b["q"].astype(exact).T, unit_vectors(a["x"].astype(np.float64)), unit_vectors(b["x"].astype(np.float64))
    for at in range(0, len(a["q"]), strip):
        rows = slice(at, at + strip)
        about = (a["q"][rows].astype(exact) @ qb).astype(np.float64)
        about *= a["scale"][rows, None]
        about *= b["scale"]
        err = a["err"][rows, None]
        bound = err + b["err"] * (1 + err) + SLACK
        maybe = about + bound >= threshold
        if same:
            maybe &= np.arange(len(b["q"])) > np.arange(at, at + len(about))[:, None]
        i, j = np.nonzero(maybe)
        sure = (about - bound)[i, j] >= threshold
        for s in range(0, len(i), 1 << 16):
            part = np.flatnonzero(~sure[s:s + (1 << 16)]) + s
            sure[part] = np.einsum("ij,ij->i", xa[at + i[part]], xb[j[part]]) >= threshold
        if sure.any():
            yield at + i[sure], j[sure]


def hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of linked nodes in place; a label is the smallest node of its component."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _opened(t: dict) -> dict:
    n, dim = t["n"], t["dim"]
    kind = np.float32 if len(t["x"]) == 4 * n * dim else np.float64
    return {"tile": t["tile"], "many": np.array(t["many"], np.int64), "scale": np.frombuffer(t["scale"]), "err": np.frombuffer(t["err"]),
            "q": np.frombuffer(t["q"], np.int8).reshape(n, dim), "x": np.frombuffer(t["x"], kind).reshape(n, dim)}


def _compare(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        """One pair of tiles (or one tile with itself): node, other (of the forest) and n (vectors linked)."""
        tiles = [_opened(t) for t in sorted(table.to_pylist(), key=lambda t: t["tile"])]
        a, b = tiles[0], tiles[-1]
        size = len(a["q"])
        count = np.zeros(size + (0 if a is b else len(b["q"])), np.int64)
        label = np.arange(len(count))
        for i, j in tile_links(a, b, threshold):
            k = j if a is b else j + size
            count += np.bincount(i, b["many"][j], len(count)).astype(np.int64) + np.bincount(k, a["many"][i], len(count)).astype(np.int64)
            hook(label, i, k)
        node = (a["tile"] << NODE_BITS) + np.arange(len(count))
        node[size:] = (b["tile"] << NODE_BITS) + np.arange(len(count) - size)
        hit = np.flatnonzero(count)
        return pa.table({"node": node[hit], "other": node[label[hit]], "n": count[hit]})
    return run


def tile_pairs(heads: DataFrame, threshold: float) -> DataFrame:
    """a <= b: tiles of one label and dim whose boxes are near enough for a link.

    Linked unit vectors are at most sqrt(2 - 2 threshold) apart, and so are their projections. Tiles meet
    by the cells of the first projection that they cover, cells as wide as that distance,
    so tiles of one label are not all paired with one another.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    cell = lambda c: F.floor(c / F.lit(max(reach, 1e-3))).cast("int")
    heads = heads.withColumn("from", cell(F.element_at("low", 1))).withColumn("to", cell(F.element_at("high", 1) + reach))
    a = heads.withColumn("cell", F.explode(F.sequence("from", "to")))
    b = heads.select("label", "dim", F.col("tile").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
                     F.col("from").alias("from_b"), F.col("to").alias("to_b"))
    b = b.withColumn("cell", F.explode(F.sequence("from_b", "to_b")))
    gap = F.zip_with(F.arrays_zip("low", "high"), F.arrays_zip("low_b", "high_b"), lambda x, y: F.greatest(
        F.lit(0.0), y["low_b"] - x["high"], x["low"] - y["high_b"]))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)
    return a.join(b, ["label", "dim", "cell"]).where(
        (F.col("tile") <= F.col("b")) & (F.col("cell") == F.greatest("from", "from_b")) & (apart <= reach * reach)).select(
        F.col("tile").alias("a"), "b")


def link_embeddings(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per input row.

    Rows link if their labels are equal and not null, their vectors have as many components, and the
    cosine of these is ``threshold`` or more. n_links counts rows; component_id is the smallest
    vec_id reachable by links, and kept whether it is the row's own. Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing. Repeated rows are rows of their own and link with one another. A row
    without an id counts like any other; it is kept only if no row of its component has one.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    prepare_workers(spark)
    path = scratch(spark, "embedding_dedup")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    kind, arrow_kind = rows.schema["label"].dataType.simpleString(), rows.select("label").limit(0).toArrow().schema.field(0).type
    ready = rows.mapInArrow(_prepare, f"vec_id long, label {kind}, dim int, code long, key binary, vec binary")
    classes = ready.where("key IS NOT NULL").groupBy("label", "dim", "code", "key").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("many"), F.first("vec").alias("vec"))
    ordered = classes.repartitionByRange("label", "dim", "code", "key").sortWithinPartitions("label", "dim", "code", "key")
    tiles = stored(ordered.mapInArrow(_cut_tiles(tile, arrow_kind), _tile_schema(kind)), f"{path}/tiles")
    pairs = stored(tile_pairs(tiles.select("tile", "label", "dim", "low", "high"), threshold), f"{path}/pairs")
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"))
    found = sides.join(tiles.select("tile", "dim", "n", "many", "scale", "err", "q", "x"), "tile").groupBy("a", "b").applyInArrow(
        _compare(threshold), "node long, other long, n long")
    found = stored(found, f"{path}/links")
    label = components(found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")), f"{path}/components")
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    nodes = tiles.select("tile", "label", F.posexplode(F.arrays_zip("ids", "many", "keys"))).select(
        (F.shiftleft("tile", NODE_BITS) + F.col("pos")).alias("node"), F.col("label").alias("_label"), "col.*")
    nodes = nodes.join(links, "node", "left").join(label.withColumnRenamed("label", "top"), "node", "left").select(
        "_label", "keys", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"),
        F.coalesce("top", "node").alias("top"), "ids")
    nodes = stored(nodes, f"{path}/nodes")
    least = nodes.groupBy("top").agg(F.min("ids").alias("least"))
    classes = nodes.join(least, "top").select("_label", "keys", "n_links", "least")
    out = ready.select("vec_id", "label", "key").join(classes, (F.col("label") == F.col("_label")) & (F.col("key") == F.col("keys")), "left")
    component = F.when(F.col("keys").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(read_table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT vec_id, coalesce(max(n), 0)::BIGINT AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach LEFT JOIN degree ON a = vec_id GROUP BY vec_id
"""
