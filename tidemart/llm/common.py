"""Helpers shared by the operators: scratch folders, whole-text readers, vectorised word hashing."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import scratch_path

LAST_ID = 2 ** 63 - 1
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# every ASCII byte but 0-9 and a-z (texts are lower-cased first)
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[0x41:0x5B] += 32

_SLICE = 1 << 20
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2 ** 64)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 1000


def prepare_workers(spark: SparkSession) -> None:
    """Settings of the Python workers.

    Arrow batches hold whole texts: at most 1,000 rows each, so that a task's memory
    follows its texts and not Spark's default of 10,000 rows. Workers import this
    package from where the driver has it (a cluster ships it with --py-files).
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def scratch(spark: SparkSession, op: str) -> str:
    """A new folder below the shared checkpoint folder, for one call of one operator."""
    prepare_workers(spark)
    return scratch_path(spark, "llm", op, uuid.uuid4().hex)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write and reread: cuts lineage, and a lost executor finds the rows again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_order(col) -> F.col:
    """doc_id with null last, as one id."""
    return F.coalesce(col.cast("long"), F.lit(LAST_ID))


def text_key(doc_id, text) -> F.col:
    """Names a row without an id by a hash of its text; null for rows with an id."""
    return F.when(doc_id.isNull(), F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets of a string column; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def slices(offsets: np.ndarray, most: int = _SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes; a longer text is a range of its own."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            one = np.ones(1, np.uint64)
            cls.up = np.concatenate([one, np.cumprod(np.full(n, _BASE, np.uint64))])
            cls.down = np.concatenate([one, np.cumprod(np.full(n, _BASE_INV, np.uint64))])
        return cls.up, cls.down


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span of bytes."""
    up, _ = Powers.to(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = Powers.to(len(sums) - 1)
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def words_of(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts data[offsets[i]:offsets[i+1]], A-Z lower-cased.

    Returns start, end (bytes from offsets[0]), 64-bit hash and text number of
    each word, and the lower-cased bytes.
    """
    low = TO_LOWER[data[offsets[0]:offsets[-1]]]
    rel = offsets - offsets[0]
    n = len(low)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(np.uint64), z, low
    inside = ~separators[low]
    cut = np.zeros(n + 1, bool)
    cut[rel] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    start = np.flatnonzero(inside & (before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~inside[1:]
    end = np.flatnonzero(inside & (after | cut[1:])) + 1
    text = np.searchsorted(rel, start, "right") - 1
    return start, end, span_hash(prefix_hash(low), start, end), text, low
