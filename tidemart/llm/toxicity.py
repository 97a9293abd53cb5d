"""Toxicity: a factorization machine over hashed terms.

Terms are the words of a text and their 4- and 5-byte beginnings, hashed to
``2 ** bits`` buckets. The machine has a weight and a ``rank``-dimensional vector for
each selected bucket, so that the score holds all pairwise interactions of the terms
present, e.g. an insult together with a group name. It is fitted on a bounded sample
of labelled documents (at most ``max_train`` rows, half of each class if there are
enough), taken in a fixed pseudo-random order over all labelled rows; scoring runs over
every whole text in the tasks of one scan.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import NON_ALNUM, prepare_workers, prefix_hash, read_table, scratch, slices, span_hash, stored, text_buffers, words_of

BITS = 20
BEGINNINGS = (4, 5)
MAX_TRAIN = 12_000


def held_out(doc_id: Column) -> Column:
    """Documents whose label is never learned from (crc32 of the id's decimal text, mod 5, is 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def terms(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every hashed term of the texts."""
    start, end, h, text, low = words_of(data, offsets, NON_ALNUM)
    mask = np.uint64((1 << bits) - 1)
    texts, found = [text], [(h & mask).astype(np.int64)]
    if len(low):
        sums = prefix_hash(low)
        for n in BEGINNINGS:
            fit = end - start > n
            part = span_hash(sums, start[fit], start[fit] + n) ^ np.uint64(n * 0x9E3779B97F4A7C15 % 2 ** 64)
            texts.append(text[fit])
            found.append((part & mask).astype(np.int64))
    return np.concatenate(texts), np.concatenate(found)


@dataclass
class Machine:
    """score = sigmoid(bias + sum w_i + sum over pairs <v_i, v_j>) over the buckets present."""

    bits: int
    buckets: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """For rows given as distinct (row, feature) pairs."""
        out = self.bias + np.bincount(row, self.w[feature], n)
        for k in range(self.v.shape[1]):
            x = self.v[feature, k]
            out += 0.5 * (np.bincount(row, x, n) ** 2 - np.bincount(row, x * x, n))
        return out

    def pairs(self, text: np.ndarray, bucket: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        feature = table[bucket]
        hit = feature >= 0
        both = np.unique(text[hit] * len(self.buckets) + feature[hit]) if hit.any() else np.zeros(0, np.int64)
        return both // max(1, len(self.buckets)), both % max(1, len(self.buckets))

    def table(self) -> np.ndarray:
        out = np.full(1 << self.bits, -1, np.int32)
        out[self.buckets] = np.arange(len(self.buckets))
        return out


@dataclass
class Rates:
    """Documents holding each bucket (distinct, ascending), of label 1 and of label 0, among n1 and n0 documents."""

    bucket: np.ndarray
    one: np.ndarray
    zero: np.ndarray
    n1: float
    n0: float

    def odds(self) -> np.ndarray:
        """Log odds of label 1 for each bucket."""
        return np.log((self.one + 0.5) / (self.n1 + 1)) - np.log((self.zero + 0.5) / (self.n0 + 1))

    def telling(self, most: int) -> np.ndarray:
        """Buckets (of 3 documents or more) whose rate in one class is twice that in the other and 4 standard errors off."""
        if not self.n1 or not self.n0:
            return np.zeros(0, np.int64)
        p = (self.one + self.zero) / (self.n1 + self.n0)
        z = np.abs(self.one / self.n1 - self.zero / self.n0) / np.sqrt(p * (1 - p) * (1 / self.n1 + 1 / self.n0) + 1e-9)
        z[(self.one + self.zero < 3) | (np.abs(self.odds()) < np.log(2))] = 0
        top = np.argsort(-z, kind="stable")[:most]
        return self.bucket[np.sort(top[z[top] >= 4])]

    def of(self, buckets: np.ndarray) -> np.ndarray:
        """Places of buckets that are held here."""
        return np.searchsorted(self.bucket, buckets)

    def speaking(self, buckets: np.ndarray) -> np.ndarray:
        """Those of the buckets that speak for label 1."""
        return buckets[self.odds()[self.of(buckets)] > 0]


def _class_counts(rows: list[np.ndarray], label: np.ndarray) -> Rates:
    """Rates of documents given as arrays of distinct buckets."""
    none = [np.zeros(0, np.int64)]
    one, zero = (np.concatenate(none + [r for r, c in zip(rows, label) if bool(c) == side]) for side in (True, False))
    bucket = np.unique(np.concatenate([one, zero]))
    n1 = float(np.sum(label))
    return Rates(bucket, *(np.bincount(np.searchsorted(bucket, x), minlength=len(bucket)).astype(np.float64)
                           for x in (one, zero)), n1, len(rows) - n1)


def fit(rows: list[np.ndarray], label: np.ndarray, prior: float, bits: int = BITS, most: int = 1024, **how) -> Machine:
    """Fit on documents given as arrays of distinct buckets; ``prior`` is the share of label 1 to expect.

    Features are the ``telling`` buckets, at most ``most`` of each kind: those whose document rates in the
    two classes differ by themselves, and those whose rates differ among the documents that hold a
    term speaking for label 1. The second kind are terms common in clean text (a group mention) that
    decide beside an insult; they start without a weight of their own. Other common words, whose rates differ little (with a
    text's length), have no weight, however long a text. ``how``: see ``train``.
    """
    rates = _class_counts(rows, label)
    alone = rates.telling(most)
    # documents with a term that speaks for label 1: which other terms make the difference there?
    speaks = rates.speaking(alone)
    near = [i for i, r in enumerate(rows) if np.isin(r, speaks).any()]
    beside = np.setdiff1d(_class_counts([rows[i] for i in near], label[near]).telling(most), alone)
    return train(rows, label, prior, rates, alone, beside, bits, **how)


def train(rows: list[np.ndarray], label: np.ndarray, prior: float, rates: Rates, alone: np.ndarray, beside: np.ndarray,
          bits: int = BITS, rank: int = 4, epochs: int = 20, step: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Train the features ``alone`` and ``beside``; other buckets of the rows have no part.

    Weights start at the shrunken log odds of their term, so
    that a single telling term counts although training texts hold several; then
    AdaGrad on the logistic loss.
    """
    label = label.astype(np.float64)
    n1, n0 = rates.n1, rates.n0
    logit = float(np.log((prior + 1e-6) / (1 - prior + 1e-6)))
    if n1 == 0 or n0 == 0:
        return Machine(bits, np.zeros(0, np.int64), logit, np.zeros(0), np.zeros((0, rank)))
    buckets = np.sort(np.concatenate([alone, beside])).astype(np.int64)
    at = rates.of(buckets)
    # no weight of their own to start with for the second kind, only what they learn beside others
    odds = np.where(np.isin(buckets, beside), 0.0, rates.odds()[at])
    rng = np.random.default_rng(seed)
    k = len(buckets)
    seen = (rates.one + rates.zero)[at]
    m = Machine(bits, buckets, logit, odds * seen / (seen + 30), rng.normal(0, 0.01, (k, rank)))
    table = m.table()
    rows = [f[f >= 0] for f in (table[r] for r in rows)]
    g_b, g_w, g_v = 1e-6, np.full(k, 1e-6), np.full((k, rank), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 128):
            part = order[at:at + 128]
            x = np.zeros((len(part), k))
            for i, r in enumerate(part):
                x[i, rows[r]] = 1
            xv = x @ m.v
            out = m.bias + x @ m.w + 0.5 * (xv ** 2 - x @ m.v ** 2).sum(1)
            g = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - label[part]) / len(part)
            xg = x.T @ g
            d_w, d_v, d_b = xg + decay * m.w, x.T @ (g[:, None] * xv) - xg[:, None] * m.v + decay * m.v, g.sum()
            g_w += d_w ** 2
            g_v += d_v ** 2
            g_b += d_b ** 2
            m.w -= step * d_w / np.sqrt(g_w)
            m.v -= 0.2 * step * d_v / np.sqrt(g_v)
            m.bias -= step * d_b / np.sqrt(g_b)
    # the sample's share of label 1 is set, not observed: move the bias to the expected share
    m.bias += logit - float(np.log(n1 / n0))
    return m


def _term_sets(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            for i, j in slices(offsets):
                text, bucket = terms(data, offsets[i:j + 1], bits)
                both = np.unique((text << bits) + bucket)
                ends = np.searchsorted(both >> bits, np.arange(j - i + 1))
                low = (both & ((1 << bits) - 1)).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([low[s:e].tobytes() for s, e in zip(ends, ends[1:])], pa.binary())],
                    names=["label", "terms"])
    return run


def _bucket_counts(speaks: np.ndarray | None, bits: int):
    """For a batch of rows (label, terms): how many of each label hold each bucket; bucket -1 counts the rows.

    With ``speaks`` only the rows that hold one of these buckets count.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.zeros(1 << bits, bool)
        mark[[] if speaks is None else speaks] = True
        for b in batches:
            rows = [(c, np.frombuffer(t, "<i4")) for c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            rows = [(c, np.append(r, -1)) for c, r in rows if speaks is None or mark[r].any()]
            if rows:
                rates = _class_counts([r for _, r in rows], np.array([c for c, _ in rows]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (rates.bucket.astype(np.int32), rates.one.astype(np.int64), rates.zero.astype(np.int64))],
                    names=["bucket", "one", "zero"])
    return run


def _rates(sample: DataFrame, bits: int, speaks: np.ndarray | None = None) -> Rates:
    """Rates over the sample, or over its rows that hold a bucket of ``speaks``: buckets of 3 documents or more."""
    counts = sample.mapInArrow(_bucket_counts(speaks, bits), "bucket int, one long, zero long").groupBy("bucket").agg(
        F.sum("one").alias("one"), F.sum("zero").alias("zero")).where("bucket < 0 OR one + zero >= 3").toArrow()
    bucket, one, zero = (counts[c].to_numpy() for c in ("bucket", "one", "zero"))
    order = np.argsort(bucket)
    bucket, one, zero = bucket[order].astype(np.int64), one[order].astype(np.float64), zero[order].astype(np.float64)
    if not len(bucket):
        return Rates(bucket, one, zero, 0.0, 0.0)
    return Rates(bucket[1:], one[1:], zero[1:], float(one[0]), float(zero[0]))


def _only(buckets: np.ndarray, bits: int):
    """Rows (label, terms) with those of their terms that are features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = np.zeros(1 << bits, bool)
        mark[buckets] = True
        for b in batches:
            terms = [np.frombuffer(t, "<i4") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([t[mark[t]].tobytes() for t in terms], pa.binary())], names=["label", "terms"])
    return run


def learn(documents: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, bits: int = BITS, most: int = 1024) -> Machine:
    """Machine fitted on at most ``max_train`` labelled, not held-out documents, as by ``fit``.

    Rows with a null id or label, and labels other than 0 and 1, are not learned
    from; an id with several labels counts as 1 if any is 1. Buckets are counted in
    tasks; the driver gets the counts and, of the documents, only the features.
    """
    path = scratch(documents.sparkSession, "toxicity")
    known = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("label"))
             .where("_id IS NOT NULL AND label IN (0, 1)").where(~held_out(F.col("_id")))
             .groupBy("_id").agg(F.max("label").alias("label")))
    # at most max_train ids: the first of each class in the order of a hash of the id
    ids = None
    for c in (0, 1):
        part = known.where(F.col("label") == c).orderBy(F.xxhash64("_id"), "_id").limit(max_train // 2)
        ids = part if ids is None else ids.unionByName(part)
    share = known.agg(F.avg("label")).first()[0]
    docs = documents.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    sample = stored(docs.join(F.broadcast(ids), "_id").select("label", "text").mapInArrow(
        _term_sets(bits), "label int, terms binary"), f"{path}/sample")
    rates = _rates(sample, bits)
    alone = rates.telling(most)
    beside = np.setdiff1d(_rates(sample, bits, rates.speaking(alone)).telling(most), alone)
    # rows come in the order of their label and terms: the fit must not depend on where they were read
    found = sample.repartition("label").sortWithinPartitions("label", "terms").mapInArrow(
        _only(np.concatenate([alone, beside]), bits), "label int, terms binary").toArrow()
    rows = sorted(zip(found["label"].to_pylist(), found["terms"].to_pylist()), key=lambda r: r[0])
    return train([np.frombuffer(t, "<i4") for _, t in rows], np.array([c for c, _ in rows], np.int64), share or 0.0,
                 rates, alone, beside, bits)


def _score(m: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = m.table()
        for b in batches:
            data, offsets = text_buffers(b.column(b.num_columns - 1))
            out = np.empty(b.num_rows)
            for i, j in slices(offsets):
                row, feature = m.pairs(*terms(data, offsets[i:j + 1], m.bits), table)
                out[i:j] = m.logits(row, feature, j - i)
            score = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score)],
                                             names=[*b.schema.names[:-1], "score"])
    return run


def score_toxicity(documents: DataFrame, machine: Machine, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, score (0 to 1) and predicted (1 if score >= 0.5), a row per input row.

    Null and empty texts get the score of a text without known terms. Only the
    text is an input of the score; other columns are ignored.
    """
    prepare_workers(documents.sparkSession)
    docs = documents.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)],
                            F.col("text").cast("string").alias("_text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[:-1])
    out = docs.mapInArrow(_score(machine), f"{kinds}, score double" if kinds else "score double")
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(documents: DataFrame, machine: Machine, threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text scores under ``threshold``."""
    prepare_workers(documents.sparkSession)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cut = machine.table(), np.log(threshold / (1 - threshold))
        for b in batches:
            data, offsets = text_buffers(b.column(at))
            out = np.empty(b.num_rows)
            for i, j in slices(offsets):
                out[i:j] = machine.logits(*machine.pairs(*terms(data, offsets[i:j + 1], machine.bits), table), j - i)
            yield b.filter(pa.array(out < cut))
    return documents.mapInArrow(run, documents.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    machine = learn(documents, read_table(spark, sf_dir, "labels"))
    return score_toxicity(documents, machine).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
