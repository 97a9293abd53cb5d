"""Licence scans by a positional rare-token index.

Pass 1 reads every text once and stores, per document, the postings (word, place)
of the words that occur in any licence phrase. The document counts of these words
over all documents give their IDF. Pass 2 works on the postings alone: each phrase
is looked up by its highest-IDF word, the candidate starts are intersected with
the postings of its other words by relative position, and a licence is reported
when all of its mandatory phrases stand in the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import NON_ALNUM, prefix_hash, scratch, slices, span_hash, stored, text_buffers, words_of

# fixed values: base phrases and their labels
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# licence templates: label -> mandatory key phrases
TEMPLATES = (
    ("agpl-3", ("gnu affero general public license", "version 3")),
    ("apache-2", ("licensed under the apache license", "version 2")),
    ("bsd", ("redistribution and use in source and binary forms", "with or without modification")),
    ("cc-by-nc", ("licensed under cc by nc",)),
    ("gpl-2", ("gnu general public license version 2",)),
    ("gpl-3", ("gnu general public license version 3",)),
    ("isc", ("permission to use copy modify and or distribute this software",)),
    ("lgpl", ("gnu lesser general public license",)),
    ("mit", ("permission is hereby granted free of charge", "the software is provided as is")),
    ("mpl-2", ("mozilla public license", "2 0")),
)


def vocabulary(phrases: list[str]) -> list[str]:
    return sorted({w for p in phrases for w in p.split()})


def _hash(words: list[str]) -> np.ndarray:
    return np.array([span_hash(prefix_hash(b := np.frombuffer(w.encode(), np.uint8)), np.array([0]),
                               np.array([len(b)]))[0] for w in words], np.uint64)


def _postings(words: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hash(words)
        order = np.argsort(hashes)
        known = hashes[order]
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            ids = batch.column(0)
            for i, j in slices(offsets):
                _, _, h, text, _ = words_of(data, offsets[i:j + 1], NON_ALNUM)
                counts = np.bincount(text, minlength=j - i)
                first = np.concatenate([[0], np.cumsum(counts)])
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = np.flatnonzero(known[at] == h)
                ends = np.searchsorted(text[hit], np.arange(j - i + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in
                         (order[at[hit]], hit - first[text[hit]])]
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(counts, pa.int64()), *lists],
                                                 names=["doc_id", "n_words", "words", "places"])
    return run


def postings(documents: DataFrame, words: list[str]) -> DataFrame:
    """doc_id, n_words, words (numbers into ``words``) and places (word numbers), in text order."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_postings(words), "doc_id long, n_words long, words array<int>, places array<int>")


def places_of(phrase: list[int], idf: np.ndarray, word: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keys (text * 2**32 + place) at which the phrase's words stand consecutively.

    ``word`` and ``key`` are the postings in ascending key order.
    """
    rare = max(range(len(phrase)), key=lambda i: (idf[phrase[i]], i))
    found = key[word == phrase[rare]] - rare
    found = found[(found & 0xFFFFFFFF) <= 0xFFFFFFFF - len(phrase)]
    for i in sorted(range(len(phrase)), key=lambda i: -idf[phrase[i]]):
        if i != rare and len(found):
            at = np.minimum(np.searchsorted(key, found + i), len(key) - 1)
            found = found[(key[at] == found + i) & (word[at] == phrase[i])]
    return found


def _scan(words: list[str], idf: np.ndarray, base, templates):
    number = {w: i for i, w in enumerate(words)}
    code = lambda p: [number[w] for w in p.split()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            lists = b.column(2)
            text = np.repeat(np.arange(n, dtype=np.int64), np.diff(lists.offsets.to_numpy()))
            word = lists.flatten().to_numpy(zero_copy_only=False)
            key = (text << 32) + b.column(3).flatten().to_numpy(zero_copy_only=False)
            memo: dict[str, np.ndarray] = {}

            def at(phrase: str) -> np.ndarray:
                if phrase not in memo:
                    memo[phrase] = places_of(code(phrase), idf, word, key) if len(key) else np.zeros(0, np.int64)
                return memo[phrase]

            count, low, high = np.zeros(n, np.int64), np.full(n, 2 ** 62), np.full(n, -1)
            base_labels: list[set] = [set() for _ in range(n)]
            for phrase, label in base:
                p = at(phrase)
                t, place = p >> 32, p & 0xFFFFFFFF
                count += np.bincount(t, minlength=n)
                np.minimum.at(low, t, place)
                np.maximum.at(high, t, place)
                for i in np.unique(t):
                    base_labels[i].add(label)
            labels, score = [set(x) for x in base_labels], np.array([1.0 if x else 0.0 for x in base_labels])
            for label, phrases in templates:
                share = np.zeros(n)
                for phrase in phrases:
                    share[np.unique(at(phrase) >> 32)] += 1
                share /= len(phrases)
                score = np.maximum(score, share)
                for i in np.flatnonzero(share >= 1):
                    labels[i].add(label)
            place = lambda x: pa.array(x, pa.int64(), mask=count == 0)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array(count, pa.int64()), place(low), place(high),
                *[pa.array([",".join(sorted(x)) for x in s]) for s in (base_labels, labels)],
                pa.array(score, pa.float64())], names=[
                "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return run


def scan_licenses(documents: DataFrame, base=BASE, templates=TEMPLATES) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are maximal runs of 0-9, a-z and non-ASCII characters after lower-casing
    A-Z. ``n_base`` counts the places of base phrases, ``first_word`` / ``last_word``
    are the smallest / largest word number where one starts (null without any).
    ``labels`` adds the licences all of whose mandatory phrases occur; ``score`` is the
    largest share of a licence's mandatory phrases found (1.0 with a base phrase).
    A null or empty text has no words and empty labels; null or repeated doc_ids
    are ordinary rows; other columns are ignored.
    """
    spark = documents.sparkSession
    words = vocabulary([p for p, _ in base] + [p for _, ps in templates for p in ps])
    rows = stored(postings(documents, words), f"{scratch(spark, 'licenses')}/postings")
    n = rows.count()
    df = rows.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").count().collect()  # a row per licence word
    idf = np.full(len(words), np.log1p(n))
    for r in df:
        idf[r["w"]] = np.log1p(n / r["count"])
    return rows.mapInArrow(
        _scan(words, idf, base, templates),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _places_sql(phrase: str) -> str:
    ws = phrase.split()
    want = "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    return f"list_filter(range(0, len(w)::BIGINT), lambda i: w[i + 1:i + {len(ws)}] = {want})"


def oracle(base=BASE, templates=TEMPLATES) -> str:
    # a nullable long is a double in pandas, which compares the results
    has = lambda p: f"contains(s, ' {p} ')"
    share = ", ".join("(" + " + ".join(f"{has(p)}::INT" for p in ps) + f")::DOUBLE / {len(ps)}" for _, ps in templates)
    own = ", ".join("CASE WHEN " + " AND ".join(has(p) for p in ps) + f" THEN '{label}' END" for label, ps in templates)
    found = ", ".join(f"CASE WHEN {has(p)} THEN '{label}' END" for p, label in base)
    joined = lambda items: (f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{items}], "  # noqa: E731
                            "lambda x: x IS NOT NULL))), ','), '')")
    places = " || ".join(_places_sql(p) for p, _ in base)
    return f"""
WITH word AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
line AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS s, {places} AS p FROM word)
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_base,
       list_min(p)::DOUBLE AS first_word, list_max(p)::DOUBLE AS last_word,
       {joined(found)} AS base_labels, {joined(found + ', ' + own)} AS labels,
       greatest(CASE WHEN len(p) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE, {share}) AS score
FROM line
"""


OP10_SQL = oracle()
