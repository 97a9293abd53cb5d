"""Benchmark decontamination by SimHash windows and multi-index Hamming search.

Every text is slid over in windows about as long as a benchmark item: item lengths
are rounded down to a few window sizes (geometric, ratio 1.25), and an item is probed
by its first and its last words of that size. A window's 64-bit SimHash sums the words'
hash bits. Probes and windows are compared by four 16-bit blocks: fingerprints within
radius 7 agree in some block up to one bit, so looking up each block among the probes'
blocks and their one-bit neighbours finds all of them; the full distance is then
checked. In a short window one changed word flips more bits than the radius, so windows
are also found by some shingles of each item (``anchors``), more than a window as similar as
wanted can lack: whatever the item's length, no such window is lost. Each candidate is verified: the multiset of 5-word shingles of the
item-sized window around it against the item's, by weighted Jaccard similarity
(sum of smaller counts / sum of larger counts).

Only fingerprints and anchors are sent to the tasks (32 bytes a probe, 8 an anchor, ``chunk``
items at a time); the verification joins candidates with the item table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import NON_ALNUM, mix64, read_table, scratch, slices, stored, text_buffers, text_key, words_of

RADIUS, BLOCKS, BLOCK_BITS = 7, 4, 16
RATIO = 1.25
CHUNK = 100_000


def window_size(n: int) -> int:
    """Largest size of the geometric series (1, 2, 3, 4, 5, 6, 7, 9, 11, ...) that is at most n."""
    size = 1
    while (up := max(size + 1, int(size * RATIO))) <= n:
        size = up
    return size


def fingerprints(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """SimHash of the word spans; ties of a bit count as 0."""
    sums = bit_sums(words) if sums is None else sums
    return np.packbits((sums[ends] - sums[starts]) > 0, axis=1).view(np.uint64).reshape(-1)


def bit_sums(words: np.ndarray) -> np.ndarray:
    """Running sums of +1/-1 by hash bit (16 bits wrap; differences of spans under 32,768 words are right)."""
    out = np.zeros((len(words) + 1, 64), np.int16 if len(words) < 32768 else np.int32)
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8), axis=1).view(np.int8)
    np.cumsum(bits * np.int8(2) - np.int8(1), axis=0, dtype=out.dtype, out=out[1:])
    return out


def near_tables(probes: np.ndarray) -> np.ndarray:
    """For each block: which 16-bit values are within one bit of some probe's block."""
    tables = np.zeros((BLOCKS, 1 << BLOCK_BITS), bool)
    reach = RADIUS // BLOCKS
    flips = [0] + [1 << b for b in range(BLOCK_BITS)] * (reach > 0)
    for k in range(BLOCKS):
        part = ((probes >> np.uint64(BLOCK_BITS * k)) & np.uint64(0xFFFF)).astype(np.int64)
        for f in flips:
            tables[k, part ^ f] = True
    return tables


def shingles(words: np.ndarray, size: int) -> Counter:
    """Counts of the ``size``-word shingles; fewer words are one shingle."""
    if len(words) == 0:
        return Counter()
    return Counter(shingle_hashes(words, min(size, len(words))).tolist())


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on."""
    h = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + len(h)])
    return h


def may_lack(n: int, similarity: float) -> int:
    """How many of an item's n shingles a window that reaches the similarity can lack."""
    return n - max(1, math.ceil(n * similarity - 1e-9))


def anchor_places(n: int, similarity: float) -> np.ndarray:
    """Places of the anchors among an item's n shingles: of twice as many as can be lacking, and one, most are there."""
    return np.unique(np.linspace(0, n - 1, min(n, 2 * may_lack(n, similarity) + 1)).astype(np.int64))


def weighted_jaccard(a: Counter, b: Counter) -> float:
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    high = sum(a.values()) + sum(b.values()) - low
    return low / high if high else 0.0


def _item_words(shingle: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            for i, j in slices(offsets):
                _, _, h, text, _ = words_of(data, offsets[i:j + 1], NON_ALNUM)
                ends = np.searchsorted(text, np.arange(j - i + 1))
                words, sizes, front, back, anchors = [], [], [], [], []
                for a, e in zip(ends, ends[1:]):
                    w, n = h[a:e], window_size(int(e - a)) if e > a else 0
                    words.append(w.tobytes())
                    sizes.append(n)
                    f = fingerprints(w, np.array([0, len(w) - n]), np.array([n, len(w)])) if n else np.zeros(2, np.uint64)
                    front.append(int(f[0].view(np.int64)))
                    back.append(int(f[1].view(np.int64)))
                    # an item of fewer words is found only as it is, by its fingerprint
                    own = shingle_hashes(w, shingle)
                    anchors.append(own[anchor_places(len(own), similarity)].tobytes() if len(own) else b"")
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(words, pa.binary()), pa.array(np.diff(ends), pa.int64()),
                     pa.array(sizes, pa.int32()), pa.array(front, pa.int64()), pa.array(back, pa.int64()),
                     pa.array(anchors, pa.binary())],
                    names=["item_id", "item_words", "n", "size", "front", "back", "anchors"])
    return run


def _windows(probes: list[tuple[int, int, int, int, int]], anchors: list[tuple[int, int, bytes]], shingle: int,
             similarity: float):
    """probes: (item number, item's words, window size, words before the probe, fingerprint);
    anchors: (item number, item's words, hashes of its shingles at ``anchor_places``)."""
    item, n, size, ahead = (np.array([p[i] for p in probes], np.int64) for i in range(4))
    prints = np.array([p[4] for p in probes], np.int64).view(np.uint64)

    anchored = [a for a in anchors if a[2]]
    places = [anchor_places(k - shingle + 1, similarity) for _, k, _ in anchored]
    mark = np.frombuffer(b"".join(a[2] for a in anchored), np.uint64)
    whose, place = np.repeat(np.arange(len(places)), [len(x) for x in places]), np.concatenate([*places, np.zeros(0, np.int64)])
    order = np.argsort(mark, kind="stable")
    mark, whose, place = mark[order], whose[order], place[order]
    name, length = (np.array([a[i] for a in anchored], np.int64) for i in range(2))
    lack = np.array([may_lack(k - shingle + 1, similarity) for _, k, _ in anchored], np.int64)
    need = np.array([len(x) for x in places], np.int64) - lack
    # a window as similar as wanted is moved against its anchors by at most so many words; one cut
    # off by an end of the text by at most as many as it lacks
    move = np.array([int((k - shingle + 1) * (1 - similarity) / (1 + similarity) + 1e-9) for _, k, _ in anchored], np.int64)

    def by_anchors(h, text, first, room, known):
        """(text, first word, end, item) of the windows around anchors."""
        spans = shingle_hashes(h, shingle)
        hit = np.flatnonzero(known[(spans & np.uint64(len(known) - 1)).astype(np.int64)] & (room[:len(spans)] >= shingle))
        low = np.searchsorted(mark, spans[hit], "left")
        times = np.searchsorted(mark, spans[hit], "right") - low
        at = np.repeat(hit, times)
        x = np.repeat(low - np.cumsum(times) + times, times) + np.arange(len(at))
        # texts that hold enough different anchors of the item
        both = text[at] * len(name) + whose[x]
        seen, count = np.unique(np.unique(both * (place.max(initial=0) + 1) + place[x]) // (place.max(initial=0) + 1), return_counts=True)
        enough = np.isin(both, seen[count >= need[seen % max(1, len(name))]])
        at, x = at[enough], x[enough]
        out = set()
        for t, who, start in set(zip(text[at].tolist(), whose[x].tolist(), (at - place[x]).tolist())):
            for s in range(start - int(lack[who]), start + int(lack[who]) + 1):
                a, e = max(s, int(first[t])), min(s + int(length[who]), int(first[t + 1]))
                if a < e and (abs(s - start) <= move[who] or e - a < length[who]):
                    out.add((t, a, e, int(name[who])))
        return sorted(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(1 << max(16, int(len(mark) * 16).bit_length()), bool)
        known[(mark & np.uint64(len(known) - 1)).astype(np.int64)] = True
        classes = [(int(s), np.flatnonzero(size == s)) for s in np.unique(size)]
        tables = [near_tables(prints[who]) for _, who in classes]
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            ids, keys = b.column(0), b.column(2)
            for i, j in slices(offsets, 1 << 16):
                _, _, h, text, _ = words_of(data, offsets[i:j + 1], NON_ALNUM)
                if not len(h):
                    continue
                first = np.searchsorted(text, np.arange(j - i + 1))
                sums = bit_sums(h)
                docs, items, words = [], [], []
                room = first[text + 1] - np.arange(len(h))
                for (s, who), near in zip(classes, tables):
                    # windows of s words; a text with fewer has one window, the whole
                    seen = np.packbits(sums[s:] > sums[:-s], axis=1).view(np.uint64).reshape(-1) if s <= len(h) else room[:0].view(np.uint64)
                    start = np.flatnonzero(room[:len(seen)] >= s)
                    short = np.flatnonzero((np.diff(first) < s) & (np.diff(first) > 0))
                    seen = np.concatenate([seen[start], fingerprints(h, first[short], first[short + 1], sums)])
                    start = np.concatenate([start, first[short]])
                    hit = np.zeros(len(seen), bool)
                    parts = seen.view(np.uint16).reshape(-1, BLOCKS)
                    for k in range(BLOCKS):
                        hit |= near[k][parts[:, k]]
                    hit = np.flatnonzero(hit)
                    for at in range(0, len(who), 64):
                        some = who[at:at + 64]
                        w, p = np.nonzero(np.bitwise_count(seen[hit][:, None] ^ prints[some][None, :]) <= RADIUS)
                        for w_at, x in zip(hit[w].tolist(), some[p].tolist()):
                            t = int(text[start[w_at]])
                            a = max(int(start[w_at]) - int(ahead[x]), int(first[t]))
                            e = min(a + int(n[x]), int(first[t + 1]))
                            docs.append((t, a - int(first[t])))
                            items.append(int(item[x]))
                            words.append(h[a:e].tobytes())
                for t, a, e, x in by_anchors(h, text, first, room, known) if len(mark) and len(h) >= shingle else ():
                    docs.append((t, a - int(first[t])))
                    items.append(x)
                    words.append(h[a:e].tobytes())
                if docs:
                    at = pa.array([i + t for t, _ in docs])
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(at), keys.take(at), pa.array([w for _, w in docs], pa.int64()),
                         pa.array(items, pa.int64()), pa.array(words, pa.binary())],
                        names=["doc_id", "text_key", "first_word", "item", "words"])
    return run


def _verify(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: dict[bytes, Counter] = {}
        for b in batches:
            out = []
            windows = [np.frombuffer(w, np.uint64) for w in b.column(5).to_pylist()]
            h = shingle_hashes(np.concatenate(windows) if windows else np.zeros(0, np.uint64), size)
            at = 0
            for w, i in zip(windows, b.column(6).to_pylist()):
                if i not in items:
                    items = items if len(items) < 10_000 else {}
                    items[i] = shingles(np.frombuffer(i, np.uint64), size)
                own = Counter(h[at:at + len(w) - size + 1].tolist()) if len(w) >= size else shingles(w, size)
                out.append(weighted_jaccard(own, items[i]))
                at += len(w)
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(5)], pa.array(out, pa.float64())],
                                             names=["doc_id", "text_key", "first_word", "item", "item_id", "similarity"])
    return run


def contaminated_rows(documents: DataFrame, benchmark: DataFrame, words: int = 5, similarity: float = 0.8,
                      chunk: int = CHUNK) -> DataFrame:
    """doc_id, text_key, item_id, similarity, first_word: the best window of each document for each item it holds.

    Words are runs of 0-9, a-z and non-ASCII characters, A-Z lower-cased. Items with
    fewer than ``words`` words are one shingle; items without words match nothing, and
    so do null texts. Repeated items are items of their own, also those with a null
    id. Rows with the same doc_id are one document; rows without one are a document
    for each distinct text, named by ``text_key`` (null for rows with an id). Among
    equal windows the first is named.
    """
    spark = documents.sparkSession
    path = scratch(spark, "decontaminate")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    # items are numbered, for those without an id
    items = stored(items.mapInArrow(
        _item_words(words, similarity), "item_id long, item_words binary, n long, size int, front long, back long, anchors binary")
        .where("n > 0").distinct().withColumn("item", F.monotonically_increasing_id())
        .withColumn("part", F.pmod(F.xxhash64("item"), F.lit(1 << 20))), f"{path}/items")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.select("doc_id", "text", text_key(F.col("doc_id"), F.col("text")).alias("text_key"))
    n_items, found = items.count(), None
    parts = max(1, -(-2 * n_items // chunk)) if n_items > chunk else 1
    kinds = "doc_id long, text_key long, first_word long, item long, words binary"
    for p in range(parts):
        # at most about ``chunk`` items, 32 bytes a probe and 8 an anchor
        rows = items.where(F.col("part") % parts == p).select("item", "n", "size", "front", "back", "anchors").collect()
        probes = sorted({(r["item"], r["n"], r["size"], ahead, f) for r in rows
                         for ahead, f in ((0, r["front"]), (r["n"] - r["size"], r["back"]))})
        anchors = [(r["item"], r["n"], bytes(r["anchors"])) for r in rows]
        part = docs.mapInArrow(_windows(probes, anchors, words, similarity), kinds) if probes else spark.createDataFrame([], kinds)
        found = part if found is None else found.unionByName(part)
    found = stored(found.distinct(), f"{path}/candidates")
    pairs = found.join(items.select("item", "item_id", "item_words"), "item").select(
        "doc_id", "text_key", "first_word", "item", "item_id", "words", "item_words")
    sure = pairs.mapInArrow(
        _verify(words), "doc_id long, text_key long, first_word long, item long, item_id long, similarity double").where(
        F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("w")))
    unnamed = F.when(F.col("item_id").isNull(), F.col("item")).alias("unnamed")
    return sure.groupBy("doc_id", "text_key", "item_id", unnamed).agg(best.alias("b")).select(
        "doc_id", "text_key", "item_id", F.col("b.similarity").alias("similarity"), (-F.col("b.w")).alias("first_word"))


def contaminated(documents: DataFrame, benchmark: DataFrame, words: int = 5, similarity: float = 0.8,
                 chunk: int = CHUNK) -> DataFrame:
    """doc_id, item_id, similarity, first_word of ``contaminated_rows`` for the documents with an id."""
    return contaminated_rows(documents, benchmark, words, similarity, chunk).where("doc_id IS NOT NULL").drop("text_key")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_rows(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("text_key")
