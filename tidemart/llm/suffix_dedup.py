"""Suffix-array dedup: remove every byte covered by a long string that starts twice.

The suffixes to be ordered are those that can share ``length`` (400) bytes with another.
They are found and thinned in three steps, each a partial aggregation:

1. *Anchors.* Every window of ``length`` bytes has an anchor, the rightmost of its k-grams
   with the least hash; equal windows have equal anchors at equal offsets. Runs of windows
   with the same anchor are one row. A k-gram that is an anchor only once has only unique
   windows. Runs equal as a whole (same bytes, same offsets) are duplicates as a whole,
   and one of them stands for all.
2. *Cells.* Runs that share a k-gram but differ are cut into blocks of 16 offsets. All windows
   of a block share a core of ``length`` - 15 bytes; rows with equal cores form a cell and
   differ only in the 15 bytes at either side. Equal rows are duplicates and stand as one.
3. *Deep-shallow sort.* What is left in cells of several rows are suffixes with a long common
   core: for each, the string (core, offset, side bytes) stands for its first ``length`` bytes.
   They are dealt and sorted by a shallow prefix, then each task orders its share by
   multikey quicksort to a shallow depth, and by blind tries the groups that
   agree up to there. Neighbours with a common prefix of full length are duplicates.

Exact copies of a text are collapsed first; they are removed as a whole if long enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import id_order, mix64, prefix_hash, read_table, scratch, slices, span_hash, stored, text_buffers

LENGTH = 400
BLOCK = 16
SHALLOW = 13
_FAR = np.uint64(0xFFFFFFFF)


def window_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple:
    """Runs of windows with one anchor: text, anchor, first and last window start, k-gram hash, and prefix sums.

    Positions count from offsets[0].
    """
    rel = (offsets - offsets[0]).astype(np.int64)
    raw = data[offsets[0]:offsets[-1]]
    sums = prefix_hash(raw)
    k = max(1, length // 8)
    n = len(raw) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, none.astype(np.uint64), sums
    at = np.arange(len(raw) - k + 1)
    grams = span_hash(sums, at, at + k)
    # hash above, position below: the least key is the rightmost least hash
    key = (grams & ~_FAR) | (_FAR - at.astype(np.uint64))
    w = length - k + 1
    pad = -len(key) % w
    rows = np.concatenate([key, np.full(pad, ~np.uint64(0))]).reshape(-1, w)
    up = np.minimum.accumulate(rows, axis=1).reshape(-1)
    down = np.ascontiguousarray(np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1]).reshape(-1)
    anchor = (_FAR - (np.minimum(down[:n], up[w - 1:w - 1 + n]) & _FAR)).astype(np.int64)
    start = np.arange(n)
    text = np.searchsorted(rel, start, "right") - 1
    ok = start + length <= rel[text + 1]
    start, anchor, text = start[ok], anchor[ok], text[ok]
    if not len(start):
        return none, none, none, none, none.astype(np.uint64), sums
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(start)]]) - 1
    return text[first], anchor[first], start[first], start[last], grams[anchor[first]], sums


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            for i, j in slices(offsets):
                part = offsets[i:j + 1]
                text, anchor, first, last, gram, sums = window_runs(data, part, length)
                head = (part - part[0])[text]
                shape = ((anchor - last) * (length + 1) + anchor - first).astype(np.uint64)
                whole = mix64(span_hash(sums, first, last + length) + shape * np.uint64(0x9E3779B97F4A7C15))
                ends = pa.array(np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in
                         (gram.view(np.int64), whole.view(np.int64), (anchor - head).astype(np.int32),
                          (first - head).astype(np.int32), (last - head).astype(np.int32))]
                keys = [hashlib.md5(data[a:e].tobytes()).digest() for a, e in zip(part, part[1:])]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(keys, pa.binary()), pa.array(np.diff(part), pa.int64()), *lists],
                    names=["doc", "key", "n_bytes", "gram", "whole", "anchor", "first", "last"])
    return run


RUNS = ("doc long, key binary, n_bytes long, gram array<long>, whole array<long>, anchor array<int>, "
        "first array<int>, last array<int>")


def _cells(length: int):
    g = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            wanted, out, held = b.column(2).to_pylist(), [], 0
            for i in range(b.num_rows):
                part = offsets[i:i + 2]
                _, anchor, first, last, _, sums = window_runs(data, part, length)
                raw = data[part[0]:part[1]]
                own = np.isin(anchor, wanted[i])
                a, least, most = anchor[own], (anchor - last)[own], (anchor - first)[own]
                n = most // g - least // g + 1
                row = np.repeat(np.arange(len(a)), n)
                block = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(least // g, n)
                a, low = a[row], block * g
                high = low + g - 1
                o_low, o_high = np.maximum(low, least[row]), np.minimum(high, most[row])
                core = span_hash(sums, a - low, a - high + length)
                cell = mix64(core + block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                side = np.arange(g - 1)
                left, right = (a - high)[:, None] + side, (a - high + length)[:, None] + side
                known = np.concatenate([left >= (a - o_high)[:, None], right < (a - o_low + length)[:, None]], axis=1)
                at = np.concatenate([left, right], axis=1)
                tails = np.where(known, raw[np.clip(at, 0, len(raw) - 1)], 0).astype(np.uint8)
                ends = pa.py_buffer((np.arange(len(a) + 1, dtype=np.int32) * (2 * g - 2)).tobytes())
                tail = pa.Array.from_buffers(pa.binary(), len(a), [None, ends, pa.py_buffer(tails.tobytes())])
                key = pa.repeat(b.column(0)[i], len(a))
                out.append(pa.RecordBatch.from_arrays(
                    [key, pa.array(a.astype(np.int32)),
                     pa.array(block.astype(np.int32)), pa.array(cell),
                     pa.array(((o_low - low) * g + (o_high - low)).astype(np.int32)), tail],
                    names=["key", "anchor", "block", "cell", "own", "tail"]))
                held += len(a)
                if held >= 20_000 or i == b.num_rows - 1:
                    yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                    out, held = [], 0
    return run


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row of a cell and each of its offsets: what stands for the suffix, and the row."""
    g = BLOCK
    for b in batches:
        out, rows, offs = [], [], []
        for r, (cell, own, tail) in enumerate(zip(*(c.to_pylist() for c in b.columns))):
            head = cell.to_bytes(8, "big", signed=True)
            for o in range(own // g, own % g + 1):
                out.append(head + bytes([o]) + tail[g - 1 - o:2 * g - 2 - o])
                rows.append(r)
                offs.append(o)
        rows = pa.array(rows, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), *[c.take(rows) for c in b.columns], pa.array(offs, pa.int32())],
                                         names=["suffix", "cell", "own", "tail", "off"])


class _Node:
    __slots__ = ("depth", "kids", "sample")

    def __init__(self, depth: int, sample: int):
        self.depth, self.kids, self.sample = depth, {}, sample


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def _byte(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def blind_trie(strings: list[bytes], group: list[int]) -> tuple[list[int], list[int]]:
    """Order of the group's strings and the common prefix of each with the one before (the first: 0).

    Inner nodes hold only a depth and the bytes that branch there; an insertion
    goes down without looking at skipped bytes, compares with one string once, and
    so finds where it leaves the path.
    """
    root: list = [group[0]]  # a leaf: the numbers of equal strings
    for new in group[1:]:
        s, path, at = strings[new], [], root
        while isinstance(at, _Node):
            path.append(at)
            at = at.kids.get(_byte(s, at.depth)) or at.sample
        leaf = at
        other = strings[leaf[0]]
        same = _common(s, other)
        if same == len(s) == len(other):
            leaf.append(new)
            continue
        keep = [n for n in path if n.depth < same]
        hit = next((n for n in path if n.depth == same), None)
        mine: list = [new]
        if hit is not None:
            hit.kids[_byte(s, same)] = mine
            continue
        below = path[len(keep)] if len(keep) < len(path) else leaf
        node = _Node(same, leaf)
        node.kids = {_byte(other, same): below, _byte(s, same): mine}
        if keep:
            keep[-1].kids[_byte(s, keep[-1].depth)] = node
        else:
            root = node
    order, lcp, todo = [], [], [(root, 0)]
    while todo:
        at, near = todo.pop()
        if isinstance(at, _Node):
            kids = [at.kids[c] for c in sorted(at.kids)]
            todo += [(x, at.depth if k else near) for k, x in reversed(list(enumerate(kids)))]
        else:
            order += at
            lcp += [near] + [len(strings[at[0]])] * (len(at) - 1)
    return order, lcp


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """Order of the strings and each one's common prefix with the one before.

    Multikey quicksort splits by one byte at a time up to depth ``shallow``;
    groups that agree up to there are ordered by a blind trie.
    """
    order, lcp = [], []
    todo = [(list(range(len(strings))), 0, 0)]
    while todo:
        group, depth, near = todo.pop()
        if len(group) <= 1:
            order += group
            lcp += [near] * len(group)
        elif depth >= shallow:
            o, c = blind_trie(strings, group)
            order += o
            lcp += [near] + c[1:]
        else:
            heads = [_byte(strings[i], depth) for i in group]
            pivot = sorted((heads[0], heads[len(heads) // 2], heads[-1]))[1]
            parts = ([i for i, c in zip(group, heads) if c < pivot], [i for i, c in zip(group, heads) if c == pivot],
                     [i for i, c in zip(group, heads) if c > pivot])
            if pivot == -1:  # all of these end here: equal strings
                order += parts[1]
                lcp += [near] + [depth] * (len(parts[1]) - 1)
                todo.append((parts[2], depth, depth))
                continue
            jobs, first = [], near
            for part, deeper in zip(parts, (0, 1, 0)):
                if part:
                    jobs.append((part, depth + deeper, first))
                    first = depth
            todo += reversed(jobs)
    return order, lcp


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell and offset; returns the rows whose suffix stands twice."""
    held: pa.Table | None = None

    def doubles(t: pa.Table) -> pa.RecordBatch:
        strings = t.column(0).to_pylist()
        order, lcp = deep_shallow_sort(strings)
        twice = set()
        for k in range(1, len(order)):
            if lcp[k] == len(strings[order[k]]) == len(strings[order[k - 1]]):
                twice.update((order[k - 1], order[k]))
        out = t.drop_columns(["suffix"]).take(pa.array(sorted(twice), pa.int64())).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in out.columns],
                                          names=out.column_names)

    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows >= 20_000:
            heads = held.column(0)
            final, cut = heads[-1].as_py()[:9], held.num_rows
            while cut and heads[cut - 1].as_py()[:9] == final:
                cut -= 1
            if cut:
                yield doubles(held.slice(0, cut))
                held = held.slice(cut)
    if held is not None and held.num_rows:
        yield doubles(held)


def removed_ranges(documents: DataFrame, path: str, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(texts: doc, key, n_bytes, copies) and (ranges: key, first, last): starts of windows found twice."""
    docs = documents.select(id_order(F.col("doc_id")).alias("doc"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    runs = stored(docs.mapInArrow(_runs(length), RUNS), f"{path}/runs")
    texts = runs.select("doc", "key", "n_bytes")
    copies = stored(texts.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc").alias("doc")), f"{path}/copies")
    # one text of each group of exact copies
    once = runs.where(f"n_bytes >= {length}").join(copies.select("key", "doc"), ["key", "doc"]).select(
        "doc", "key", F.explode(F.arrays_zip("gram", "whole", "anchor", "first", "last")).alias("r")).select(
        "doc", "key", "r.*")
    kinds = once.groupBy("gram", "whole").agg(
        F.count("*").alias("c"), F.min(F.struct("key", "doc", "anchor")).alias("one"))
    kinds = stored(kinds, f"{path}/kinds")
    # runs that are equal as a whole
    equal = once.join(kinds.where("c > 1").select("gram", "whole"), ["gram", "whole"]).select("key", "first", "last")
    # k-grams with runs that differ
    several = kinds.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1").select("gram")
    stand = kinds.join(several, "gram").select("one.*").groupBy("key", "doc").agg(F.collect_set("anchor").alias("anchors"))
    own = docs.withColumn("key", F.unhex(F.md5("text"))).join(stand, ["key", "doc"]).dropDuplicates(["key", "doc"])
    cells = stored(own.select("key", "text", "anchors").mapInArrow(
        _cells(length), "key binary, anchor int, block int, cell long, own int, tail binary"), f"{path}/cells")
    rows = stored(cells.groupBy("cell", "own", "tail").agg(F.count("*").alias("c")), f"{path}/rows")
    mixed = rows.groupBy("cell").agg(F.count("*").alias("k")).where("k > 1").select("cell")
    suffixes = rows.join(mixed, "cell").select("cell", "own", "tail").mapInArrow(
        _strings, "suffix binary, cell long, own int, tail binary, off int")
    shallow = F.substring("suffix", 1, SHALLOW)
    twice = (suffixes.repartition(shallow).sortWithinPartitions(F.substring("suffix", 1, 9)).mapInArrow(
        _sort_suffixes, "cell long, own int, tail binary, off int"))
    all_own = rows.where("c > 1").select("cell", "own", "tail", F.explode(F.sequence(
        F.floor(F.col("own") / BLOCK).cast("int"), F.col("own") % BLOCK)).alias("off"))
    found = stored(twice.unionByName(all_own).groupBy("cell", "own", "tail").agg(F.collect_set("off").alias("offs")),
                   f"{path}/found")
    start = F.col("anchor") - F.col("block") * BLOCK - F.col("off")
    short = cells.join(found, ["cell", "own", "tail"]).select("key", "anchor", "block", F.explode("offs").alias("off")).select(
        "key", start.alias("first"), start.alias("last"))
    counted = texts.join(copies.select("key", "copies"), "key")
    return counted, equal.unionByName(short)


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            out = []
            for r, (copies, ranges) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                raw = data[offsets[r]:offsets[r + 1]]
                n = len(raw)
                edge = np.zeros(n + 1, np.int32)
                if n >= length and copies > 1:
                    edge[0] += 1
                elif ranges:
                    first, last = (np.array([x[c] for x in ranges], np.int64) for c in ("first", "last"))
                    np.add.at(edge, first, 1)
                    np.add.at(edge, last + length, -1)
                gone = np.cumsum(edge[:n]) > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if n else 0
                kept = raw[~gone].tobytes()
                out.append((n, n - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)]],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes); one row per input row.

    Every byte covered by a string of ``length`` bytes (16 or more) that also starts
    elsewhere, in the same or another document, is removed. A null text is empty; a null
    doc_id is an ordinary document; equal rows are copies of each other and so lose
    everything if they have ``length`` bytes; other columns are ignored.
    """
    path = scratch(documents.sparkSession, "suffix_dedup")
    texts, ranges = removed_ranges(documents, path, length)
    ranges = stored(ranges.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), f"{path}/ranges")
    doomed = stored(texts.join(ranges, "key", "left").where(f"ranges IS NOT NULL OR (copies > 1 AND n_bytes >= {length})")
                    .select("doc", "key", "copies", F.when(F.col("copies") == 1, F.col("ranges")).alias("ranges"))
                    .dropDuplicates(["doc", "key"]), f"{path}/doomed")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), id_order(F.col("doc_id")).alias("doc"),
                            text.alias("text"), F.unhex(F.md5(text)).alias("key"))
    both = docs.join(doomed, ["doc", "key"], "left").select("doc_id", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "ranges")
    return both.mapInArrow(_remove(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")
