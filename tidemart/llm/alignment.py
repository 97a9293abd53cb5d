"""Cross-tokenizer alignment: which tokens of two tokenizers end together, and how often.

Every text is tokenised whole by both tokenizers. Where a space-marked token of each
starts at the same byte, both have ended together before it; these verified anchors cut
the document into windows of token ids. Most windows are one word, so a window's alignment
is remembered by its ids (tuples of A ids and B ids, packed as bytes) and worked out
once per task. Links of a document are stored as (pair, count); corpus counts are sums
over all documents, and each document's sums come back from two joins: the ``top`` most
frequent pairs are a broadcast table of fixed size, all others a shuffle join.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm.common import read_table, scratch, stored

PIECE = 100_000
SLICE = 1 << 20
TOP = 1 << 16
LONG_RUN = 5000
# a space between two words: no token of either tokenizer reaches across its left side
_BETWEEN = regex.compile(r"(?<=\w) (?=\w)")


def byte_alphabet() -> dict[str, int]:
    """Character of the byte-level alphabet -> byte: printable bytes stand for themselves, the rest follow 255."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevelTokens:
    """Ids by a byte-level BPE file of the tokenizers library; special tokens in a text are plain text.

    If the file's ids follow the order of its merges and it cuts texts by the usual
    pattern only, tiktoken runs the file's merges: the same ids, four times as fast.
    Texts with very long words go to the tokenizers library in any case.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            own = json.load(f)
        alphabet, vocab = byte_alphabet(), own["model"]["vocab"]
        special = {t["content"] for t in own["added_tokens"]}
        size = max([*vocab.values(), *(t["id"] for t in own["added_tokens"])]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if token in special else bytes(alphabet[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in own["model"]["merges"]]
        in_order = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        cut = own["pre_tokenizer"] or {}
        plain = (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")) == ("ByteLevel", True, False)
        # no normaliser, a pattern that covers every text and all 256 bytes in the vocabulary: the ids give back the bytes
        self.lossless = plain and not own["normalizer"] and len({x for x in self.bytes if len(x) == 1}) == 256
        self.fast = None
        if in_order and self.lossless and own["model"]["type"] == "BPE":
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
                self.bytes[i]: i for token, i in vocab.items() if token not in special})

    def encode(self, texts: list[str], long_words: bool = False) -> list[np.ndarray]:
        if self.fast is None or long_words:
            return [np.array(e.ids, np.int64) for e in self.library.encode_batch(texts, add_special_tokens=False)]
        return [np.array(self.fast.encode_ordinary(t), np.int64) for t in texts]


class PieceTokens:
    """Ids by a sentencepiece model, which puts a space before each text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        piece = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(piece)]
        # if no piece has a space behind another character, none reaches across the left side of a space
        self.cuttable = not any("▁" in p.lstrip("▁") for p in piece)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def pieces(text: str, most: int = PIECE) -> list[str]:
    """The text, cut at spaces between words into parts of about ``most`` characters.

    The space at a cut belongs to no part: both tokenizers put one before each part.
    """
    out, at = [], 0
    while len(text) - at > most:
        cut = _BETWEEN.search(text, at + most)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.end()
    return [*out, text[at:]]


class Aligner:
    """Aligns texts; remembers windows, and starts anew beyond ``most`` windows or ``most_bytes`` of ids."""

    def __init__(self, path_a: str, path_b: str, most: int = 300_000, most_bytes: int = 1 << 25, piece: int = PIECE):
        self.a, self.b = ByteLevelTokens(path_a), PieceTokens(path_b)
        self.most, self.most_bytes = most, most_bytes
        self.piece = piece if self.b.cuttable and self.a.fast is not None else 2 ** 62
        self.forget()
        self.size_a, self.size_b = len(self.a.bytes), len(self.b.bytes)
        # by id, those of B behind those of A: length in bytes, and the id as text with the mark behind it
        self.size = np.array([len(x) for x in (*self.a.bytes, *self.b.bytes)], np.int64)
        self.name = [b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for n in (self.size_a, self.size_b) for i in range(n)]
        self.name_size = np.array([len(x) for x in self.name])
        table = lambda t: (np.array([len(x) for x in t], np.int64), np.array([x[:1] == b" " for x in t]))
        self.len_a, self.space_a = table(self.a.bytes)
        self.len_b, self.space_b = table(self.b.bytes)

    def _windows(self, keys: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Groups as text of each window; the linked pairs (a * size_b + b) of all, and how many each has."""
        ids = np.frombuffer(b"".join(keys), "<u4").astype(np.int64)
        of_b = ids >= self.size_a
        a, b = ids[~of_b], ids[of_b]
        # both sides of a window have equal bytes, so the ends agree across windows too
        end_a, end_b = np.cumsum(self.size[a]), np.cumsum(self.size[b])
        here = np.zeros(int(end_a[-1]) + 1, bool)
        here[end_a] = True
        shared_b = here[end_b]
        here[:] = False
        here[end_b[shared_b]] = True
        shared_a = here[end_a]
        last_a, last_b = np.flatnonzero(shared_a), np.flatnonzero(shared_b)
        # group after group: its A tokens, then its B tokens, each with the mark behind it
        row, total = np.empty(len(ids), np.int64), len(self.size)
        row[np.arange(len(a)) + np.append(0, last_b + 1)[np.cumsum(shared_a) - shared_a]] = a + total * shared_a
        row[np.arange(len(b)) + (last_a + 1)[np.cumsum(shared_b) - shared_b]] = b + 2 * total * shared_b
        text = b"".join([self.name[x] for x in row.tolist()])
        width = np.cumsum(self.name_size[row])
        edge = np.cumsum([len(k) // 4 for k in keys])
        cut = np.append(0, width[edge - 1]).tolist()
        links = a[last_a] * self.size_b + b[last_b] - self.size_a
        done = np.cumsum(shared_b)[np.cumsum(of_b)[edge - 1] - 1]
        return [text[i:j - 1] for i, j in zip(cut, cut[1:])], links, np.diff(done, prepend=0)

    def windows(self, keys: list[bytes]) -> np.ndarray:
        """Number of each window in ``texts``, ``links``, ``many`` and ``begin``; new ones are worked out and added."""
        known = self.memo
        found = [known.get(k) for k in keys]
        gone = [i for i, f in enumerate(found) if f is None]
        if gone:
            new = list(dict.fromkeys([keys[i] for i in gone]))
            texts, links, many = self._windows(new)
            known.update(zip(new, range(len(self.texts), len(self.texts) + len(new))))
            self.texts += texts
            self.links, self.many = np.concatenate([self.links, links]), np.concatenate([self.many, many])
            self.begin = np.cumsum(self.many) - self.many
            self.held += sum(map(len, new))
            for i in gone:
                found[i] = known[keys[i]]
        return np.array(found, np.int64)

    def forget(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.links = self.many = self.begin = np.zeros(0, np.int64)
        self.held = 0

    def align(self, parts: list[str]) -> tuple:
        """For parts of texts: whether the bytes agree, A and B tokens, groups as text, and links (part, pair)."""
        if len(self.memo) > self.most or self.held > self.most_bytes:
            self.forget()
        spaced = [" " + p for p in parts]
        want = [p.encode() for p in spaced]
        gaps = np.diff(np.flatnonzero(np.frombuffer(b"".join(want), np.uint8) <= 0x20), append=sum(map(len, want)))
        all_a = self.a.encode(spaced, bool(gaps.max(initial=0) > LONG_RUN))
        all_b = self.b.encode(parts)
        ok = [b"".join([self.b.bytes[i] for i in y]) == w for y, w in zip(all_b, want)]
        same = lambda x, w: b"".join([self.a.bytes[i] for i in x.tolist()]) == w
        if not self.a.lossless:
            ok = [fine and same(x, w) for fine, x, w in zip(ok, all_a, want)]
        good = [k for k, fine in enumerate(ok) if fine]
        n_a, n_b, text = [0] * len(parts), [0] * len(parts), [b""] * len(parts)
        for k in good:
            n_a[k], n_b[k] = len(all_a[k]), len(all_b[k])
        if not good:
            return ok, n_a, n_b, text, np.zeros(0, np.int64), np.zeros(0, np.int64)
        many_a, many_b = (np.array([len(x[k]) for k in good]) for x in (all_a, all_b))
        a = np.concatenate([all_a[k] for k in good])
        b = np.fromiter(chain.from_iterable(all_b[k] for k in good), np.int64, many_b.sum())
        del all_a, all_b
        start_a, start_b = (np.cumsum(x) - x for x in (self.len_a[a], self.len_b[b]))
        first_a, first_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        # anchors: both have a space-marked token here (or the part begins)
        here = np.zeros(sum(len(want[k]) for k in good) + 1, bool)
        here[start_a[self.space_a[a]]] = True
        at_b = self.space_b[b] & here[start_b]
        at_b[first_b] = True
        here[:] = False
        here[start_b[at_b]] = True
        at_a = here[start_a]
        from_a, from_b = np.flatnonzero(at_a), np.flatnonzero(at_b)
        # one row of ids: window after window, its A ids and then its B ids
        ids = np.empty(len(a) + len(b), "<u4")
        ids[np.arange(len(a)) + from_b[np.cumsum(at_a) - 1]] = a
        ids[np.arange(len(b)) + np.append(from_a[1:], len(a))[np.cumsum(at_b) - 1]] = b + self.size_a
        cut = (4 * np.append(from_a + from_b, len(ids))).tolist()
        raw = ids.tobytes()
        which = self.windows([raw[s:e] for s, e in zip(cut, cut[1:])])
        edge = np.append(np.searchsorted(from_a, first_a), len(which))
        chosen = which.tolist()
        for g, k in enumerate(good):
            text[k] = b";".join([self.texts[w] for w in chosen[edge[g]:edge[g + 1]]])
        links = self.many[which]
        take = np.repeat(self.begin[which] - (np.cumsum(links) - links), links) + np.arange(links.sum())
        part = np.repeat(np.repeat(np.array(good), np.diff(edge)), links)
        return ok, n_a, n_b, text, part, self.links[take]


@lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str, piece: int) -> Aligner:
    return Aligner(path_a, path_b, piece=piece)


DOCUMENT_ROWS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                 "groups string, pairs binary, counts binary")


def aligned_texts(aligner: Aligner, texts: list[str | None], with_groups: bool) -> Iterator[tuple]:
    """n_a, n_b, n_links, sha256 of the groups, the groups, pairs and counts of each text."""
    todo = [(d, part) for d, t in enumerate(texts) if t for part in pieces(t, aligner.piece)]
    done, at = 0, 0
    kept: list = []
    while at < len(todo) or done < len(texts):
        size, end = 0, at
        while end < len(todo) and size < SLICE:
            size, end = size + len(todo[end][1]), end + 1
        doc = [d for d, _ in todo[at:end]]
        ok, n_a, n_b, text, part, pair = aligner.align([p for _, p in todo[at:end]]) if doc else ([], [], [], [], *[np.zeros(0, np.int64)] * 2)
        # distinct pairs of each document of this slice
        owner = np.array(doc, np.int64)[part] if len(part) else part
        both, count = np.unique((owner << 40) | pair, return_counts=True)
        owner, pair = both >> 40, both & ((1 << 40) - 1)
        last = todo[end][0] if end < len(todo) else len(texts)  # a document that goes on is not finished yet
        for d in range(done, min(last + 1, len(texts))):
            if not kept:
                kept = [True, 0, 0, hashlib.sha256(), [], [], []]
            for k in range(*np.searchsorted(doc, [d, d + 1])):
                kept[0] &= ok[k]
                kept[1], kept[2] = kept[1] + n_a[k], kept[2] + n_b[k]
                if kept[4]:
                    kept[3].update(b";")
                kept[3].update(text[k])
                kept[4].append(text[k] if with_groups else b"-")
            s, e = np.searchsorted(owner, [d, d + 1])
            kept[5].append(pair[s:e])
            kept[6].append(count[s:e])
            if d == last:
                continue
            p, c = np.concatenate(kept[5]), np.concatenate(kept[6])
            if len(kept[5]) > 1:
                p, back = np.unique(p, return_inverse=True)
                c = np.bincount(back, c, len(p)).astype(np.int64)
            if kept[0] and kept[4]:
                yield (kept[1], kept[2], int(c.sum()), kept[3].hexdigest(),
                       b";".join(kept[4]).decode() if with_groups else None, p, c)
            else:
                yield 0, 0, 0, "", "" if with_groups else None, p[:0], c[:0]
            kept = []
        done, at = last, end


def _align(path_a: str, path_b: str, piece: int, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = _aligner(path_a, path_b, piece), TaskContext.get().partitionId() << 36
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = list(aligned_texts(aligner, part.column(1).to_pylist(), with_groups))
                rows = np.arange(row, row + len(found))
                row += len(found)
                ints = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), part.column(0), *ints, ints[2], pa.array([f[3] for f in found], pa.string()),
                     pa.array([f[4] for f in found], pa.string()),
                     pa.array([f[5].astype("<u8").tobytes() for f in found], pa.binary()),
                     pa.array([f[6].astype("<u4").tobytes() for f in found], pa.binary())],
                    names=[c.split()[0] for c in DOCUMENT_ROWS.split(", ")])
    return run


def align_documents(documents: DataFrame, path_a: str, path_b: str, piece: int = PIECE, with_groups: bool = False) -> DataFrame:
    """A row per document: its groups of tokens that cover the same bytes, and its linked pairs.

    row (number of the row), doc_id, n_a, n_b (tokens), n_groups, n_links, groups_sha256, groups
    (``a1,a2|b1;a3|b2,b3``; null unless ``with_groups``), pairs (packed 64-bit a * size of B + b,
    ascending) and counts (packed 32-bit). Null and empty texts, and texts that either
    tokenizer does not give back byte for byte, have no tokens and the sha256 ''. A null or repeated doc_id is a
    row like any other; other columns are ignored. Texts over ``piece`` characters are
    encoded in parts cut at spaces between words, which changes no id (if the
    vocabularies allow it; a text without such spaces is one part, whatever its length).
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_align(path_a, path_b, piece, with_groups), DOCUMENT_ROWS)


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row index, pair and count of every stored link of a batch with columns pairs and counts."""
    pairs, counts = batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()
    row = np.repeat(np.arange(len(pairs)), [len(p) // 8 for p in pairs])
    return row, np.frombuffer(b"".join(pairs), "<u8").astype(np.int64), np.frombuffer(b"".join(counts), "<u4").astype(np.int64)


def _partial_counts(most: int = 2_000_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            pair, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return pair, np.bincount(back, np.concatenate([h[1] for h in held]), len(pair)).astype(np.int64)

        out = lambda p, c: pa.RecordBatch.from_arrays([pa.array(p), pa.array(c)], names=["pair", "count"])
        for batch in batches:
            held.append(_unpacked(batch)[1:])
            if sum(len(h[0]) for h in held) > most:
                held = [merged()]
                if len(held[0][0]) > most // 2:
                    yield out(*held.pop())
        if held:
            yield out(*merged())
    return run


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, count, best: links of each id pair over all documents; best if no other pair of its B id has more."""
    total = aligned.select("pairs", "counts").mapInArrow(_partial_counts(), "pair long, count long").groupBy("pair").agg(
        F.sum("count").alias("count"))
    same_b = Window.partitionBy(F.col("pair") % size_b)  # at most as many rows as A has ids
    return total.select("pair", "count", (F.col("count") == F.max("count").over(same_b)).alias("best"))


def _look_up(pair: np.ndarray, count: np.ndarray, best: np.ndarray, rest: bool):
    """Sums of a document over the frequent pairs; or, with ``rest``, its links to all other pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, code, n = _unpacked(batch)
            at = np.minimum(np.searchsorted(pair, code), max(len(pair) - 1, 0))
            hit = pair[at] == code if len(pair) else np.zeros(len(code), bool)
            if rest:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").take(pa.array(row[~hit])), pa.array(code[~hit]), pa.array(n[~hit])], names=["row", "pair", "n"])
                continue
            row, at, n = row[hit], at[hit], n[hit]
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row, n * best[at])
            np.add.at(sums[1], row, n * count[at])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sums[0]), pa.array(sums[1])],
                                             names=["row", "n_best", "count_sum"])
    return run


def link_sums(aligned: DataFrame, counts: DataFrame, top: int = TOP) -> DataFrame:
    """row, n_best, count_sum of each document from the corpus counts.

    The ``top`` most frequent pairs (a fixed bound) are looked up in the tasks; links to
    all other pairs, a small share of all links, are joined by a shuffle.
    """
    first = counts.orderBy(F.col("count").desc(), "pair").limit(top).toArrow().sort_by("pair")
    table = [first.column(c).to_numpy() for c in ("pair", "count", "best")]
    packed = aligned.select("row", "pairs", "counts")
    near = packed.mapInArrow(_look_up(*table, rest=False), "row long, n_best long, count_sum long")
    far = packed.mapInArrow(_look_up(*table, rest=True), "row long, pair long, n long").join(counts, "pair").select(
        "row", (F.col("n") * F.col("best").cast("long")).alias("n_best"), (F.col("n") * F.col("count")).alias("count_sum"))
    return near.unionByName(far).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(documents: DataFrame, vocabulary_a: str = "byte_bpe_50k.json", vocabulary_b: str = "piece_bpe_32k.model",
              top: int = TOP) -> DataFrame:
    """``align_documents`` with n_best and count_sum of the document's links; a row per input row."""
    path_a, path_b = public_tokenizers.path(vocabulary_a), public_tokenizers.path(vocabulary_b)
    path = scratch(documents.sparkSession, "alignment")
    align_documents(documents, path_a, path_b).write.option("compression", "zstd").parquet(f"{path}/documents")
    aligned = documents.sparkSession.read.schema(DOCUMENT_ROWS).parquet(f"{path}/documents")
    counts = stored(pair_counts(aligned, len(PieceTokens(path_b).bytes)), f"{path}/pairs")
    return aligned.join(link_sums(aligned, counts, top), "row")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
