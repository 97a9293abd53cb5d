"""Edit-aware token counts: a segment tree of pre-token runs per document.

A text is cut at spaces where the tokenizer's pre-token pattern always cuts, and runs
of ``LEAF`` pieces are the leaves of a segment tree that sums characters and tokens.
When a document is edited, only the leaves touched by an edit, plus the neighbouring
leaf where an edit reaches a leaf's border, are cut and encoded anew; the sums on the
paths to the root are updated. The trees are kept as a table, one row per document.

A space is such a cut if the character before or the character after it is no white
space: the pattern attaches one space to what follows, and a run of white space gives
its last space to a following word. So the pieces encode independently, and a cut stays
one as long as these three characters are not edited.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import id_order, read_table, scratch, stored

LEAF = 32
# personal data and secrets that the registered query redacts
REDACT = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email>"),
    (r"password=\S+", "<secret>"),
    (r"\b\d{1,3}(?:\.\d{1,3}){3}\b", "<ip>"),
    (r"(?:\(\d{3}\) ?)?\b\d{3}-\d{4}\b", "<phone>"),
    (r"\b\d{13,19}\b", "<number>"),
)
_UNSAFE = re.compile(r"\s (?:\s|\Z)")


class PieceCounter:
    """Token counts of pieces, remembered in bounded memory."""

    def __init__(self, vocabulary: str, most: int = 400_000, longest: int = 48):
        with open(public_tokenizers.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.most, self.longest, self.memo = most, longest, {}

    def one(self, piece: str) -> int:
        return len(self.encoding.encode_ordinary(piece))

    def counts(self, pieces: list[str]) -> list[int]:
        memo = self.memo
        try:
            return [memo[p] for p in pieces]
        except KeyError:
            pass
        if len(memo) > self.most:
            memo.clear()
        out = []
        for p in pieces:
            n = memo.get(p)
            if n is None:
                n = self.one(p)
                if len(p) <= self.longest:
                    memo[p] = n
            out.append(n)
        return out


_COUNTERS: dict[str, PieceCounter] = {}


def counter(vocabulary: str) -> PieceCounter:
    if vocabulary not in _COUNTERS:
        _COUNTERS[vocabulary] = PieceCounter(vocabulary)
    return _COUNTERS[vocabulary]


def cut(text: str) -> list[str]:
    """Pieces that the tokenizer encodes independently; together they are the text."""
    if not text:
        return []
    head, *rest = text.split(" ")
    pieces = [head] + [" " + p for p in rest]
    if _UNSAFE.search(text):
        joined = [pieces[0]]
        for p in pieces[1:]:
            before = joined[-1][-1:]
            if before and before.isspace() and (len(p) == 1 or p[1].isspace()):
                joined[-1] += p
            else:
                joined.append(p)
        pieces = joined
    return pieces if pieces[0] else pieces[1:]


def leaves(text: str, code: PieceCounter, leaf: int = LEAF) -> tuple[list[int], list[int]]:
    """Characters and tokens of each run of ``leaf`` pieces."""
    pieces = cut(text)
    tokens = code.counts(pieces)
    return ([sum(map(len, pieces[i:i + leaf])) for i in range(0, len(pieces), leaf)],
            [sum(tokens[i:i + leaf]) for i in range(0, len(tokens), leaf)])


class TokenTree:
    """Sums of characters and tokens over leaves; node k has the children 2k and 2k + 1."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.size = 1 << max(0, len(chars) - 1).bit_length()
        self.nodes = np.zeros((2 * self.size, 2), np.int64)
        self.nodes[self.size:self.size + len(chars), 0] = chars
        self.nodes[self.size:self.size + len(chars), 1] = tokens
        for k in range(self.size - 1, 0, -1):
            self.nodes[k] = self.nodes[2 * k] + self.nodes[2 * k + 1]

    @classmethod
    def load(cls, data: bytes) -> TokenTree:
        tree = cls.__new__(cls)
        tree.nodes = np.frombuffer(data, np.int64).reshape(-1, 2).copy()
        tree.size = len(tree.nodes) // 2
        return tree

    def dump(self) -> bytes:
        return self.nodes.tobytes()

    @property
    def chars(self) -> int:
        return int(self.nodes[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.nodes[1, 1])

    def find(self, pos: int) -> tuple[int, int]:
        """The leaf that holds character ``pos`` (the last one at the end), and its start."""
        k, start = 1, 0
        while k < self.size:
            left = int(self.nodes[2 * k, 0])
            k, start = (2 * k, start) if pos - start < left or not self.nodes[2 * k + 1, 0] else (2 * k + 1, start + left)
        return k - self.size, start

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        k = leaf + self.size
        change = np.array([chars, tokens]) - self.nodes[k]
        while k:
            self.nodes[k] += change
            k //= 2

    def span(self, pos: int, end: int) -> tuple[int, int, int, int]:
        """Leaves first..last to encode anew for an edit of pos..end, and their characters a..b."""
        first, a = self.find(pos)
        if pos < a + 2 and a > 0:  # the space that starts the leaf, or the character after it, is edited
            first, a = self.find(a - 1)
            while pos < a + 2 and a > 0:
                first, a = self.find(a - 1)
        last, b = self.find(min(end, max(0, self.chars - 1)))
        b += int(self.nodes[last + self.size, 0])
        while b <= end and b < self.chars:
            last, b = self.find(b)
            b += int(self.nodes[last + self.size, 0])
        return first, last, a, b

    def edit(self, text: str, edits: list[tuple[int, int, str]], code: PieceCounter) -> tuple[str, int]:
        """Apply edits (position, characters deleted, text inserted; not overlapping) to ``text``.

        Returns the new text and the number of characters encoded. Edits that
        share leaves are encoded together; the old text's positions hold for all.
        """
        spans: list[list] = []
        for pos, gone, new in sorted(edits, key=lambda e: (e[0], e[1])):
            first, last, a, b = self.span(pos, pos + gone)
            if spans and first <= spans[-1][1]:
                s = spans[-1]
                s[1], s[3] = max(s[1], last), max(s[3], b)
                s[4].append((pos, gone, new))
            else:
                spans.append([first, last, a, b, [(pos, gone, new)]])
        out, at, encoded = [], 0, 0
        for first, last, a, b, own in spans:
            parts, p = [], a
            for pos, gone, new in own:
                parts += [text[p:pos], new]
                p = pos + gone
            region = "".join([*parts, text[p:b]])
            for k in range(first + 1, last + 1):
                self.set(k, 0, 0)
            self.set(first, len(region), sum(code.counts(cut(region))))
            out += [text[at:a], region]
            at, encoded = b, encoded + len(region)
        return "".join([*out, text[at:]]), encoded


def _build(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = counter(vocabulary)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                p = b.slice(at, 500)
                trees = [TokenTree(*leaves(t or "", code)) for t in p.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*p.columns[:3], pa.array([t.tokens for t in trees], pa.int64()),
                     pa.array([t.dump() for t in trees], pa.binary())],
                    names=["doc_id", "_doc", "_row", "n_tokens", "tree"])
    return run


def _rows(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), id_order(F.col("doc_id")).alias("_doc"),
                            F.xxhash64(text).alias("_row"), text.alias("text"))


STATE = "doc_id long, _doc long, _row long, n_tokens long, tree binary"


def token_trees(documents: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """doc_id, n_tokens and the segment tree of every whole text (null: empty), a row per input row."""
    return _rows(documents).mapInArrow(_build(vocabulary), STATE)


def redactions(documents: DataFrame, patterns=REDACT) -> DataFrame:
    """Edits that replace personal data and secrets: _doc, _row, text, edits; only edited documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile("|".join(f"({p})" for p, _ in patterns))
        kind = pa.list_(pa.struct([("pos", pa.int32()), ("gone", pa.int32()), ("new", pa.string())]))
        for b in batches:
            rows, edits = [], []
            for r, text in enumerate(b.column(2).to_pylist()):
                found = [{"pos": m.start(), "gone": m.end() - m.start(), "new": patterns[m.lastindex - 1][1]}
                         for m in find.finditer(text)]
                if found:
                    rows.append(r)
                    edits.append(found)
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(rows, pa.int64())) for c in b.columns],
                                              pa.array(edits, kind)], names=["_doc", "_row", "text", "edits"])
    return _rows(documents).select("_doc", "_row", "text").mapInArrow(
        run, "_doc long, _row long, text string, edits array<struct<pos:int,gone:int,new:string>>")


def update_counts(trees: DataFrame, edits: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Trees after the edits: doc_id, n_tokens, n_edits, n_tokens_after, n_chars, n_encoded, tree, text.

    ``n_encoded`` of the ``n_chars`` characters of the edited document were encoded
    again (0 without edits); ``text`` is the edited text (null without edits).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = counter(vocabulary)
        for b in batches:
            out = []
            for data, text, edits in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                tree, encoded = TokenTree.load(data), 0
                if edits:
                    text, encoded = tree.edit(text, [(e["pos"], e["gone"], e["new"]) for e in edits], code)
                out.append((len(edits or ()), tree.tokens, tree.chars, encoded, tree.dump(), text if edits else None))
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 6, kinds)]],
                names=["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars", "n_encoded", "tree", "text"])

    once = edits.dropDuplicates(["_doc", "_row"])
    return trees.join(once, ["_doc", "_row"], "left").select("doc_id", "n_tokens", "tree", "text", "edits").mapInArrow(
        run, "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_chars long, n_encoded long, "
             "tree binary, text string")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after redaction of personal data."""
    documents = read_table(spark, sf_dir, "documents")
    path = scratch(spark, "token_counts")
    trees = stored(token_trees(documents), f"{path}/trees")
    edits = stored(redactions(documents), f"{path}/edits")
    return update_counts(trees, edits).drop("tree", "text")
