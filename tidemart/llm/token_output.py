"""Token-ID output: bit-plane shuffled blocks of ids, zstandard per plane, with a chunk index.

Format of one output folder (all parts are Parquet tables, written by Spark's
committers, so any file system that Spark reaches will do and a repeated task
never leaves half a file):

``blocks``  one row per chunk of up to ``block`` ids of one shard, in id order:
            ``shard``, ``chunk``, ``first`` (ids of the shard before the chunk), ``n_ids``,
            ``planes`` (zstandard frames: 4 byte planes or 32 bit planes of the
            little-endian 32-bit ids), ``docs`` (documents overlapping the chunk:
            doc_id, start in the shard, n_tokens).
``index``   one row per chunk: ``shard``, ``chunk``, ``id_from``, ``id_to`` (global id range),
            ``doc_from``, ``doc_to``, ``plane_bytes``.

Documents are range-partitioned by doc_id, so shard k holds smaller ids than
shard k+1; a shard's global base is the sum of the shards before it.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidemart.llm.common import scratch

BLOCK = 1 << 16
END_ID = 1
BLOCK_SCHEMA = ("shard int, chunk int, first long, n_ids int, planes array<binary>, "
                "docs array<struct<doc_id:long,start:long,n_tokens:long>>")


# a word of Latin letters (composed, one lower-case letter each) and punctuation behind it:
# the tokenizer's pattern cuts exactly there, lower-casing is all its normaliser does
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-/:-@\\[-`{-~]*)")


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Ids of a text by a tokenizer that never joins characters across a space.

    The text is cut at spaces and newlines, and each distinct piece is encoded once by
    the tokenizers library and remembered. Most new pieces are a known word in another
    case or before punctuation, so plain words are remembered on their own and encoded
    by the library's model directly; all other pieces take the whole tokenizer.
    Memory is bounded: a memo of ``most`` entries becomes the old one and is looked up
    only for what the new one lacks, so frequent entries stay and rare ones go;
    entries over ``longest`` characters are not kept.
    """

    def __init__(self, path: str, most: int = 150_000, longest: int = 48):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.most, self.longest = most, longest
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_pieces, self.old_words = self.pieces, self.words
        self.marks: dict[str, bytes] = {}
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)])
        self.spelled = {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in letters}

    def _whole(self, piece: str) -> bytes:
        return packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = self.old_words.get(word)
            if found is None:
                found = packed([t.id for t in self.model.tokenize(word.translate(self.spelled))])
            if len(word) <= self.longest:
                self.words[word] = found
        return found

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        m = _PLAIN.fullmatch(piece)
        if m is None:
            return self._whole(piece)
        word, mark = m.groups()
        out = self._word(word.lower())
        if mark and mark not in self.marks:
            if len(mark) > 8 or len(self.marks) > 10_000:
                return out + self._whole(mark)
            self.marks[mark] = self._whole(mark)
        return out + self.marks[mark] if mark else out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if len(self.pieces) > self.most:
            self.old_pieces, self.pieces = self.pieces, {}
        if len(self.words) > self.most:
            self.old_words, self.words = self.words, {}
        pieces, known, old = text.replace("\n", " ").split(" "), self.pieces, self.old_pieces
        new = set(pieces).difference(known)
        for p in new:
            ids = old.get(p)
            known[p] = self._piece(p) if ids is None else ids
        out = b"".join([known[p] for p in pieces])
        for p in new:
            if len(p) > self.longest:
                del known[p]
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def to_planes(ids: np.ndarray, bits: bool, level: int = 3) -> list[bytes]:
    """Transpose 32-bit ids to byte or bit planes (lowest first), each compressed."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if bits:
        planes = [np.packbits((p >> b) & 1) for p in planes for b in range(8)]
    press = zstandard.ZstdCompressor(level=level)
    return [press.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    opened = [np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.uint8) for p in planes]
    if len(opened) == 32:
        each = [np.unpackbits(p, count=n) for p in opened]
        opened = [sum(each[8 * k + b] << b for b in range(8)).astype(np.uint8) for k in range(4)]
    return np.ascontiguousarray(np.stack(opened, axis=1)).view("<u4").reshape(-1)


def _write_shard(path: str, block: int, bits: bool, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, code = TaskContext.get().partitionId(), encoder(path)
        schema = pa.schema([
            ("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
            ("planes", pa.list_(pa.binary())),
            ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])))])
        held, docs, first, chunk, total = bytearray(), [], 0, 0, 0

        def row(n: int) -> pa.RecordBatch:
            nonlocal first, chunk, docs
            ids = np.frombuffer(bytes(held[:4 * n]), "<u4")
            del held[:4 * n]
            out = pa.RecordBatch.from_pylist([{
                "shard": shard, "chunk": chunk, "first": first, "n_ids": n, "planes": to_planes(ids, bits),
                "docs": [d for d in docs if d["start"] < first + n]}], schema)
            first, chunk = first + n, chunk + 1
            docs = [d for d in docs if d["start"] + d["n_tokens"] > first]
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = code.encode(text or "")
                    held += ids
                    held += end
                    n = len(ids) // 4 + 1
                    docs.append({"doc_id": doc, "start": total, "n_tokens": n})
                    total += n
                    while len(held) >= 4 * block:
                        yield row(block)
        if held:
            yield row(len(held) // 4)
    return run


def write_tokens(documents: DataFrame, path: str, tokenizer: str, block: int = BLOCK, bits: bool = False,
                 end_id: int = END_ID) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending doc_id order.

    A null text has the end id alone; null doc_ids come first; rows with the same
    doc_id are written one after the other, by text. Other columns are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    docs.mapInArrow(_write_shard(tokenizer, block, bits, end_id), BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    blocks = _blocks(spark, path)
    base = _bases(blocks)
    (blocks.join(F.broadcast(base), "shard").select(
        "shard", "chunk", (F.col("base") + F.col("first")).alias("id_from"),
        (F.col("base") + F.col("first") + F.col("n_ids")).alias("id_to"),
        F.element_at("docs", 1)["doc_id"].alias("doc_from"), F.element_at("docs", -1)["doc_id"].alias("doc_to"),
        F.transform("planes", lambda p: F.octet_length(p)).alias("plane_bytes"))
     .write.parquet(f"{path}/index"))


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")


def _bases(blocks: DataFrame) -> DataFrame:
    """shard, base: ids of all shards before it (a row per shard, as many as write tasks)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def _read_chunks(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "n_tokens", "chunk", "n_ids", "crc", "ids"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for r in range(batch.num_rows):
                x = batch.slice(r, 1).to_pylist()[0]
                ids, first, out = from_planes(x["planes"], x["n_ids"]), x["first"], []
                for d in x["docs"]:
                    a, b = max(d["start"], first), min(d["start"] + d["n_tokens"], first + x["n_ids"])
                    raw = ids[a - first:b - first].tobytes()
                    out.append((d["doc_id"], x["base"] + d["start"], d["n_tokens"], x["chunk"], b - a,
                                zlib.crc32(raw), raw if with_ids else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    return run


def read_pieces(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The files, decoded: a row for each document and chunk that holds part of it."""
    blocks = _blocks(spark, path)
    return blocks.join(F.broadcast(_bases(blocks)), "shard").mapInArrow(
        _read_chunks(with_ids), "doc_id long, start long, n_tokens long, chunk int, n_ids long, crc long, ids binary")


def join_crc(parts: list[tuple[int, int]]) -> int:
    """crc32 of the concatenation of parts given as (crc32, bytes): crc32 is affine in its state."""
    crc = 0
    for c, n in parts:
        zeros = bytes(n)
        crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ c
    return crc


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    pieces = read_pieces(spark, path)
    whole = pieces.where(F.col("n_ids") == F.col("n_tokens")).select(
        "doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crcs = [join_crc([(p["crc"], 4 * p["n_ids"]) for p in parts]) for parts in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(crcs, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    split = pieces.where(F.col("n_ids") < F.col("n_tokens")).groupBy("start").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("chunk", "n_ids", "crc"))).alias("parts"))
    split = split.select("doc_id", "start", "n_tokens", "parts").mapInArrow(
        fold, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return whole.unionByName(split)


def read_ids(spark: SparkSession, path: str, id_from: int, id_to: int) -> np.ndarray:
    """Ids id_from..id_to of the whole output: the chunk index names the blocks to open."""
    hit = spark.read.parquet(f"{path}/index").where((F.col("id_to") > id_from) & (F.col("id_from") < id_to))
    rows = _blocks(spark, path).select("shard", "chunk", "n_ids", "planes").join(
        hit.select("shard", "chunk", "id_from"), ["shard", "chunk"]).orderBy("id_from").collect()
    parts = []
    for r in rows:
        ids = from_planes([bytes(p) for p in r["planes"]], r["n_ids"])
        parts.append(ids[max(0, id_from - r["id_from"]):id_to - r["id_from"]])
    return np.concatenate(parts) if parts else np.zeros(0, "<u4")


def token_files(documents: DataFrame, vocabulary: str = "word_bpe_49k.json", bits: bool = False) -> DataFrame:
    """Write the documents' ids to a new folder and read every document back from it."""
    spark = documents.sparkSession
    path = scratch(spark, "token_output")
    write_tokens(documents, path, public_tokenizers.path(vocabulary), bits=bits)
    return read_documents(spark, path)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"))
