"""Fill-in-the-middle transformation of whole texts.

A text is cut into units (a word with the white space before it, or white space at
the end). One ``fullmatch`` of ``(unit)*`` keeps every repetition of its group, so
``match.ends(1)`` has the end of each unit: its length is n, and both cut offsets are
entries of it. A text longer than ``PIECE`` code points is matched in pieces that end
behind a word and before white space, where a unit ends in any case, so that memory
follows the piece. Only the match runs in Python, as an Arrow function from the text
to (n, cut, cut); hashing, forms and strings are Spark expressions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemart.llm.common import prepare_workers, read_table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PIECE = 1 << 18
UNITS = regex.compile(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)*")
_WORD_END = regex.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")


def unit_ends(text: str, piece: int = PIECE) -> list[int] | np.ndarray:
    """End of every unit of the text, in code points."""
    if len(text) <= piece:
        return UNITS.fullmatch(text).ends(1)
    parts, at = [], 0
    while at < len(text):
        end = _WORD_END.search(text, at + piece - 1)
        end = end.end() if end else len(text)
        parts.append(np.array(UNITS.fullmatch(text, at, end).ends(1), np.int64))
        at = end
    return np.concatenate(parts)


def cuts(text: str, h1: int, h2: int, piece: int = PIECE) -> tuple[int, int, int]:
    """Units of the text, and the code points before the end of the prefix and of the middle."""
    ends = unit_ends(text, piece)
    n = len(ends)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, int(ends[low - 1]) if low else 0, int(ends[high - 1]) if high else 0


def _cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    found = [cuts(t.as_py(), a, b) for t, a, b in zip(text, h1.to_pylist(), h2.to_pylist())]
    columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
    return pa.StructArray.from_arrays(columns, names=["n", "low", "high"])


def fill_in_middle(documents: DataFrame, rate: int = 50, spm: int = 80, seed: str = "42",
                   keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n (units), form, prefix_chars, middle_chars (code points) and the output text.

    h1 to h4 are the first 8-digit groups of the hex sha256 of ``seed``:doc_id. The
    prefix ends after the smaller of h1 and h2 modulo n+1 units, the middle after the
    larger. ``rate`` of 100 texts (h3) are transformed, ``spm`` of 100 of them (h4) as
    ``<S>suffix<P>prefix<M>middle``, the others as ``<P>prefix<S>suffix<M>middle``. Empty texts
    and texts that hold one of the three marks stay plain: their output is the text and the
    lengths are null. A null text is empty; a null doc_id counts as an empty string in
    the hash; repeated rows each have their (equal) result. Other columns are ignored.
    """
    prepare_workers(documents.sparkSession)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_doc"), F.lit(""))).cast("binary"), 256)
    group = lambda i: F.conv(F.substring("_hash", 8 * i + 1, 8), 16, 10).cast("long")
    docs = documents.select(
        *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], F.col("doc_id").cast("string").alias("_doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    found = arrow_udf(_cuts, "struct<n:long,low:long,high:long>")
    docs = docs.withColumn("_hash", hashed).withColumn("_cut", found("_text", group(0), group(1)))
    text, low, high = F.col("_text"), F.col("_cut.low").cast("int"), F.col("_cut.high").cast("int")
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = (F.when((text == "") | marked | (group(2) % 100 >= rate), "plain")
            .when(group(3) % 100 < spm, "spm").otherwise("psm"))
    parts = docs.select("*", form.alias("_form"), F.substring(text, F.lit(1), low).alias("_prefix"),
                        F.substring(text, low + 1, high - low).alias("_middle"),
                        F.substring(text, high + 1, F.length(text)).alias("_suffix"))
    psm = F.concat(F.lit(PREFIX), "_prefix", F.lit(SUFFIX), "_suffix", F.lit(MIDDLE), "_middle")
    spm_ = F.concat(F.lit(SUFFIX), "_suffix", F.lit(PREFIX), "_prefix", F.lit(MIDDLE), "_middle")
    cut = F.col("_form") != "plain"
    return parts.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], F.col("_cut.n").alias("n"), F.col("_form").alias("form"),
        F.when(cut, F.col("_cut.low")).alias("prefix_chars"),
        F.when(cut, F.col("_cut.high") - F.col("_cut.low")).alias("middle_chars"),
        F.when(~cut, text).when(F.col("_form") == "psm", psm).otherwise(spm_).alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given, from its output and form alone.

    The text holds no mark, and no mark can begin inside one part and end inside another
    mark, so the first mark of each kind is the one that was put in.
    """
    between = lambda a, b: F.substring(output, a, b - a)
    prefix, suffix, middle = (F.locate(m, output) for m in (PREFIX, SUFFIX, MIDDLE))
    last = F.substring(output, middle + 3, F.length(output))
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(between(F.lit(4), suffix), last, between(suffix + 3, middle)))
            .otherwise(F.concat(between(prefix + 3, middle), last, between(F.lit(4), prefix))))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
g AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (
  SELECT *, coalesce(array_to_string(u[1:lo], ''), '') AS prefix, coalesce(array_to_string(u[lo + 1:hi], ''), '') AS middle,
         coalesce(array_to_string(u[hi + 1:n], ''), '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::DOUBLE END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::DOUBLE END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
