"""N-gram Jaccard join by multiple-global-order filtering.

If two sets reach Jaccard similarity t, then under *any* global order of the tokens
(word shingles) they share K tokens within their first n - ceil(t n) + K tokens. The
filter is applied under several orders:

1. by token hash, with K = n / 16: only these prefixes (21 % of the tokens at t = 0.85)
   are shuffled;
2. by document count, rare first, among the tokens of the prefixes of 1.: the K shared
   tokens have a rarest one, so the t K - 1 most frequent tokens of a prefix need not be
   looked up. A document without a shared token left is out; a passage that very many
   documents share is not looked up unless most of a document consists of such;
3. by document count, rare first, over the whole sets of the documents left, with K = 1: a
   document with enough rarer tokens is never looked up by a passage of many documents,
   even one that makes up most of it;
4. by ascending and by descending token hash, with K = 1, pair by pair, before verification.
   The pairs left after the pivots must also be near in a parity sketch of the whole
   sets, an exact bound on the similarity.

A candidate pair has to pass all of them.

Equal sets are one class from the start. Candidates that share a rare-first prefix
token form a group; a group is not expanded into all pairs. All members are verified
against one pivot, linked documents become one component, and what remains are the
pairs of a group that lie in different components: members outside the group's largest
component against members of other components. The first token two sets share under order 3
also bounds their overlap by what follows it in either set, so a member has a largest
partner size in each group, and meets the members of the sizes between only: documents that
share a passage but not enough of it are told apart before a pair is made. So every
candidate pair is verified, already connected or too far apart, and the components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import LAST_ID, WHITE_SPACE, mix64, read_table, scratch, slices, stored, text_buffers, text_key, words_of
from tidemart.llm.components import components

PIVOT_ROUNDS = 1
SHARE = 16


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes (signed) of each text's word shingles."""
    _, _, h, text, _ = words_of(data, offsets, WHITE_SPACE)
    first = np.searchsorted(text, np.arange(len(offsets)))
    n = len(h) - words + 1
    mixed = np.zeros(max(0, n), np.uint64)
    for i in range(words):
        mixed = mix64(mixed * np.uint64(0x9E3779B97F4A7C15) + h[i:i + len(mixed)])
    mixed = mixed.view(np.int64)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            part = np.sort(mixed[a:b - words + 1])
            yield part[np.concatenate([[True], part[1:] != part[:-1]])]
        elif b > a:  # fewer words: the whole sequence is one shingle, marked by its length
            x = np.uint64(b - a)
            for w in h[a:b]:
                x = mix64(np.array([x * np.uint64(3) + w]))[0]
            yield np.array([x]).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def sample_length(n: int, num: int, den: int) -> int:
    """Prefix in which two sets that reach the similarity share n / 16 tokens at least."""
    return n - -(-num * n // den) + -(-n // SHARE) if n else 0


def _sets(words: int, num: int, den: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                data, offsets = text_buffers(b.column(1))
                for i, j in slices(offsets):
                    sets = list(shingle_sets(data, offsets[i:j + 1], words))
                    n = np.array([len(s) for s in sets], np.int64)
                    kept = sets if whole else [s[:sample_length(len(s), num, den)] for s in sets]
                    ends = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
                    tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept) if kept else n))
                    # 128 bits over the whole set tell equal sets
                    keys = []
                    for s in sets:
                        u = s.view(np.uint64)
                        keys.append(np.array([mix64(u).sum(dtype=np.uint64), mix64(u ^ np.uint64(0x5bd1e995)).sum(dtype=np.uint64)]).tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i, j - i), b.column(2).slice(i, j - i), pa.array(n), pa.array(keys, pa.binary()), tokens,
                         pa.array([parity_sketch(s) for s in sets] if whole else [None] * len(sets), pa.list_(pa.int64()))],
                        names=["doc", "own", "n", "key", "tokens", "sketch"])
    return run


SET_SCHEMA = "doc long, own long, n long, key binary, tokens array<long>, sketch array<long>"
SKETCH = 512


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """For each of 512 bins of the hash, whether it holds an odd number of tokens.

    Two sketches differ in no more bins than the sets differ in tokens, which bounds
    their similarity from above.
    """
    odd = np.bincount((tokens.view(np.uint64) >> np.uint64(55)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _close(a: Column, b: Column, num: int, den: int) -> Column:
    """Sizes that can reach the similarity."""
    return (F.least(a, b) * den >= F.greatest(a, b) * num)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose sets reach the similarity; orders 1 and 3 are tested first."""
    left = sets.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))

    def ahead(n: str) -> Column:  # prefix length with K = 1
        return (F.col(n) - F.ceil(F.col(n) * num / F.lit(den)) + 1).cast("int")

    both = pairs.join(left, "a").join(right, "b").where(_close(F.col("na"), F.col("nb"), num, den))
    for edge in (lambda t, n: F.slice(t, F.lit(1), ahead(n)), lambda t, n: F.slice(t, -ahead(n), ahead(n))):
        both = both.where(F.arrays_overlap(edge("ta", "na"), edge("tb", "nb")))
    common = F.size(F.array_intersect("ta", "tb"))
    return both.where(den * common >= num * (F.col("na") + F.col("nb") - common)).select("a", "b")


def jaccard_components(documents: DataFrame, words: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Two documents link when den * |intersection| >= num * |union| of their sets of
    ``words``-word shingles (A-Z lower-cased, ASCII white space between words; fewer
    words are one shingle). ``component_id`` is the smallest doc_id reachable by
    links. Null and empty texts have no shingles and link with nothing, not even each
    other. Rows with the same doc_id are one node (linked with what any of them links
    with). Rows with a null doc_id are nodes by their own texts, after all ids; a
    component of such rows only is a null component. Other columns are ignored.
    """
    null_last = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return _labelled_rows(documents, words, num, den).select(
        null_last("doc").alias("doc_id"), F.col("n").alias("n_shingles"), null_last("least").alias("component_id"))


def first_of_components(documents: DataFrame, words: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, text_key, single: the documents that stand for their component of ``jaccard_components``.

    These are the smallest doc_id of a component, and of a component of rows without an id
    one text, named by ``text_key`` (``single``: one row of it is enough). Texts without
    words stand for themselves.
    """
    rows = stored(_labelled_rows(documents, words, num, den), f"{scratch(documents.sparkSession, 'jaccard_join')}/first")
    named = rows.where("own IS NULL AND least = doc").select(F.col("doc").alias("doc_id"), "own", F.lit(False).alias("single"))
    unnamed = rows.where((F.col("least") == LAST_ID) & F.col("own").isNotNull())
    one = unnamed.where("n > 0").groupBy("label").agg(F.min("own").alias("own")).select(
        F.lit(None).cast("long").alias("doc_id"), "own", F.lit(True).alias("single"))
    empty = unnamed.where("n = 0").select(F.lit(None).cast("long").alias("doc_id"), "own", F.lit(False).alias("single"))
    return named.unionByName(one).unionByName(empty).withColumnRenamed("own", "text_key").distinct()


def _labelled_rows(documents: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """doc (null: LAST_ID), own (the text key of a row without an id), n, label, least per input row."""
    spark = documents.sparkSession
    path = scratch(spark, "jaccard_join")
    docs = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
                            F.col("text").cast("string").alias("text"),
                            text_key(F.col("doc_id").cast("long"), F.col("text")).alias("own"))
    first = stored(docs.mapInArrow(_sets(words, num, den, False), SET_SCHEMA).drop("sketch"), f"{path}/prefixes")
    # equal sets are one class, named by its smallest document
    classes = stored(first.where("n > 0").groupBy("key").agg(F.min("doc").alias("rep"), F.min("own").alias("own")).withColumn(
        "own", F.when(F.col("rep") == LAST_ID, F.col("own"))), f"{path}/classes")
    # order 1: token hash. Classes are numbered by a hash of their key
    sample = first.where("n > 0").join(classes.select("key", F.col("rep").alias("doc")), ["key", "doc"]).select(
        F.xxhash64("key").alias("doc"), "n", F.size("tokens").alias("m"), F.explode("tokens").alias("token"))
    # order 2: document count within these prefixes, rare first
    often = sample.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    common = sample.join(often, "token").groupBy("doc", "n", "m").agg(
        F.sort_array(F.collect_set(F.struct("df", "token"))).alias("t"))
    skip = F.ceil(F.col("n") * num / F.lit(den * SHARE)) - 1
    looked = stored(common.withColumn("look", (F.size("t") - skip).cast("int")).where("look > 0").select(
        "doc", F.explode(F.slice("t", F.lit(1), F.col("look"))["token"]).alias("token")), f"{path}/looked")
    # whole sets of the classes that share a token there
    wanted = looked.join(_shared(looked), "token").select("doc").distinct().join(
        classes.select(F.xxhash64("key").alias("doc"), "key", "rep", "own"), "doc").select("key", "rep", F.col("own").alias("rep_own"))
    full = docs.join(wanted.select("rep", "rep_own").distinct(), (F.col("doc") == F.col("rep")) & F.col("own").eqNullSafe(
        F.col("rep_own")), "left_semi").mapInArrow(
        _sets(words, num, den, True), SET_SCHEMA)
    sets = stored(full.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]).select(
        F.xxhash64("key").alias("doc"), "n", "tokens", "sketch"), f"{path}/sets")
    # order 3: document count over whole sets, rare first
    token = sets.select("doc", "n", F.explode("tokens").alias("token"))
    often = token.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    common = token.join(often, "token").groupBy("doc", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
    alone = F.col("n") - F.size("t")  # tokens of no other document come first and need no look-up
    look = (F.col("n") - F.ceil(F.col("n") * num / F.lit(den)) + 1 - alone).cast("int")
    prefix = stored(common.withColumn("alone", alone).withColumn("look", look).where("look > 0").select(
        "doc", "n", "alone", F.posexplode(F.slice("t", F.lit(1), F.col("look"))["token"]).alias("place", "token")).select(
        "doc", "n", "alone", "token", _largest_partner(F.col("n"), F.col("alone") + F.col("place"), num, den).alias("most")),
        f"{path}/prefix")
    groups = stored(prefix.join(_shared(prefix), "token"), f"{path}/groups")
    # links within groups: pivots first
    links, tried, label = None, None, None
    for r in range(PIVOT_ROUNDS):
        rows = groups if label is None else _labelled(groups, label)
        if label is None:
            pivot = rows.groupBy("token").agg(F.min(F.struct("alone", "doc", "n")).alias("p"))
            open_rows = rows.join(pivot, "token").where(F.col("doc") != F.col("p.doc"))
        else:  # a pivot outside the group's largest component, against all others
            small = _outside(rows, path, r)
            pivot = small.groupBy("token").agg(F.min(F.struct("alone", "doc", "n", "label")).alias("p"))
            open_rows = rows.join(pivot, "token").where(F.col("label") != F.col("p.label"))
        pairs = open_rows.where(_close(F.col("n"), F.col("p.n"), num, den)).select(
            F.least("doc", "p.doc").alias("a"), F.greatest("doc", "p.doc").alias("b")).distinct()
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, f"{path}/pairs-{r}")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = stored(_verified(pairs, sets, num, den), f"{path}/found-{r}")
        links = found if links is None else links.unionByName(found)
        label = components(links, f"{path}/components-{r}")
    # the rest: members outside their group's largest component against members of others, by size
    rows = _labelled(groups, label).withColumn("band", _band(F.col("n")))
    small = _outside(rows, path, "rest")
    bands = rows.groupBy("token", "band").agg(F.min("n").alias("shortest"), F.max("most").alias("reach"))
    top = F.least(F.col("most"), F.floor(F.col("n") * den / F.lit(num)))
    low = F.ceil(F.col("n") * num / F.lit(den))
    small = small.where(low <= top).select(
        "token", F.col("doc").alias("d2"), F.col("n").alias("n2"), F.col("most").alias("most2"), F.col("label").alias("l2"),
        F.explode(F.sequence(_band(low), _band(top))).alias("band"))
    small = stored(small.join(bands, ["token", "band"]).where("shortest <= most2 AND n2 <= reach").drop("shortest", "reach"),
                   f"{path}/probes")
    rows = rows.join(small.select("token", "band").distinct(), ["token", "band"], "left_semi")
    sketch = sets.select("doc", "sketch")
    rows = rows.join(sketch, "doc")
    small = small.join(sketch.select(F.col("doc").alias("d2"), F.col("sketch").alias("s2")), "d2")
    apart = sum((F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("s2", F.lit(i)))) for i in range(SKETCH // 64)), F.lit(0))
    rest = rows.join(small, ["token", "band"]).where((F.col("label") != F.col("l2")) & (F.col("n") <= F.col("most2")) & (
        F.col("n2") <= F.col("most"))).where(
        _close(F.col("n"), F.col("n2"), num, den) & ((den + num) * apart <= (den - num) * (F.col("n") + F.col("n2")))).select(
        F.least("doc", "d2").alias("a"), F.greatest("doc", "d2").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(stored(_verified(stored(rest, f"{path}/pairs-rest"), sets, num, den), f"{path}/found-rest"))
    # classes and rows with the same doc_id are joined in one graph of class numbers and documents
    return _result(first, links, path)


def _largest_partner(n: Column, place: Column, num: int, den: int) -> Column:
    """Size up to which a set can reach the similarity if the first shared token is number ``place`` (from 0) of ``n``:
    the overlap is n - place at most."""
    return (F.floor((n - place) * (den + num) / F.lit(num)) - n).cast("long")


def _band(n: Column) -> Column:
    """Sizes in bands: each size up to 128 by itself, then steps of 1/128, so that at most 45 bands can reach 0.85."""
    return F.when(n <= 128, n).otherwise(128 + F.floor(F.log(n / F.lit(128)) * 128)).cast("int")


def _shared(rows: DataFrame) -> DataFrame:
    """Tokens of several rows."""
    return rows.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")


def _labelled(groups: DataFrame, label: DataFrame) -> DataFrame:
    """Groups with the component of each member (itself if it has no link)."""
    return groups.join(label.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "label", F.coalesce("label", "doc"))


def _outside(rows: DataFrame, path: str, turn) -> DataFrame:
    """Members of groups with several components that are outside the group's largest one."""
    sizes = rows.groupBy("token", "label").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("c", "label")).alias("m"), F.count("*").alias("k")).where(
        "k > 1").select("token", F.col("m.label").alias("top"))
    return stored(rows.join(largest, "token").where(F.col("label") != F.col("top")).drop("top"), f"{path}/outside-{turn}")


def _result(first: DataFrame, links: DataFrame, path: str) -> DataFrame:
    # components of classes, by class number
    label = components(links, f"{path}/components-all").withColumnRenamed("node", "number")
    rows = first.select("doc", "own", "n", F.when(F.col("n") > 0, F.xxhash64("key")).alias("number")).join(
        label, "number", "left").withColumn("label", F.coalesce("label", "number"))
    rows = stored(rows, f"{path}/rows")
    least = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc").alias("least"))
    rows = rows.join(least, "label", "left").withColumn("least", F.coalesce("least", "doc"))
    # documents with several rows of different text tie their components together; rows without an id do not
    torn = stored(rows.where("own IS NULL").groupBy("doc").agg(F.min("least").alias("a"), F.max("least").alias("b")).where(
        "a <> b").select("doc", "a"), f"{path}/torn")
    if torn.limit(1).count():
        ties = rows.where("own IS NULL").join(torn, "doc").where("least <> a").select("a", F.col("least").alias("b")).distinct()
        tie = components(ties, f"{path}/components-ties").select(F.col("node").alias("least"), F.col("label").alias("tied"))
        rows = rows.join(tie, "least", "left").withColumn("least", F.coalesce("tied", "least"))
    return rows.select("doc", "own", "n", "label", "least")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w)::BIGINT - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
  FROM word),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN size USING (doc_id) GROUP BY doc_id
"""
