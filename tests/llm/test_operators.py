"""Operators on awkward small tables, against brute-force versions."""
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import llm_helpers as H
from tidemart.llm import decontaminate, jaccard_join, licenses, line_dedup, mixing, suffix_dedup, token_counts, token_output, topk, toxicity
from tidemart.llm.components import components

SF = "/root/testdata/sf0.001"
ROWS = H.edge_rows()
UNIQUE = [r for r in ROWS if r[0] is not None and r[0] != 15]


@pytest.fixture(scope="module")
def docs(spark):
    return H.frame(spark, ROWS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return H.frame(spark, ROWS).where("false")


def table(df, *keys):
    return Counter(tuple(r[k] for k in keys) for r in df.collect())


# -- line dedup ---------------------------------------------------------------------------

def plain_lines(rows):
    order = lambda d: float("inf") if d is None else d
    key = lambda s: s.strip(H.WHITE).translate(H.LOWER)
    first = {}
    for d, t, *_ in rows:
        for s in (t or "").split("\n"):
            first[key(s)] = min(first.get(key(s), float("inf")), order(d))
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [s for s in lines if len(key(s)) < 10 or first[key(s)] == order(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("batches,fanout", [(1, 3), (4, 2), (6, 2)])
def test_line_dedup(docs, batches, fanout):
    got = line_dedup.dedup_lines(docs, batches=batches, fanout=fanout)
    assert table(got, "doc_id", "n_lines", "n_dropped", "text") == plain_lines(ROWS)


def test_line_runs_are_merged_by_level_and_need_no_exchange(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path), buckets=4, fanout=2)
    for i in range(5):
        keys = spark.range(10 * i, 10 * i + 15).select(F.col("id").cast("string").cast("binary").alias("key"), F.lit(1).alias("_doc"))
        runs.add(runs.unseen(keys))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sum(spark.table(r).count() for r in runs.runs()) == 55
    keys = spark.range(3).select(F.col("id").cast("string").cast("binary").alias("key"))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        plan = runs.unseen(keys.groupBy("key").count()).hint("merge")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert plan.count("Exchange hashpartitioning") == 1  # the batch's own aggregation


# -- mixing -------------------------------------------------------------------------------

def test_mixing_targets_and_repeats(docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS)
    size = Counter()
    for d, t, s in [(r[0], r[1], r[2]) for r in ROWS]:
        size[s] += len(H.words(t))
    total = sum(size.values())
    cap, w, share, free = {}, {}, {}, set(size)
    for i, s in enumerate(sorted(size, key=lambda s: (s is None, (s or "").encode()))):
        w[s], cap[s] = (5, 2, 1)[i % 3], 3 * size[s]
    while True:  # reshare the excess until no source is above its cap
        left = total - sum(cap[s] for s in set(size) - free)
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if share[s] > cap[s]}
        if not above:
            break
        free -= above
    taken = Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]]
        assert r["target"] == pytest.approx(share.get(r["source"], cap[r["source"]]))
        assert 0 <= r["repeats"] <= 3 and r["taken"] == r["repeats"] * r["size"]
        taken[r["source"]] += r["taken"]
    longest = max(r["size"] for r in got)
    assert total - longest <= sum(taken.values()) <= total
    for s in size:
        assert abs(taken[s] - share.get(s, cap[s])) <= 2 * longest
    again = mixing.mix(docs.repartition(3))
    assert table(again, "doc_id", "size", "taken") == Counter((r["doc_id"], r["size"], r["taken"]) for r in got)


# -- token files --------------------------------------------------------------------------

def plain_ids(rows):
    code = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for d, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*code.encode(t or "", add_special_tokens=False).ids, 1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("bits,block", [(False, 1 << 16), (True, 100), (False, 64)])
def test_token_files(spark, docs, tmp_path, bits, block):
    path = str(tmp_path / "out")
    token_output.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"), block=block, bits=bits)
    want = plain_ids(ROWS)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_output.read_documents(spark, path).collect())
    assert got == sorted((s, d, n, c) for d, s, n, c, _ in want)
    flat = [i for *_, ids in want for i in ids]
    assert token_output.read_ids(spark, path, 0, len(flat)).tolist() == flat
    assert token_output.read_ids(spark, path, 90, 260).tolist() == flat[90:260]


# -- Jaccard join and components ----------------------------------------------------------

def test_components_of_chains_stars_and_rings(spark, tmp_path):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    random.Random(1).shuffle(links)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long"), str(tmp_path)).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, **{i: 200 for i in (200, 201, 202)}}


def test_jaccard_edge_rows(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect()
           if r["doc_id"] is not None}
    want = H.components([r for r in ROWS if r[0] is not None], 4, 85, 100)
    assert got == want
    nulls = table(jaccard_join.jaccard_components(docs).where("doc_id IS NULL"), "component_id")
    assert nulls == Counter({(None,): 2})


@pytest.mark.parametrize("seed,words,num,den", [(1, 4, 85, 100), (2, 5, 80, 100), (3, 2, 50, 100)])
def test_jaccard_near_copies_equal_all_pairs(spark, seed, words, num, den):
    """Families of edited copies around the threshold, with shared passages and chains."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    rows = []
    for fam in range(8):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(3, 90))]
        for _ in range(rnd.randint(2, 14)):
            text = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 6])):
                text[rnd.randrange(len(text))] = rnd.choice(vocab + [f"u{rnd.random()}"])
            if rnd.random() < 0.3:
                text = passage + text
            if rnd.random() < 0.3:
                base = text  # a chain: the next copies start from this one
            rows.append((len(rows) * 7 % 997, " ".join(text).upper() if rnd.random() < 0.1 else " ".join(text)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard_join.jaccard_components(H.frame(spark, rows), words, num, den).collect()}
    assert got == H.components(rows, words, num, den)


# -- top-k --------------------------------------------------------------------------------

def plain_topk(rows, k=20, every=20):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    grid = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in ok]
    out = Counter()
    for q, x in grid:
        if q % every:
            continue
        best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in grid if i != q)[:k]
        out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    return out


@pytest.mark.parametrize("shard_rows,block", [(100000, 2048), (40, 3)])
def test_topk_with_nulls_ties_and_copies(spark, shard_rows, block):
    rnd = random.Random(6)
    rows = [(i, [rnd.choice([-1.5, 0.0, 0.25, 1.0]) for _ in range(4)]) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(300, 420)]  # one very common vector
    rows += [(None, [1.0] * 4), (500, None), (520, [1.0, None, 1.0, 1.0]), (540, [float("nan")] * 4), (560, [float("inf")] * 4),
             (580, [1.0, 2.0]), (600, []), (620, [3e30, -3e30, 1.0, 0.0]), (0, rows[0][1])]
    small = rows[:-2] + rows[-1:]
    for part in (small, rows):
        df = spark.createDataFrame([(i, v, 1, "x") for i, v in part], "vec_id long, embedding array<float>, rank int, score string")
        got = table(topk.top_k(df, F.col("vec_id") % 20 == 0, shard_rows=shard_rows, block_queries=block),
                    "query_id", "rank", "vec_id", "score")
        want = plain_topk(part)
        if part is rows:  # scores outside 64 bits saturate
            want = Counter({(q, r, i, max(-2 ** 63 + 1, min(2 ** 63 - 1, s))): n for (q, r, i, s), n in want.items()})
            got, want = ({(q, r, s) for q, r, _, s in x} for x in (got, want))
        assert got == want


# -- suffix dedup -------------------------------------------------------------------------

def plain_repeats(rows, length):
    texts = [(t or "").encode() for _, t, *_ in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = Counter()
    for (d, *_), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out[(d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


REPEAT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize("length", [16, 40, 400])
def test_suffix_dedup_edge_rows(docs, length):
    assert table(suffix_dedup.remove_repeats(docs, length), *REPEAT) == plain_repeats(ROWS, length)


@pytest.mark.parametrize("seed,length", [(1, 16), (2, 33), (3, 64), (4, 20)])
def test_suffix_dedup_random_passages(spark, seed, length):
    """Passages pasted with edits near their ends, periodic runs, copies, one alphabet of few letters."""
    rnd = random.Random(seed)
    junk = lambda n: "".join(rnd.choice("abé") for _ in range(n))
    passages = [junk(rnd.randint(length - 2, 4 * length)) for _ in range(6)] + ["ab" * length, "a" * (2 * length)]
    rows = []
    for d in range(60):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            a = rnd.randint(0, 20)
            p = p[a:len(p) - rnd.randint(0, 20)]
            if rnd.random() < 0.4 and p:
                i = rnd.randrange(len(p))
                p = p[:i] + rnd.choice("xyz") + p[i + 1:]
            parts += [junk(rnd.randint(0, 30)), p]
        rows.append((d, "".join(parts)))
    rows += [(100 + i, rows[3][1]) for i in range(3)]
    assert table(suffix_dedup.remove_repeats(H.frame(spark, rows), length), *REPEAT) == plain_repeats(rows, length)


def test_suffix_dedup_passages_of_over_50_words(spark):
    """51 words in three documents each: gone from 400 bytes on, untouched below; ``n_bytes`` is the length before."""
    rnd = random.Random(7)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    filler = lambda: " ".join(word(5) for _ in range(100))
    rows, want = [(0, filler())], {0: 0}
    for size in (300, 399, 400, 401, 460):
        passage = f" {' '.join(word(4) for _ in range(50))} {word(size - 252)} "
        assert len(passage) == size and len(passage.split()) == 51
        for mark in "123":
            want[len(rows)] = size if size >= 400 else 0
            rows.append((len(rows), f"{filler()}{mark}{passage}{mark}{filler()}"))
    out = suffix_dedup.remove_repeats(H.frame(spark, rows)).collect()
    assert {r["doc_id"]: r["n_removed"] for r in out} == want
    assert {r["doc_id"]: r["n_bytes"] for r in out} == {d: len(t) for d, t in rows}
    assert Counter(tuple(r[k] for k in REPEAT) for r in out) == plain_repeats(rows, 400)


# -- token counts -------------------------------------------------------------------------

def test_token_counts_of_redacted_documents(spark, docs):
    code = token_counts.counter("byte_bpe_50k.tiktoken")
    extra = [(50, "mail a.b@c.de now 10.20.30.40 call (555) 123-4567 4111111111111111 password=abc"), (51, "x@y.zz"), (51, "x@y.zz")]
    everything = H.frame(spark, ROWS + extra)
    got = token_counts.update_counts(token_counts.token_trees(everything), token_counts.redactions(everything)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, *_ in ROWS + extra)
    want = Counter()
    for d, t, *_ in ROWS + extra:
        new = t or ""
        for pattern, name in token_counts.REDACT:
            new = __import__("re").sub(pattern, name, new)
        want[(d, code.one(t or ""), code.one(new))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_tokens_after"]) for r in got) == want
    assert {r["doc_id"]: r["n_edits"] for r in got}[50] == 5


def test_jaccard_rows_without_an_id_are_nodes_of_their_own(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(5, text("a")), (9, text("b")), (None, text("a")), (None, text("b") + " tail"), (None, text("c")),
            (None, text("c")), (None, text("d")), (None, None)]
    got = table(jaccard_join.jaccard_components(H.frame(spark, rows).repartition(3)), "doc_id", "n_shingles", "component_id")
    assert got == Counter([(5, 37, 5), (9, 37, 9), (None, 37, 5), (None, 38, 9), (None, 37, None), (None, 37, None),
                           (None, 37, None), (None, 0, None)])


def test_jaccard_ties_all_components_of_a_repeated_id(spark):
    text = lambda k: " ".join(f"{k}{i}" for i in range(40))
    rows = [(2, text("a")), (5, text("b")), (9, text("c")), (20, text("a")), (20, text("b")), (20, text("c")), (20, text("d")),
            (20, None), (30, text("d")), (31, text("e")), (31, text("f")), (40, text("f"))]
    got = table(jaccard_join.jaccard_components(H.frame(spark, rows).repartition(3)), "doc_id", "component_id")
    assert got == Counter((d, 31 if d in (31, 40) else 2) for d, _ in rows)


# -- decontamination ----------------------------------------------------------------------

def plain_contaminated(rows, items, words, similarity):
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    sh = lambda w: [tuple(w[i:i + min(words, len(w))]) for i in range(len(w) - min(words, len(w)) + 1)]
    out = {}
    for d, t, *_ in rows:
        w = H.words(t, pattern)
        for i, item in items:
            x = H.words(item, pattern)
            if d is None or not x or not w:
                continue
            n = len(x)
            best = max(H.weighted_jaccard(sh(w[max(0, s):s + n]), sh(x)) for s in range(-n + 1, len(w)))
            if best >= similarity:
                out[(d, i)] = best
    return out


def test_decontamination_finds_planted_items(spark):
    rnd = random.Random(9)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i, n in enumerate([3, 5, 8, 15, 22, 37, 59, 80])]
    items += [(20, None), (21, ""), (22, "...")]
    rows = [(d, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(0, 200)))) for d in range(40)]
    for d in range(100, 180):
        i, item = rnd.choice(items[1:8])
        x = item.split()
        if rnd.random() < 0.4 and len(x) > 30:
            x[rnd.choice([0, 1, -1, len(x) // 2])] = "changed"
        cover = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        at = rnd.randint(0, len(cover))
        glue = rnd.choice([" ", ", ", "\n"])
        rows.append((d, glue.join(cover[:at] + x + cover[at:]).upper()))
    rows += [(None, items[5][1]), (200, None), (201, ""), (202, items[6][1]), (202, "other"), (203, " ".join(items[7][1].split()[:70]))]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(H.frame(spark, rows), bench).collect()}
    want = plain_contaminated(rows, items, 5, 0.8)
    assert set(got) <= set(want)
    exact = {k for k, s in want.items() if s == 1.0}
    assert exact <= set(got)
    assert len(got) >= 0.95 * len(want)
    assert all(got[k] <= want[k] + 1e-9 for k in got)
    chunked = decontaminate.contaminated(H.frame(spark, rows), bench, chunk=3)
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in chunked.collect()} == got


def test_decontamination_finds_altered_items_of_every_length(spark):
    """Changed, lost and added words in items of each length of the benchmark tables; every passage of 0.8 or more is found."""
    rnd = random.Random(31)
    vocab = [f"w{i}" for i in range(2000)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(n, " ".join(text(n))) for n in range(13, 60)]
    rows, pairs = [], []
    for i, item in items:
        for k in range(8):
            x = item.split()
            for _ in range(rnd.randint(1, 3)):
                at = rnd.choice([0, 1, 2, -1, -2, -3, rnd.randrange(len(x))])
                x[at:len(x) if at == -1 else at + 1] = rnd.choice([["other"], ["other"], [], [x[at], "more"]])
            d = len(rows)
            rows.append((d, " ".join(text(rnd.choice([0, 20])) + x + text(rnd.choice([0, 20])))))
            pairs.append((d, i, item))
    want = {}
    for d, i, item in pairs:
        want.update(plain_contaminated([rows[d]], [(i, item)], 5, 0.8))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(H.frame(spark, rows), bench).collect()}
    assert len(want) > 100 and {i for _, i in want} == {i for i, _ in items}
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}


# -- licences -----------------------------------------------------------------------------

def test_license_scan(spark):
    texts = [None, "", "Licensed under the Apache License, Version 2.0.", "under the MIT license under the mit LICENSE!",
             "CC BY-NC 4.0", "Licensed under CC BY-NC 4.0", "cc by", "GNU General Public License, version 3",
             "Permission is hereby granted, free of charge; the software is provided as is", "é under the mit license é",
             "Permission is hereby granted, free of charge"]
    got = [tuple(r)[1:] for r in sorted(licenses.scan_licenses(H.frame(spark, list(enumerate(texts)))).collect())]
    assert got[0] == got[1] == (0, 0, None, None, "", "", 0.0)
    assert got[2] == (8, 1, 3, 3, "apache-2", "apache-2", 1.0)
    assert got[3] == (8, 2, 0, 4, "mit", "mit", 1.0)
    assert got[4][1:6] == (1, 0, 0, "cc-by-nc", "cc-by-nc")
    assert got[5][4:] == ("cc-by-nc", "cc-by-nc", 1.0)
    assert got[6][1:] == (0, None, None, "", "", 0.0)
    assert got[7][4:] == ("", "gpl-3", 1.0)
    assert got[8][4:] == ("", "mit", 1.0)
    assert got[9] == (6, 1, 1, 1, "mit", "mit", 1.0)
    assert got[10][4:] == ("", "", 0.5)


# -- toxicity -----------------------------------------------------------------------------

def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = toxicity.op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    right = sum(r["predicted"] == r["toxic"] for r in got)
    assert right / len(got) >= 0.95
    for r in got:
        assert zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0


def test_toxicity_awkward_rows(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (3, None, "x"), (None, 1, "x"), (4, 7, "x")], "doc_id long, toxic int, text string")
    machine = toxicity.learn(docs, labels)
    got = toxicity.score_toxicity(docs, machine).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.learn(docs, labels.where("false"))
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, none).collect()} == {0}
    assert toxicity.score_toxicity(empty, machine).count() == 0


def test_empty_tables(spark, empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert token_output.token_files(empty).count() == 0
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert licenses.scan_licenses(empty).count() == 0
    assert token_counts.update_counts(token_counts.token_trees(empty), token_counts.redactions(empty)).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(empty, bench).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(vectors, F.col("vec_id") % 20 == 0).count() == 0
