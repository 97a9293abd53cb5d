"""Embedding links, cross-tokenizer alignment and fill-in-the-middle against brute-force versions."""
import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import llm_helpers as H
from tidemart.llm import alignment as A
from tidemart.llm import embedding_dedup as E
from tidemart.llm import fill_middle as M

BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MARKED = [(30, "a <P> b c d"), (31, "x<S>y z"), (32, "only <M>"), (33, "<P"), (34, "S> < <S <P M> <M tail <"), (35, "  lead and trail \n\n "),
          (36, "a　b\x85c d e"), (37, "▁ under ▁▁x"), (38, "<0x41> <s> </s> <unk> <|endoftext|> x"), (39, "漢字かな 😀 " * 30)]
ROWS = H.edge_rows() + MARKED + [(i, f"text number {i} has some words, more or less {i * i}") for i in range(100, 160)]


@pytest.fixture(scope="module")
def docs(spark):
    return H.frame(spark, ROWS).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return H.frame(spark, ROWS).where("false")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- fill in the middle --------------------------------------------------------------------

UNIT = regex.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return doc_id, n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


def test_fill_in_middle(docs):
    out = M.fill_in_middle(docs).withColumn("back", M.restored(F.col("output"), F.col("form")))
    keys = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    rows = out.collect()
    assert Counter(tuple(r[k] for k in keys) for r in rows) == Counter(plain_fim(d, t) for d, t, *_ in ROWS)
    assert Counter((r["doc_id"], r["back"]) for r in rows) == Counter((d, t or "") for d, t, *_ in ROWS)
    assert {r["form"] for r in rows} == {"plain", "spm", "psm"}


def test_fill_in_middle_of_marks_cut_apart(spark):
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice(["<", "P", "S", "M", ">", " ", "<P ", " S>", "é"]) for _ in range(30))) for i in range(300)]
    out = M.fill_in_middle(H.frame(spark, rows), rate=100, spm=50).withColumn("back", M.restored(F.col("output"), F.col("form")))
    got = {r["doc_id"]: r for r in out.collect()}
    assert all(got[d]["back"] == t for d, t in rows)
    assert Counter(r["form"] for r in got.values())["psm"] > 50


def test_fill_in_middle_of_an_empty_table(empty):
    assert M.fill_in_middle(empty).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \n\t\x1cé漢😀")), max_size=80), st.integers(1, 9))
def test_unit_ends_do_not_depend_on_the_piece(text, piece):
    ends = [m.end() for m in UNIT.finditer(text)]
    assert list(M.unit_ends(text)) == ends
    assert list(M.unit_ends(text, piece)) == ends


# -- alignment ------------------------------------------------------------------------------

_PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
_BYTES = Tokenizer.from_file(BYTE_BPE)
_BYTES.encode_special_tokens = True


def plain_alignment(rows):
    alphabet, docs, total = A.byte_alphabet(), [], Counter()
    vocab = {i: bytes(alphabet[c] for c in t) for t, i in _BYTES.get_vocab().items() if t != "<|endoftext|>"}
    for d, t, *_ in rows:
        want = (" " + (t or "")).encode()
        a, b = _BYTES.encode(" " + (t or ""), add_special_tokens=False).ids, _PIECES.encode(t or "")
        as_bytes = lambda i: bytes([int(_PIECES.id_to_piece(i)[3:5], 16)]) if _PIECES.is_byte(i) else _PIECES.id_to_piece(i).replace("▁", " ").encode()
        x, y = [vocab[i] for i in a], [as_bytes(i) for i in b]
        if not t or b"".join(x) != want or b"".join(y) != want:
            docs.append((d, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(v) for v in x]).tolist(), np.cumsum([len(v) for v in y]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        total.update(links)
        docs.append((d, len(a), len(b), links, ";".join(groups)))
    most = Counter()
    for (a, b), n in total.items():
        most[b] = max(most[b], n)
    return [(d, na, nb, len(links), len(links), sum(total[p] == most[p[1]] for p in links), sum(total[p] for p in links), g)
            for d, na, nb, links, g in docs]


SHORT = [r for r in ROWS if len(r[1] or "") < 5000]


@pytest.mark.parametrize("top", [0, 5, 1 << 16])
def test_alignment(spark, top):
    got = A.alignment(H.frame(spark, SHORT).repartition(3), top=top).collect()
    keys = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    want = plain_alignment(SHORT)
    assert Counter(tuple(r[k] for k in keys) + (r["groups_sha256"],) for r in got) == Counter(
        (*w[:-1], sha(w[-1]) if w[1] else "") for w in want)
    assert sum(w[1] == 0 for w in want) >= 4  # null, empty and not restorable texts


def test_alignment_groups_and_parts(spark):
    whole = A.align_documents(H.frame(spark, ROWS), BYTE_BPE, PIECE_BPE, with_groups=True).collect()
    parts = A.align_documents(H.frame(spark, ROWS), BYTE_BPE, PIECE_BPE, piece=40, with_groups=True).collect()
    keys = ("doc_id", "n_a", "n_b", "n_links", "groups_sha256", "groups", "pairs", "counts")
    assert Counter(str([r[k] for k in keys]) for r in whole) == Counter(str([r[k] for k in keys]) for r in parts)
    assert all(r["groups_sha256"] == (sha(r["groups"]) if r["n_a"] else "") for r in whole)
    want = Counter((w[0], w[-1]) for w in plain_alignment(SHORT))
    assert want <= Counter((r["doc_id"], r["groups"]) for r in whole)


def test_alignment_of_an_empty_table(empty):
    assert A.alignment(empty).collect() == []


def test_windows_are_forgotten_and_worked_out_again():
    texts = [t for _, t, *_ in SHORT if t]
    small, large = A.Aligner(BYTE_BPE, PIECE_BPE, most=5), A.Aligner(BYTE_BPE, PIECE_BPE)
    for at in range(0, len(texts), 7):
        x, y = small.align(texts[at:at + 7]), large.align(texts[at:at + 7])
        assert x[:4] == y[:4] and np.array_equal(x[4], y[4]) and np.array_equal(x[5], y[5])


def test_merges_give_the_ids_of_the_tokenizers_library():
    own = A.ByteLevelTokens(BYTE_BPE)
    assert own.fast is not None
    words = [w for w in (b.decode("utf-8", "ignore") for b in own.bytes) if w]
    for texts in (words, [" " + w for w in words], [f"{a}{b}" for a, b in zip(words, words[7:])]):
        fast, slow = own.encode(texts), [e.ids for e in _BYTES.encode_batch(texts, add_special_tokens=False)]
        assert all(x.tolist() == y for x, y in zip(fast, slow))
    long = ["ab" * 6000, "漢" * 4000]
    assert [x.tolist() for x in own.encode(long, True)] == [e.ids for e in _BYTES.encode_batch(long, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab e's\n\t ▁<0x41>é漢😀\x00\x85")), max_size=50), min_size=1, max_size=4))
def test_cuts_between_words_change_no_id(texts):
    own, joined = A.ByteLevelTokens(BYTE_BPE), A.PieceTokens(PIECE_BPE)
    assert joined.cuttable
    for t in texts:
        parts = A.pieces(t, 3)
        assert " ".join(parts) == t
        assert [i for x in own.encode([" " + p for p in parts]) for i in x.tolist()] == own.encode([" " + t])[0].tolist()
        if all(parts):
            assert [i for x in joined.encode(parts) for i in x] == joined.encode([t])[0]


# -- embedding links ------------------------------------------------------------------------

SCHEMA = "vec_id long, embedding array<double>, label int, tile string, n long, key int, code string, node long, top int"


def vectors():
    rng, rows = np.random.default_rng(3), []
    for group in range(12):  # near copies around the threshold, some of them chained
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(3, 15))):
            rows.append(((centre + rng.normal(size=16) * rng.choice([0.02, 0.13, 0.2])).tolist(), int(group % 3)))
    rows += [(rng.normal(size=16).tolist(), int(rng.integers(0, 4))) for _ in range(60)]
    rows += [(rows[0][0], 0)] * 7 + [(rows[0][0], 1), ([2 * x for x in rows[0][0]], 0), (rows[5][0], None)]
    rows += [(None, 1), ([], 1), ([0.0] * 16, 1), ([0.0, -0.0] * 8, 1), ([1.0, None] * 8, 1), ([math.inf] * 16, 1), ([math.nan] * 16, 1)]
    rows += [([1e200] * 16, 2), ([1e-200] * 16, 2), ([1.0] * 16, 2), ([1.0] * 3, 2), ([5.0] * 3, 2), ([1.0, 0.0, 0.0], 2)]
    ids = list(range(10, 10 + len(rows)))
    ids[3] = ids[4] = None  # rows without an id
    ids[7] = ids[8]  # a repeated id with two vectors
    rnd = random.Random(2)
    rnd.shuffle(ids)
    return [(i, v, lab) for i, (v, lab) in zip(ids, rows)]


def plain_links(rows, threshold):
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    usable = [bool(lab is not None and ok(v)) for _, v, lab in rows]
    unit = [None if not u else E.unit_vectors(np.array([v], float))[0] for u, (_, v, _) in zip(usable, rows)]
    n, label = np.zeros(len(rows), int), np.arange(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                n[i] += 1
                n[j] += 1
                label[label == label[i]] = label[j]
    least = {}
    for k, (d, *_) in enumerate(rows):
        least[label[k]] = min(least.get(label[k], math.inf), math.inf if d is None else d)
    least = {k: None if v == math.inf else v for k, v in least.items()}
    return Counter((d, int(n[k]), least[label[k]], d == least[label[k]]) for k, (d, *_) in enumerate(rows))


@pytest.mark.parametrize("tile,threshold", [(4, 0.98), (1024, 0.98), (7, 0.9), (16, -0.5)])
def test_embedding_links(spark, tile, threshold):
    rows = vectors()
    df = spark.createDataFrame([(*r, "t", 1, 2, "c", 3, 4) for r in rows], SCHEMA).repartition(3)
    got = E.link_embeddings(df, threshold, tile=tile).collect()
    assert Counter(tuple(r[k] for k in ("vec_id", "n_links", "component_id", "kept")) for r in got) == plain_links(rows, threshold)


def test_embedding_links_with_string_labels_and_floats(spark):
    rows = vectors()
    df = spark.createDataFrame([(*r, "t", 1, 2, "c", 3, 4) for r in rows], SCHEMA)
    df = df.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), F.concat(F.lit("l"), "label").alias("label"))
    as_float = [(d, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for d, v, lab in rows]
    got = E.link_embeddings(df, tile=8).collect()
    assert Counter(tuple(r[k] for k in ("vec_id", "n_links", "component_id", "kept")) for r in got) == plain_links(as_float, 0.98)


def test_embedding_links_of_empty_and_unusable_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.link_embeddings(df).collect() == []
    df = spark.createDataFrame([(1, None, 1), (None, [0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert {tuple(r) for r in E.link_embeddings(df).collect()} == {(1, 0, 1, True), (None, 0, None, True)}


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 40), st.sampled_from([1e-3, 0.1, 1.0]))
def test_quantisation_bound_holds(seed, dim, spread):
    rng = np.random.default_rng(seed)
    unit = E.unit_vectors(rng.normal(size=dim) + rng.normal(size=(20, dim)) * spread)
    q, scale, err = E.quantised(unit)
    about = (q.astype(float) @ q.T.astype(float)) * scale[:, None] * scale
    bound = err[:, None] + err * (1 + err[:, None])
    assert (np.abs(unit @ unit.T - about) <= bound + 1e-12).all()
    assert np.abs(q.astype(int)).max() <= 127


def test_near_copies_cost_rows_as_the_group_not_its_pairs(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=8) + rng.normal(size=(600, 8)) * 0.01
    a = {"tile": 0, "n": 300, "dim": 8}
    unit = E.unit_vectors(x)
    q, scale, err = E.quantised(unit)
    half = lambda t, s: {**a, "tile": t, "many": [1] * 300, "scale": scale[s].tobytes(), "err": err[s].tobytes(),
                         "q": q[s].tobytes(), "x": x[s].tobytes()}
    import pyarrow as pa
    out = E._compare(0.98)(pa.Table.from_pylist([half(0, slice(0, 300)), half(1, slice(300, 600))]))
    assert out.num_rows == 600 and set(out["n"].to_pylist()) == {300}
