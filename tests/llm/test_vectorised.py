"""Single-machine parts: hashing, trees, tries, planes, windows, against plain versions."""
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemart.llm import common, decontaminate, jaccard_join, licenses, suffix_dedup, token_counts, token_output, topk, toxicity
from llm_helpers import words as plain_words

TEXT = st.text(alphabet=st.sampled_from(list("aB é1\n\t .'s\x1c漢😀")), max_size=60)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_words_are_the_regex_words(texts):
    data, offsets = common.text_buffers(pa.array(texts, pa.string()))
    start, end, h, text, low = common.words_of(data, offsets, common.WHITE_SPACE)
    got = [(int(t), bytes(low[a:e]).decode()) for t, a, e in zip(text, start, end)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in plain_words(t)]
    by = {}
    for (_, w), x in zip(got, h):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aB é1\n\t .'’́s\x1c\x85 İΣ<|>endoftxt漢😀")), max_size=40), max_size=8))
def test_word_encoder_equals_whole_text_encoding(texts):
    check_encoder(texts)


def test_word_encoder_on_documents():
    import pyarrow.parquet as pq
    check_encoder([t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()])


def check_encoder(texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    code, whole = token_output.encoder(path), Tokenizer.from_file(path)
    for t in [*texts, "<|endoftext|> a<|startoftext|>b", "It's  don't\n\n'll", "Straße, ÉÀÿ. ßß! Éléphant; word's \u00d7 a\u0301. Ab,.b :a ÿ?",
              "a b\nc  d"]:
        want = whole.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(code.encode(t), "<u4").tolist() == want


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2 ** 32, n, dtype=np.uint32)
    planes = token_output.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert (token_output.from_planes(planes, n) == ids).all()


def test_crc_of_pieces():
    parts = [b"abc", b"", b"x" * 1000, b"\x00\xff"]
    assert token_output.join_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


SPACED = st.text(alphabet=st.sampled_from(list("ab  \n\t'.1é ")), max_size=80)


@settings(max_examples=150, deadline=None)
@given(SPACED)
def test_cut_pieces_count_like_the_whole(text):
    code = token_counts.counter("byte_bpe_50k.tiktoken")
    pieces = token_counts.cut(text)
    assert "".join(pieces) == text
    assert sum(code.counts(pieces)) == code.one(text)


@settings(max_examples=150, deadline=None)
@given(SPACED, st.lists(st.tuples(st.integers(0, 80), st.integers(0, 12), st.text(alphabet=st.sampled_from(list("x \n'1")), max_size=5)), max_size=5),
       st.integers(1, 4))
def test_edits_equal_a_recount(text, wanted, leaf):
    code = token_counts.counter("byte_bpe_50k.tiktoken")
    edits, at = [], 0
    for pos, gone, new in sorted(wanted):
        pos = max(at, min(pos, len(text)))
        gone = min(gone, len(text) - pos)
        edits.append((pos, gone, new))
        at = pos + gone
    tree = token_counts.TokenTree(*token_counts.leaves(text, code, leaf))
    tree = token_counts.TokenTree.load(tree.dump())
    new, _ = tree.edit(text, edits, code)
    want, p = [], 0
    for pos, gone, ins in edits:
        want += [text[p:pos], ins]
        p = pos + gone
    want = "".join([*want, text[p:]])
    assert new == want and tree.chars == len(want) and tree.tokens == code.one(want)


def test_an_edit_encodes_a_small_part():
    code = token_counts.counter("byte_bpe_50k.tiktoken")
    text = " ".join(f"word{i}" for i in range(5000))
    tree = token_counts.TokenTree(*token_counts.leaves(text, code))
    _, encoded = tree.edit(text, [(20000, 5, "new")], code)
    assert 0 < encoded < 1000


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=30), st.integers(0, 4))
def test_deep_shallow_sort(strings, shallow):
    order, lcp = suffix_dedup.deep_shallow_sort(strings, shallow)
    assert [strings[i] for i in order] == sorted(strings)
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        assert lcp[k] == suffix_dedup._common(a, b)


def test_window_anchors_follow_the_content():
    rnd = np.random.default_rng(3)
    text = rnd.integers(97, 100, 3000).astype(np.uint8)
    both = np.concatenate([text, rnd.integers(97, 100, 500).astype(np.uint8), text[500:2000]])
    _, anchor, first, last, _, _ = suffix_dedup.window_runs(both, np.array([0, len(both)]), 64)
    of = {}
    for a, f, l in zip(anchor, first, last):
        for s in range(f, l + 1):
            of[s] = a - s
    assert len(of) == len(both) - 63
    for s in range(0, 1500 - 63):
        assert of[500 + s] == of[3500 + s]


def test_kd_order_is_a_permutation_with_small_leaves():
    x = np.random.default_rng(1).normal(size=(1000, 5)).round(1)
    x[300:700] = 1.0  # many equal rows
    order, ends = topk.kd_order(x, 16)
    assert sorted(order) == list(range(1000)) and ends[-1] == 1000
    assert (np.diff(np.concatenate([[0], ends])) <= 16).all() and (np.diff(ends) > 0).all()


def test_fingerprint_search_finds_all_within_radius():
    rnd = random.Random(4)
    probes = np.array([rnd.getrandbits(64) for _ in range(20)], np.uint64)
    near = decontaminate.near_tables(probes)
    for p in probes.tolist():
        for _ in range(200):
            x = p
            for b in rnd.sample(range(64), rnd.randint(0, decontaminate.RADIUS)):
                x ^= 1 << b
            parts = np.array([x], np.uint64).view(np.uint16)
            assert any(near[k][parts[k]] for k in range(decontaminate.BLOCKS))


def test_window_sizes():
    assert [decontaminate.window_size(n) for n in (1, 2, 3, 4, 5, 8, 100)][:5] == [1, 2, 3, 4, 5]
    for n in range(1, 500):
        assert 0.75 * n <= decontaminate.window_size(n) <= n


def test_order_filters_keep_every_link():
    """Sets that just reach the similarity share a looked-up token of their hash-order prefixes."""
    rnd = random.Random(2)
    for num, den in ((85, 100), (80, 100), (1, 2)):
        for _ in range(300):
            n = rnd.randint(1, 120)
            x = rnd.sample(range(10 ** 6), n)
            keep = rnd.sample(x, rnd.randint(max(1, num * n // den), n))
            y = keep + rnd.sample(range(10 ** 6, 2 * 10 ** 6), rnd.randint(0, n // 5))
            both = len(set(x) & set(y))
            if den * both < num * (len(x) + len(y) - both):
                continue
            df = {t: rnd.randint(2, 50) for t in {*x, *y}}

            def looked(s):
                first = sorted(s)[:jaccard_join.sample_length(len(s), num, den)]
                skip = -(-len(s) * num // (den * jaccard_join.SHARE)) - 1
                often = sorted((df[t], t) for t in first)
                return {t for _, t in often[:len(often) - skip]}
            assert looked(x) & looked(y)


def test_licence_places():
    words = licenses.vocabulary(["a b a", "b c"])
    number = {w: i for i, w in enumerate(words)}
    text = "a b a b a x b c a b".split()
    hits = [(number[w], i) for i, w in enumerate(text) if w in number]
    word, key = np.array([w for w, _ in hits]), np.array([k for _, k in hits], np.int64)
    idf = np.array([1.0, 2.0, 3.0])
    assert licenses.places_of([number[w] for w in "a b a".split()], idf, word, key).tolist() == [0, 2]
    assert licenses.places_of([number[w] for w in "b c".split()], idf, word, key).tolist() == [6]


def test_machine_learns_a_pairwise_rule():
    """Label 1 only if terms 1 and 2 stand together: no additive score separates this."""
    rnd = random.Random(8)
    rows, label = [], []
    for _ in range(1500):
        r = {b for b in (1, 2, 3, 4) if rnd.random() < 0.5}
        rows.append(np.array(sorted(r), np.int64))
        label.append(int({1, 2} <= r))
    m = toxicity.fit(rows, np.array(label), float(np.mean(label)), bits=4, epochs=60)
    table, ok = m.table(), 0
    for r, y in zip(rows, label):
        row, feature = m.pairs(np.zeros(len(r), np.int64), r, table)
        ok += (m.logits(row, feature, 1)[0] >= 0) == bool(y)
    assert ok / len(rows) > 0.98
