"""The machine's score as an explicit sum over pairs, and terms that only decide beside others."""
import itertools

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import common, toxicity


def test_logits_are_explicit_pair_sums():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(8, np.sort(rng.choice(256, 40, replace=False)), -0.7, rng.normal(size=40), rng.normal(size=(40, 4)))
    texts = [rng.integers(0, 256, n) for n in (0, 1, 5, 30, 200)]
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = m.logits(*m.pairs(text, np.concatenate(texts), m.table()), len(texts))
    place = {b: i for i, b in enumerate(m.buckets.tolist())}
    for t, score in zip(texts, got):
        own = sorted({place[b] for b in t.tolist() if b in place})  # a term counts once, however often it stands
        want = m.bias + sum(m.w[i] for i in own) + sum(m.v[i] @ m.v[j] for i, j in itertools.combinations(own, 2))
        assert score == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("group_rate", [0.67, 0.8, pytest.param(0.95, marks=pytest.mark.xfail(strict=True, reason=(
    "the insult stands in a clean text in 74 of 4,000 rows only: both terms are features, but its own weight "
    "decides and these rows are flagged (right in 0.9815 of all rows)")))])
def test_a_group_mention_common_in_clean_texts_decides_beside_an_insult(group_rate):
    rng, rows, label = np.random.default_rng(3), [], []
    for i in range(4000):
        toxic, r = i % 3 == 0, rng.random()
        own = {1, 2} if toxic else {2} if r < group_rate else {1} if r < group_rate + (1 - group_rate) / 2 else set()
        rows.append(np.array(sorted({*rng.integers(100, 400, 12).tolist(), *own})))
        label.append(int(toxic))
    m = toxicity.fit(rows, np.array(label), 1 / 3)
    assert {1, 2} <= set(m.buckets.tolist())
    table, text = m.table(), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    found = m.logits(*m.pairs(text, np.concatenate(rows), table), len(rows)) > 0
    assert np.mean(found == np.array(label, bool)) > 0.99


def test_terms_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["You zorgface of the mudgroup", "", "clean words here", None, "zorgface"]
    alone = [set(toxicity.terms(*common.text_buffers(pa.array([t], pa.string())))[1].tolist()) for t in texts]
    text, bucket = toxicity.terms(*common.text_buffers(pa.array(texts, pa.string())))
    assert [set(bucket[text == i].tolist()) for i in range(len(texts))] == alone
