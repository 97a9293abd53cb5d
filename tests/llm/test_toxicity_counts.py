"""learn() counts buckets in tasks: the driver gets counts and features, and the machine is the one of fit()."""
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemart.llm import common, toxicity


def _documents():
    """600 documents of 60 words of their own; a third are toxic by an insult, a group mention decides beside another."""
    rnd, rows = random.Random(2), []
    for i in range(600):
        own = ["".join(chr(97 + (60 * i + k) // 26 ** p % 26) for p in range(4)) + "qq" for k in range(60)]  # 3 terms of their own
        toxic = i % 3 == 0
        own += ["zorgface"] if toxic and i % 2 else ["blurg", "mudgroup"] if toxic else rnd.choice([["blurg"], ["mudgroup"], []])
        rnd.shuffle(own)
        rows.append((i, " ".join(own), int(toxic)))
    return rows


def test_the_driver_gets_counts_and_features_not_the_terms(spark, monkeypatch):
    rows = _documents()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, c) for i, _, c in rows], "doc_id long, toxic int").repartition(3)
    sent, real = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: sent.append(real(self)) or sent[-1])
    machine = toxicity.learn(docs, labels)
    assert sum(t.nbytes for t in sent) < 40_000  # the terms of all documents are over 300,000 bytes

    ids = {r[0] for r in labels.where(~toxicity.held_out(labels.doc_id)).collect()}
    known = [r for r in rows if r[0] in ids]
    text, bucket = toxicity.terms(*common.text_buffers(pa.array([t for _, t, _ in known])))
    sets = sorted(((c, np.unique(bucket[text == k]).astype("<i4")) for k, (_, _, c) in enumerate(known)),
                  key=lambda r: (r[0], r[1].tobytes()))
    assert sum(s.nbytes for _, s in sets) > 300_000
    label = np.array([c for c, _ in sets])
    want = toxicity.fit([s for _, s in sets], label, np.mean(label))
    assert len(want.buckets) and np.array_equal(machine.buckets, want.buckets)
    assert np.allclose(machine.w, want.w, rtol=0, atol=1e-12) and np.allclose(machine.v, want.v, rtol=0, atol=1e-12)
    assert abs(machine.bias - want.bias) < 1e-9


def test_rates_over_parts_are_those_over_all_rows(spark):
    rnd = np.random.default_rng(4)
    rows = [(int(rnd.integers(0, 2)), np.unique(rnd.integers(0, 50, 6)).astype("<i4")) for _ in range(90)]
    sample = spark.createDataFrame([(c, bytearray(r.tobytes())) for c, r in rows], "label int, terms binary").repartition(7)
    for speaks in (None, np.array([3, 8])):
        near = [(c, r) for c, r in rows if speaks is None or np.isin(r, speaks).any()]
        got = toxicity._rates(sample, 6, speaks)
        assert (got.n1, got.n0) == (sum(c for c, _ in near), sum(1 - c for c, _ in near))
        want = {b: (sum(c for c, r in near if b in r), sum(1 - c for c, r in near if b in r)) for b in range(50)}
        assert dict(zip(got.bucket.tolist(), zip(got.one.tolist(), got.zero.tolist()))) == {
            b: v for b, v in want.items() if sum(v) >= 3}
