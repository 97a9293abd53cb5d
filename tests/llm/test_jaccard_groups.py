"""Documents that share a passage but not enough of it."""

import random

import llm_helpers as H
from tidemart.llm import jaccard_join


def own(rnd, k):
    return [f"w{rnd.getrandbits(60)}" for _ in range(k)]


SHARED = [f"p{i}" for i in range(60)]


def test_groups_of_unlinked_documents_make_no_pairs(spark, monkeypatch):
    seen, verified = [], jaccard_join._verified

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return verified(pairs, *rest)
    monkeypatch.setattr(jaccard_join, "_verified", counted)
    rnd = random.Random(1)
    # 0.83 alike by the passage alone; the last six are near copies of the first six
    rows = [(i, " ".join(SHARED + own(rnd, 6))) for i in range(1500)]
    rows += [(1500 + i, rows[i][1] + " tail") for i in range(6)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(H.frame(spark, rows).repartition(4)).collect()}
    assert all(got[i] == i for i in range(1500))
    assert all(got[1500 + i] == i for i in range(6))
    pivots, rest = seen
    assert pivots < 10 * len(rows) and rest < len(rows)   # all pairs: over a million


def test_documents_around_a_shared_passage_equal_all_pairs(spark):
    for seed, num in ((2, 85), (3, 80)):
        rnd = random.Random(seed)
        rows = [(i, " ".join(SHARED + own(rnd, rnd.randint(2, 9)))) for i in range(40)]
        for i in range(30):  # longer and shorter ones, with words that some have in common
            a, b = sorted(rnd.sample(range(61), 2))
            rows.append((40 + i, " ".join(own(rnd, rnd.randint(0, 3)) + SHARED[:a] + [f"c{i % 5}"] + SHARED[b - (b - a) // 6:])))
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
               for r in jaccard_join.jaccard_components(H.frame(spark, rows), 4, num, 100).collect()}
        assert got == H.components(rows, 4, num, 100)
