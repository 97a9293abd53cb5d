"""The corpus pipeline, stage by stage, against brute-force versions on planted documents."""
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
import llm_helpers as H

COLS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Folder with documents, labels and benchmark; which documents are toxic, near copies and leaks."""
    rnd = random.Random(11)
    vocab = ["".join(rnd.choice("aeioubcdfg") for _ in range(rnd.randint(3, 8))) for _ in range(900)]
    insults = ["zorgface", "zorgling", "mudbrain"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(30))) for i in range(5)]
    docs, labels, toxic, leaks = [], [], set(), set()
    for d in range(500):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(20, 120))]
        if d % 5 == 1:
            for w in rnd.sample(insults, 2):
                words.insert(rnd.randint(0, len(words)), w)
            toxic.add(d)
        elif d % 25 == 2:
            at = rnd.randint(0, len(words))
            words[at:at] = items[d % 5][1].split()
            leaks.add(d)
        labels.append((d, 1, int(d in toxic)))
        docs.append((d, " ".join(words)))
    for k in range(60):  # exact and near copies of clean documents
        words = docs[(k // 6) * 5][1].split()
        if k % 3 and len(words) > 60:
            words[rnd.randrange(len(words))] = "other"
        docs.append((1000 + k, " ".join(words)))
    docs += [(2000, None), (2001, ""), (2002, "tiny"), (None, "no id here at all")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(d, t, "en", f"s{(d or 0) % 3}", len(t or "")) for d, t in docs], COLS).repartition(4).write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, toxic, leaks


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_take_effect_and_keep_clean_documents(spark, corpus):
    folder, toxic, leaks = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard_join", "decontamination", "mixing", "token_output"]
    stage = dict(P.STAGES)

    clean = stage["toxicity"](spark, docs, folder).cache()
    assert clean.columns == docs.columns
    assert Counter(rows(clean)) == Counter(r for r in rows(docs) if r[0] not in toxic)

    one = stage["ngram_jaccard_join"](spark, clean, folder).cache()
    have = [r for r in rows(clean) if r[0] is not None]
    want = {d for d, (_, c) in H.components(have, 5, 80, 100).items() if c == d}
    assert one.columns == docs.columns
    assert Counter(r[0] for r in rows(one)) == Counter([*want, None])

    fair = stage["decontamination"](spark, one, folder).cache()
    assert fair.columns == docs.columns
    assert Counter(r[0] for r in rows(fair)) == Counter(r[0] for r in rows(one) if r[0] not in leaks)

    mixed = stage["mixing"](spark, fair, folder).cache()
    assert mixed.columns == docs.columns
    times, size = Counter(r[0] for r in rows(mixed)), {d: len(H.words(t)) for d, t in rows(fair)}
    assert set(times) <= set(size) and max(times.values()) <= 3
    total = sum(size.values())
    assert total - 150 <= sum(n * size[d] for d, n in times.items()) <= total

    code = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expect = 0, Counter()
    for d, t in sorted(rows(mixed), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*code.encode(t or "", add_special_tokens=False).ids, 1]
        expect[(d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
        start += len(ids)
    tokens = stage["token_output"](spark, mixed, folder)
    assert Counter((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokens.collect()) == expect


def test_run_writes_and_rereads_every_stage(spark, corpus):
    out = P.run(spark, corpus[0])
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    last = out.orderBy("start").collect()
    assert last[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(last, last[1:]))
    assert P.ORACLE_SQL is None


def test_empty_documents_pass_through_every_stage(spark, corpus):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_decontamination_judges_rows_without_an_id_by_their_text(spark, tmp_path):
    rnd = random.Random(21)
    text = lambda n: " ".join(f"w{rnd.randrange(500)}" for _ in range(n))
    items = [(1, text(20)), (None, text(30)), (None, text(25))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, text(60)), (None, text(40)), (None, None), (None, ""), (1, text(50))]
    held = [(None, items[0][1]), (None, text(9) + " " + items[0][1]), (None, items[1][1]), (2, text(5) + " " + items[2][1]),
            (3, items[0][1]), (3, text(30))]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in clean + held], COLS).repartition(3)
    out = P.drop_contaminated(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert Counter(rows(out)) == Counter(clean)


def test_near_duplicates_judges_rows_without_an_id_one_by_one(spark):
    rnd = random.Random(22)
    text = lambda n: " ".join(f"w{rnd.randrange(500)}" for _ in range(n))
    a, b, c, d, e = (text(60) for _ in range(5))
    stay = [(5, a), (9, b), (None, c), (None, d), (None, None), (None, ""), (None, " ")]
    go = [(None, a), (None, b + " tail"), (None, a.upper()), (None, c), (11, b)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in stay + go + [(None, e), (None, e + " tail")]], COLS).repartition(3)
    out = P.drop_near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    got = Counter(rows(out))
    pair = [got.pop((None, t), 0) for t in (e, e + " tail")]
    assert got == Counter(stay) and sorted(pair) == [0, 1]
