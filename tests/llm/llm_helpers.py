"""Small documents with every awkward case, and plain re-statements of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "key string, label string, n long, doc string, token string, size string, _row string, tokens string, rank int")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WHITE = " \t\n\x0b\f\r"


def frame(spark, rows):
    """documents with extra columns of clashing names from (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or ""), "x", "1", -5, "d", "t", "s", "r", "q", 3)
            for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def edge_rows():
    """Nulls, empties, ties, copies, repeated rows, very long and odd texts."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    base = [word() for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    long = " ".join(word() for _ in range(6000))
    return [
        (1, " ".join(base), "a"), (2, " ".join(base), "a"), (3, " ".join(near), "b"),
        (4, None, "b"), (5, "", None), (6, "   \n\t ", None), (7, "one", "a"), (8, "ONE", "c"),
        (9, "two words", "c"), (10, long, "a"), (11, long + " tail", "a"), (None, "no id but words here", "a"),
        (None, None, None), (12, "line one is long\nLINE ONE IS LONG \nshort\n", "b"),
        (13, "x\nline one is long\n\n", "b"), (14, "ünïcode ١٢٣ 漢字 \U0001f600 é don't 's\x1c y", "z"),
        (15, "same row", "a"), (15, "same row", "a"), (16, "<|endoftext|> a<|startoftext|>b", "a"),
        (17, "a\x00b\x0bc", "\U0001f600"),
    ]


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


def shingles(text, n):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}


def components(rows, n, num, den):
    """doc_id -> (set size, smallest linked doc_id) by comparing all pairs; ids are unique."""
    sets = {d: shingles(t, n) for d, t, *_ in rows}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def weighted_jaccard(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))
