import math
import random
import re
from collections import Counter

import numpy as np

from tessera.llm import op13_search as op

from cases import frame, rows

ITEMS = "item_id long, text string, item int, doc_id string, score int, rank string, terms int"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def brute(docs, items, k=50):
    bags = [(i, Counter(terms(t))) for i, t, *_ in docs]
    n_docs, length = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for at, (i, bag) in enumerate(bags):
            m = 100 - 50 + (50 * sum(bag.values()) * n_docs) // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in set(terms(text)) if t in bag)
            if score > 0:
                found.append((-score, i is None, i or 0, at))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i, _) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def items_frame(spark, data):
    return spark.createDataFrame([(i, t, 1, "x", 1, "x", 1) for i, t in data], ITEMS)


def search(spark, docs, items, **args):
    return sorted(map(tuple, op.search(frame(spark, docs), items_frame(spark, items), **args).collect()), key=str)


def corpus(n=700, seed=2):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Über", "Ça", "X1"]
    weight = [1 / (k + 1) for k in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weight, k=rng.choice([3, 20, 60, 400]))), "en") for i in range(n)]
    docs += [(5000 + i, docs[3][1], "en") for i in range(80)]  # equal scores
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(30)] + [(40, docs[7][1]), (41, docs[3][1])]
    return docs, items


def test_ranking_against_brute_force(spark):
    docs, items = corpus()
    docs += rows()
    items += [(50, None), (51, ""), (52, "?!"), (53, "nothere"), (None, "w1 W2 über"), (1, "w3 w4"), (54, "the of and")]
    assert search(spark, docs, items) == brute(docs, items)


def test_several_passes_and_small_k(spark):
    docs, items = corpus(300, 5)
    old = op.ITEM_TERMS, op.ITEMS
    op.ITEM_TERMS, op.ITEMS = 300, 13
    try:
        assert search(spark, docs, items, k=3) == brute(docs, items, k=3)
    finally:
        op.ITEM_TERMS, op.ITEMS = old


def test_empty_tables(spark):
    docs, items = corpus(20)
    assert search(spark, [], items) == []
    assert search(spark, docs, []) == []
    assert search(spark, [(1, None, None), (2, "", "en")], items) == []


def test_bucket_search_is_exact_under_any_threshold():
    rng = np.random.default_rng(4)
    size, n = 60, 200
    dense = rng.integers(0, 1000, (n, size)) * (rng.random((n, size)) < 0.2)
    row, term = np.nonzero(dense)
    impact = dense[row, term].astype(np.int64)
    weights = [rng.integers(0, 50, 8) for _ in range(40)]
    chosen = [rng.choice(size, 8, replace=False) for _ in range(40)]
    q = op.Items(np.arange(0, 8 * 41, 8, dtype=np.int64).tobytes(), np.concatenate(chosen).astype(np.int32).tobytes(), np.concatenate(weights).astype(np.int64).tobytes())
    score = np.array([dense[:, t] @ w for t, w in zip(chosen, weights, strict=True)])
    norm = np.sqrt((dense.astype(float) ** 2).sum(axis=1))
    old = op.POSTINGS
    for op.POSTINGS in (1, 50, 1 << 20):
        for floor in (np.ones(40, np.int64), np.sort(score, axis=1)[:, -3], score.max(axis=1) + 1):
            got = set(zip(*map(np.ndarray.tolist, op.search_bucket(q, floor, norm, row, term, impact, size)), strict=True))
            assert got == {(i, d, score[i, d]) for i, d in zip(*np.nonzero((score >= floor[:, None]) & (score > 0)), strict=True)}
    op.POSTINGS = old
