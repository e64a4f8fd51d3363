import random
import re

import numpy as np

from cases import frame, rows
from tessera.llm import op08_minhash as op
from tessera.llm import textvec as tv
from tessera.operators.components import components
from test_textvec import LOW


def shingles(t, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(data, n, percent):
    ids = sorted({i for i, _, _ in data if i is not None})
    sets = [(i, shingles(t, n)) for i, t, _ in data if i is not None]
    up = {i: i for i in ids}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(i), find(j)))
                up[hi] = lo
    return {i: find(i) for i in ids}


def group(rng, base, n, change, first):
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(change if k else 0):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        out.append((first + k, " ".join(w), "en"))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(4)
    data = rows(60)
    for g, (n, change) in enumerate(((6, 0), (12, 1), (25, 2), (25, 4), (20, 7))):
        data += group(rng, [f"v{rng.randrange(500)}" for _ in range(120)], n, change, 1000 + 100 * g)
    data += [(2000, "one two", "en"), (2001, "One  TWO", "en"), (2002, "one two three", "en"), (2003, "one", "en")]
    for n, percent in ((3, 85), (5, 80)):
        got = op.near_duplicates(frame(spark, data), n, percent).collect()
        want = brute(data, n, percent)
        assert len(got) == len(data)
        for r in got:
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert r["component_id"] == want[r["doc_id"]], r
                assert r["kept"] == (r["doc_id"] == r["component_id"])
        sizes = {i: len(shingles(t, n)) for i, t, _ in data if i is not None}
        assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in got if r["doc_id"] is not None)


def test_empty_table(spark):
    assert op.near_duplicates(frame(spark, [])).count() == 0
    assert [r["kept"] for r in op.near_duplicates(frame(spark, [(1, None, None), (2, "", None)])).collect()] == [True, True]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 400).astype(tv.U64)
    for common in (0, 100, 200, 360):
        b = np.concatenate([a[:common], rng.integers(0, 2**63, 400 - common).astype(tv.U64)])
        row = np.repeat([0, 1], 400)
        s = op.sketch(row, np.concatenate([a, b]), 3, 512)
        assert (s[:2] < 2**64 - 1).all() and (s[2] == 2**64 - 1).all()
        assert abs((s[0] == s[1]).mean() - common / (800 - common)) < 0.08
    one = op.sketch(np.zeros(1, int), a[:1], 1, 125)
    assert (one < 2**64 - 1).all() and (one == op.sketch(np.zeros(1, int), a[:1], 1, 125)).all()


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(4000, 4300)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def find(a):
        up.setdefault(a, a)
        while up[a] != a:
            a = up[a]
        return a

    for a, b in edges[:-2]:
        if a != b:
            lo, hi = sorted((find(a), find(b)))
            up[hi] = lo
    assert got == {a: find(a) for a in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_later_links_join_components_not_all_links_anew(spark, monkeypatch):
    # one bucket: hub 0 is like nobody, 1-60 are copies but for a word each, 61 is alone
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(f"x{k}" for k in range(60)), *[" ".join(base[:59] + [f"own{k}"]) for k in range(60)], " ".join(f"y{k}" for k in range(60))]
    docs = frame(spark, [(i, t, "en") for i, t in enumerate(texts)])
    member = spark.createDataFrame([(1, i, 58, 0) for i in range(62)], "key long, id long, n long, hub long")
    given, cuts = [], []
    monkeypatch.setattr(op, "components", lambda df: given.append(df.count()) or components(df))
    cut = op.cut_lineage
    monkeypatch.setattr(op, "cut_lineage", lambda df: cuts.append(1) or cut(df))
    out = op._link_buckets(member, docs, 3, 85)
    got = {r["node"]: r["component"] for r in out.collect()}
    assert got == {i: 1 for i in range(1, 61)}
    assert given[0] == 0 and len(given) == 2
    assert len(cuts) <= 16  # 19 with the links so far and those who led
