import numpy as np
import pytest

from tessera.llm import op09_embeddings as op

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, kept string, weight int, id int"


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, "x", "x", 1, 1) for i, v in data], SCHEMA)


def vectors(seed=0, dims=32, lone=600):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dims) for _ in range(lone)]
    for size, noise in ((2, 0.2), (3, 0.25), (8, 0.2), (15, 0.28), (60, 0.2), (60, 0.3), (150, 0.24)):
        centre = rng.normal(size=dims)
        out += [centre + noise * rng.normal(size=dims) * 0.7 for _ in range(size)]
    out += [out[0]] * 30 + [out[1] * 2.0]
    return [(i, np.float32(v).tolist()) for i, v in enumerate(out)]


def brute(data, threshold=0.95):
    x = np.array([v for _, v in data], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    comp = np.arange(len(x))
    while True:
        new = np.array([min(comp[i], comp[near[i]].min(initial=len(x))) for i in range(len(x))])
        new = new[new]
        if (new == comp).all():
            return near.sum(axis=1), comp
        comp = new


def test_links_against_brute_force(spark):
    data = vectors()
    n, comp = brute(data)
    assert n.max() > 40
    got = {r["vec_id"]: r for r in op.near_duplicates(frame(spark, data)).collect()}
    mine = np.array([got[i]["n_links"] for i in range(len(data))])
    assert (mine <= n).all() and mine.sum() >= 0.97 * n.sum()
    assert np.mean([got[i]["component_id"] == comp[i] for i in range(len(data))]) > 0.99
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [-0.0, 1.0]), (10, [0.0, 1.0, 0.0]), (None, [1.0, 2.0]),
            (7, [1.0, 2.0]), (11, [1e-30, 2e-30]), (12, [3e38, 0.0])]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in op.near_duplicates(frame(spark, data)).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert got[:6] == [(i, 0, i, True) for i in range(1, 7)]
    assert [(g[0], g[1] >= 2, g[2]) for g in got[6:9]] == [(7, True, 7), (7, True, 7), (8, True, 7)]
    assert got[9] == (9, 1, 9, True) and got[10] == (10, 1, 9, False) and got[11][2] == 7 and got[12] == (12, 0, 12, True)
    assert got[13] == (None, 0, None, True)
    assert op.near_duplicates(frame(spark, [])).count() == 0
    assert op.near_duplicates(frame(spark, [(1, None)])).count() == 1


def test_blocks_count_like_one(spark):
    data = vectors(3, lone=50)
    old, op.BLOCK = op.BLOCK, 16
    try:
        got = {r["vec_id"]: r["n_links"] for r in op.near_duplicates(frame(spark, data)).collect()}
    finally:
        op.BLOCK = old
    n, _ = brute(data)
    assert sum(got.values()) >= 0.97 * n.sum() and all(got[i] <= n[i] for i in got)


def test_audit_counts_all_its_vectors_in_tiles(spark, monkeypatch):
    data = vectors(5)
    n, _ = brute(data)
    monkeypatch.setattr(op, "ASKED", 4)
    monkeypatch.setattr(op, "OFFERED", 100)
    cuts, real = [], op.cut_lineage
    monkeypatch.setattr(op, "cut_lineage", lambda d: cuts.append(real(d)) or cuts[-1])
    op.near_duplicates(frame(spark, data))
    truth = {r["id"]: r["truth"] for c in cuts if "truth" in c.columns for r in c.collect()}
    # the vectors are their groups of equal ones, which count as often as they stand
    same = {tuple(v): i for i, v in reversed(data)}
    size = {}
    for _, v in data:
        size[tuple(v)] = size.get(tuple(v), 0) + 1
    want = {same[tuple(v)]: int(n[i]) - size[tuple(v)] + 1 for i, v in data if i % 50 == 0}
    assert truth == {i: c for i, c in want.items() if c}


def test_too_little_recall_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(op, "descend", lambda v, *a, **k: v.sparkSession.createDataFrame([], "a long, b long, sim float, fresh boolean"))
    with pytest.raises(RuntimeError, match="less than"):
        op.near_duplicates(frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 0.01]), (2, [0.0, 1.0])]), attempts=2)
