"""Iterative / non-SQL operators against brute force numpy on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from tessera.operators import cluster as cl
from tessera.operators.distance import knn
from tessera.sources.tables import rfm_points


@pytest.fixture(scope="module")
def pts(spark):
    p = rfm_points(spark, SF_SMALL).select("key", "x").cache()
    rows = sorted(p.collect(), key=lambda r: r["key"])
    keys = np.array([r["key"] for r in rows])
    X = np.array([r["x"] for r in rows])
    return p, keys, X


def _dbscan_numpy(keys, X, eps, min_samples):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    adj = D <= eps
    core = adj.sum(1) >= min_samples
    comp = -np.ones(len(keys), dtype=int)
    cid = 0
    for i in np.argsort(keys):
        if not core[i] or comp[i] >= 0:
            continue
        stack = [i]
        comp[i] = cid
        while stack:
            j = stack.pop()
            for m in np.where(adj[j] & core)[0]:
                if comp[m] < 0:
                    comp[m] = cid
                    stack.append(m)
        cid += 1
    # ids by smallest core key (the DFS above starts from keys in ascending order)
    out = comp.copy()
    for i in range(len(keys)):
        if not core[i]:
            nb = [comp[m] for m in np.where(adj[i] & core)[0]]
            out[i] = min(nb) if nb else -1
    kind = np.where(core, "core", np.where(out >= 0, "border", "noise"))
    return {int(k): (int(c), str(t)) for k, c, t in zip(keys, out, kind)}


@pytest.mark.parametrize("eps,min_samples", [(0.5, 4), (0.8, 6)])
def test_dbscan_matches_bruteforce(pts, eps, min_samples):
    p, keys, X = pts
    got = {r["key"]: (r["cluster"], r["kind"]) for r in cl.dbscan(p, "key", eps, min_samples).collect()}
    assert got == _dbscan_numpy(keys, X, eps, min_samples)


def test_knn_matches_bruteforce(pts):
    p, keys, X = pts
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    got = {}
    for r in knn(p, "key", 5, include_self=False).collect():
        got.setdefault(r["key"], []).append((r["rank"], r["nbr"]))
    for i, k in enumerate(keys):
        order = sorted((D[i, j], keys[j]) for j in range(len(keys)) if j != i)[:5]
        assert [n for _, n in sorted(got[int(k)])] == [int(n) for _, n in order]


def test_subtractive_centres_follow_the_rule(pts):
    """Each centre is the argmax of the potentials left by the earlier ones; the next one is not above the accept level."""
    p, _, X = pts
    _, centres = cl.subtractive(p, "key", ra=1.0, accept=0.4, reject=0.15, max_centres=10)
    taken: list[tuple[np.ndarray, float]] = []

    def left(v):
        full = np.exp(-4.0 * ((X - v) ** 2).sum(axis=1)).sum()
        for spot, height in taken:
            full = max(full - height * np.exp(-4.0 / 2.25 * ((spot - v) ** 2).sum()), 0.0)
        return full

    for c in map(np.array, centres):
        heights = np.array([left(v) for v in X])
        assert np.isclose(left(c), heights.max(), atol=1e-9)
        assert not taken or heights.max() > 0.4 * taken[0][1]
        taken.append((c, heights.max()))
    assert len(centres) == 10 or max(left(v) for v in X) <= 0.4 * taken[0][1] + 1e-9


def test_fuzzy_memberships_are_distributions(pts):
    p, _, _ = pts
    soft, centres, it = cl.fuzzy_cmeans(p, "key", 3, m=1.3, max_iter=200)
    r = soft.select(F.aggregate("u", F.lit(0.0), lambda a, v: a + v).alias("s"), "max_u").agg(
        F.max(F.abs(F.col("s") - 1)).alias("err"), F.min("max_u").alias("mn")).first()
    assert r["err"] < 1e-9 and r["mn"] >= 1 / 3 - 1e-9
    fpc = cl.fpc(soft).first()[0]
    assert 1 / 3 <= fpc <= 1.0


def test_ward_and_kmeans_partition_everything(pts):
    p, keys, _ = pts
    for lab in (cl.ward(p, "key", 3, micro=30), cl.kmeans(p, "key", 3, n_init=2)[0]):
        rows = lab.collect()
        assert sorted(r["key"] for r in rows) == sorted(int(k) for k in keys)
        assert {r["cluster"] for r in rows} == {0, 1, 2}


def test_silhouette_matches_bruteforce_squared(pts):
    p, keys, X = pts
    lab, _, _ = cl.kmeans(p, "key", 3, n_init=1)
    c = {r["key"]: r["cluster"] for r in lab.collect()}
    L = np.array([c[int(k)] for k in keys])
    D2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(keys)):
        own = (L == L[i])
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = D2[i, own].sum() / (own.sum() - 1)
        b = min(D2[i, L == o].mean() for o in set(L) if o != L[i])
        s.append((b - a) / max(a, b))
    assert cl.silhouette(p, lab, "key").first()[0] == pytest.approx(np.mean(s), abs=1e-9)


def test_dbscan_with_hot_spot_matches_bruteforce(spark, pts):
    """A third of the rows are copies of one point: collapsed, not paired."""
    p, keys, X = pts
    n_hot = len(keys) // 2
    hot = spark.createDataFrame([(10_000_000 + i, [float(v) for v in X[0]]) for i in range(n_hot)], "key long, x array<double>")
    p2 = p.unionByName(hot)
    keys2 = np.concatenate([keys, 10_000_000 + np.arange(n_hot)])
    X2 = np.vstack([X, np.repeat(X[:1], n_hot, axis=0)])
    got = {r["key"]: (r["cluster"], r["kind"]) for r in cl.dbscan(p2, "key", 0.5, 4).collect()}
    assert got == _dbscan_numpy(keys2, X2, 0.5, 4)


@pytest.mark.parametrize("include_self", [True, False])
def test_knn_with_hot_spot_matches_bruteforce(spark, pts, include_self):
    p, keys, X = pts
    n_hot = len(keys) // 2
    hot = spark.createDataFrame([(10_000_000 + i, [float(v) for v in X[3]]) for i in range(n_hot)], "key long, x array<double>")
    p2 = p.unionByName(hot)
    keys2 = np.concatenate([keys, 10_000_000 + np.arange(n_hot)])
    X2 = np.vstack([X, np.repeat(X[3:4], n_hot, axis=0)])
    D = np.sqrt(((X2[:, None, :] - X2[None, :, :]) ** 2).sum(-1))
    got = {}
    for r in knn(p2, "key", 6, include_self=include_self).collect():
        got.setdefault(r["key"], []).append((r["rank"], r["nbr"]))
    for i, k in enumerate(keys2):
        order = sorted((D[i, j], keys2[j]) for j in range(len(keys2)) if include_self or j != i)[:6]
        assert [n for _, n in sorted(got[int(k)])] == [int(n) for _, n in order], int(k)


def _centres_by_definition(X, ra, accept, reject, max_centres):
    """Potentials over all pairs; grey points are passed over one by one until the least level ends the search."""
    sq = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    left = np.exp(-4 / ra**2 * sq).sum(axis=1)
    level, chosen, passed = left.max(), [], np.zeros(len(X), bool)
    while len(chosen) < max_centres:
        best = int(np.where(passed, -1, left).argmax())
        if passed[best] or (chosen and left[best] < reject * level):
            break
        if chosen and left[best] <= accept * level:
            passed[best] = True
            continue
        chosen.append(best)
        left = np.maximum(left - left[best] * np.exp(-4 / (1.5 * ra) ** 2 * sq[best]), 0)
    return X[chosen]


def test_subtractive_with_hot_spot_matches_bruteforce(spark, pts):
    p, keys, X = pts
    n_hot = len(keys) // 2
    hot = spark.createDataFrame([(10_000_000 + i, [float(v) for v in X[7]]) for i in range(n_hot)], "key long, x array<double>")
    X2 = np.vstack([X, np.repeat(X[7:8], n_hot, axis=0)])
    _, centres = cl.subtractive(p.unionByName(hot), "key", ra=1.0, accept=0.4, reject=0.15, max_centres=10)
    ref = _centres_by_definition(X2, 1.0, 0.4, 0.15, 10)
    assert len(centres) == len(ref)
    assert np.allclose(np.array(centres), ref, atol=1e-9)


def test_knn_between_with_hot_spot_matches_bruteforce(spark, pts):
    p, keys, X = pts
    train_idx = [i for i in range(len(keys)) if i % 3 != 0]
    test_idx = [i for i in range(len(keys)) if i % 3 == 0]
    n_hot = len(keys)
    hot_keys = 10_000_000 + np.arange(n_hot)
    train = spark.createDataFrame(
        [(int(keys[i]), [float(v) for v in X[i]]) for i in train_idx]
        + [(int(h), [float(v) for v in X[1]]) for h in hot_keys], "key long, x array<double>")
    test = spark.createDataFrame([(int(keys[i]), [float(v) for v in X[i]]) for i in test_idx], "key long, x array<double>")
    from tessera.operators.distance import knn_between
    got = {}
    for r in knn_between(test, train, "key", 5).collect():
        got.setdefault(r["key"], []).append((r["rank"], r["nbr"]))
    TK = np.concatenate([keys[train_idx], hot_keys])
    TX = np.vstack([X[train_idx], np.repeat(X[1:2], n_hot, axis=0)])
    for i in test_idx:
        d = np.sqrt(((TX - X[i]) ** 2).sum(1))
        order = sorted(zip(d, TK))[:5]
        assert [n for _, n in sorted(got[int(keys[i])])] == [int(n) for _, n in order]


def test_knn_pairs_per_point_stay_flat_on_a_tight_blob(spark, monkeypatch):
    """95 % of the points in a blob a thousandth as wide as the rest: the leaves' pairs grow with n, not n^2."""
    from tessera.operators import distance as di
    per_point = []
    for n in (500, 2000):
        rng = np.random.default_rng(n)
        X = np.where(rng.random((n, 1)) < 0.95, rng.normal(size=(n, 3)) * 1e-3, rng.normal(size=(n, 3)))
        df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(X)], "key long, x array<double>")
        cuts = []
        with monkeypatch.context() as m:
            m.setattr(di, "cut_lineage", lambda d, f=di.cut_lineage: cuts.append(f(d)) or cuts[-1])
            got = {(r["key"], r["rank"]): r["dist"] for r in knn(df, "key", 5).collect()}
        D = np.sort(np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)), axis=1)
        assert np.allclose([[got[i, k + 1] for k in range(5)] for i in range(n)], D[:, :5])
        states = [c for c in cuts if "near" in c.columns]
        per_point.append(max(c.count() for c in states) / n)
    assert per_point[1] < 1.5 * per_point[0] + 2 and per_point[1] * di.LEAF < 400


@pytest.mark.parametrize("seed, eps, min_samples", [(1, 0.3, 5), (2, 0.05, 3), (3, 1.5, 10)])
def test_dbscan_on_blobs_gaps_and_lattices(spark, seed, eps, min_samples):
    """Clusters a hair more or less than eps apart, a lattice whose spacing is eps, and tight blobs."""
    rng = np.random.default_rng(seed)
    X = np.concatenate([rng.normal(size=(60, 2)) * eps / 20, rng.normal(size=(60, 2)) * eps / 20 + [1.05 * eps, 0], rng.normal(size=(40, 2)) * 5,
                        np.stack(np.meshgrid(np.arange(5), np.arange(5)), -1).reshape(-1, 2) * eps + 20, rng.random((80, 2)) * 4 * eps - 30])
    keys = np.arange(len(X)) * 3
    df = spark.createDataFrame([(int(k), [float(v) for v in r]) for k, r in zip(keys, X)], "key long, x array<double>")
    got = {r["key"]: (r["cluster"], r["kind"]) for r in cl.dbscan(df, "key", eps, min_samples).collect()}
    assert got == _dbscan_numpy(keys, X, eps, min_samples)


def test_dbscan_forms_no_pairs_of_dense_points(spark, monkeypatch):
    """Points in neighbouring dense cells: every table stays within a few rows per point as n grows."""
    for n in (500, 2000):
        rng = np.random.default_rng(n)
        df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rng.random((n, 3)))], "key long, x array<double>")
        cuts = []
        with monkeypatch.context() as m:
            m.setattr(cl, "cut_lineage", lambda d, f=cl.cut_lineage: cuts.append(f(d)) or cuts[-1])
            assert {r["cluster"] for r in cl.dbscan(df, "key", 1.0, 5).select("cluster").distinct().collect()} == {0}
        assert max(c.count() for c in cuts) <= 3 * n


def test_dbscan_of_nothing(spark):
    assert cl.dbscan(spark.createDataFrame([], "key long, x array<double>"), "key", 1.0, 3).count() == 0
    one = cl.dbscan(spark.createDataFrame([(1, [0.0]), (2, [5.0])], "key long, x array<double>"), "key", 1.0, 3)
    assert {(r["key"], r["cluster"], r["kind"]) for r in one.collect()} == {(1, -1, "noise"), (2, -1, "noise")}


@pytest.mark.parametrize("kind", ["even", "blob", "columns"])
def test_nearest_in_many_blocks_matches_bruteforce(spark, monkeypatch, kind):
    """Blocks of some 64 points: neighbours lie in other blocks, coordinates are shared, one place is crowded."""
    from tessera.operators import distance as di
    monkeypatch.setattr(di, "BLOCK", 64)
    rng = np.random.default_rng(5)
    X = rng.normal(size=(1200, 3))
    if kind == "blob":
        X = np.where(rng.random((1200, 1)) < 0.9, X * 1e-3, X)
    if kind == "columns":
        X = np.round(X * [1, 2, 3]) / 2
    X[:40] = X[0]
    keys = rng.permutation(1200)
    df = spark.createDataFrame([(int(k), [float(v) for v in r]) for k, r in zip(keys, X)], "key long, x array<double>").repartition(5)
    lost = spark.createDataFrame([(5000, [0.0, None, 0.0]), (5001, [0.0, float("nan"), 0.0])], "key long, x array<double>")
    got = {}
    for r in knn(df.unionByName(lost), "key", 7, include_self=False).collect():
        got.setdefault(r["key"], []).append((r["rank"], r["nbr"], r["dist"]))
    assert set(got) == set(keys.tolist())
    for i in range(1200):
        d = np.sqrt(((X - X[i]) ** 2).sum(1))
        d[i] = np.inf
        at = np.lexsort((keys, d))[:7]
        assert [n for _, n, _ in sorted(got[int(keys[i])])] == keys[at].tolist() and np.allclose([v for _, _, v in sorted(got[int(keys[i])])], d[at])


def test_subtractive_in_tiles_forms_no_pairs(spark, pts, monkeypatch):
    """Potentials of several tiles are those of all pairs, and no table holds more rows than there are points."""
    p, keys, X = pts
    monkeypatch.setattr(cl, "TILE", 70)
    cuts = []
    monkeypatch.setattr(cl, "cut_lineage", lambda d, f=cl.cut_lineage: cuts.append(f(d)) or cuts[-1])
    monkeypatch.setattr("tessera.operators.distance.eps_pairs", None)
    _, centres = cl.subtractive(p, "key", ra=1.0, accept=0.4, reject=0.15, max_centres=10)
    assert np.allclose(np.array(centres), _centres_by_definition(X, 1.0, 0.4, 0.15, 10), atol=1e-9)
    got = {r["key"]: r["__p"] for r in cuts[1].collect()}
    want = np.exp(-4.0 * ((X[:, None] - X[None]) ** 2).sum(-1)).sum(1)
    assert len(got) <= len(keys) and all(abs(got[int(k)] - v) < 1e-9 * v for k, v in zip(keys, want) if int(k) in got)
