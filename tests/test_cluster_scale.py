"""Shared-scan Lloyd, Ward's chains, block-wise validation and projected neighbours against their definitions."""

import numpy as np
import pytest

from tessera.operators import cluster as cl
from tessera.operators import lloyd as ll
from tessera.operators import projected_knn as pk


def frame(spark, X):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(X)], "key long, x array<double>").repartition(5)


def test_lloyd_rounds_follow_the_definition(spark):
    rng = np.random.default_rng(1)
    X = np.concatenate([rng.normal(size=(200, 2)) + c for c in ([0, 0], [5, 5], [0, 6])])
    starts = [X[:3], X[[0, 250, 500]], X[:6], np.concatenate([X[:2], [[99.0, 99.0]]])]
    got = ll.lloyd(frame(spark, X), starts, rounds=4)
    for start, (centres, cost, n) in zip(starts, got):
        c = np.array(start)
        for _ in range(4):
            who = ((X[:, None] - c[None]) ** 2).sum(-1).argmin(1)
            c = np.array([X[who == j].mean(0) if (who == j).any() else c[j] for j in range(len(c))])
        assert np.allclose(centres, c) and n == 4
        assert cost == pytest.approx(((X[:, None] - c[None]) ** 2).sum(-1).min(1).sum())


def test_kmeans_finds_planted_clusters_in_shared_scans(spark, monkeypatch):
    rng = np.random.default_rng(7)
    X = np.concatenate([rng.normal(size=(150, 2)) * 0.3 + c for c in ([0, 0], [6, 0], [0, 6], [6, 6])])
    scans, real = [], ll._pass
    monkeypatch.setattr(ll, "_pass", lambda pts, centres: scans.append(len(centres)) or real(pts, centres))
    labels, centres, cost = cl.kmeans(frame(spark, X), "key", 4, n_init=15)
    assert scans[0] == 15 and len(scans) < 60
    who = {r["key"]: r["cluster"] for r in labels.collect()}
    assert all(len({who[i] for i in range(s, s + 150)}) == 1 for s in range(0, 600, 150)) and len(set(who.values())) == 4
    assert cost == pytest.approx(sum(((X[s: s + 150] - X[s: s + 150].mean(0)) ** 2).sum() for s in range(0, 600, 150)))
    sweep = {r["k"]: r for r in cl.elbow_sweep(frame(spark, X), "key", [1, 2, 4], n_init=5).collect()}
    assert sweep[1]["silhouette"] is None and sweep[1]["inertia"] == pytest.approx(((X - X.mean(0)) ** 2).sum()) and sweep[4]["inertia"] == pytest.approx(cost)


def test_lloyd_with_a_hot_location_and_fewer_points_than_centres(spark):
    X = np.array([[1.0, 1.0]] * 300 + [[2.0, 2.0]])
    labels, centres, cost = cl.kmeans(frame(spark, X), "key", 3, n_init=3)
    assert cost == 0 and len({r["cluster"] for r in labels.collect()}) == 2
    with pytest.raises(ValueError, match="no points"):
        cl.kmeans(frame(spark, X).limit(0), "key", 2)


@pytest.mark.parametrize("seed", range(4))
def test_ward_chains_equal_exhaustive_merging(seed):
    rng = np.random.default_rng(seed)
    c, w = rng.normal(size=(40, 3)), rng.integers(1, 20, 40).astype(float)
    groups, costs = {i: ([i], c[i], w[i]) for i in range(40)}, []
    while len(groups) > 1:
        ids = sorted(groups)
        paid, a, b = min((groups[a][2] * groups[b][2] / (groups[a][2] + groups[b][2]) * ((groups[a][1] - groups[b][1]) ** 2).sum(), a, b)
                         for i, a in enumerate(ids) for b in ids[i + 1:])
        one, two = groups.pop(a), groups.pop(b)
        both = one[2] + two[2]
        groups[a] = (one[0] + two[0], (one[1] * one[2] + two[1] * two[2]) / both, both)
        costs.append((a, b, paid))
    got = cl.ward_merges(c, w)
    assert [g[:2] for g in got] == [g[:2] for g in costs]
    assert np.allclose([g[2] for g in got], [g[2] for g in costs])


def test_ward_of_separate_blobs(spark):
    rng = np.random.default_rng(3)
    X = np.concatenate([rng.normal(size=(120, 2)) * 0.4 + c for c in ([0, 0], [8, 0], [4, 9])])
    who = {r["key"]: r["cluster"] for r in cl.ward(frame(spark, X), "key", 3).collect()}
    assert [who[0], who[120], who[240]] == [0, 1, 2] and all(who[i] == i // 120 for i in who)


@pytest.mark.parametrize("block", [512, 3])
def test_davies_bouldin_in_blocks(spark, block):
    rng = np.random.default_rng(5)
    X, lab = rng.normal(size=(300, 2)) * 3, rng.integers(-1, 9, 300)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(lab)], "key long, cluster int")
    got = cl.davies_bouldin(frame(spark, X), labels, "key", block=block).first()[0]
    c = np.array([X[lab == j].mean(0) for j in range(9)])
    s = np.array([np.sqrt(((X[lab == j] - c[j]) ** 2).sum(1)).mean() for j in range(9)])
    want = np.mean([max((s[i] + s[j]) / np.sqrt(((c[i] - c[j]) ** 2).sum()) for j in range(9) if j != i) for i in range(9)])
    assert got == pytest.approx(want)
    assert cl.davies_bouldin(frame(spark, X), labels.where("cluster < 1"), "key").first()[0] is None


@pytest.mark.parametrize("kind", ["even", "clustered", "copies"])
def test_projected_neighbours_reach_their_recall(spark, kind):
    rng = np.random.default_rng(11)
    X = rng.normal(size=(1500, 40))
    if kind == "clustered":
        X = rng.normal(size=(12, 40))[rng.integers(0, 12, 1500)] * 3 + 0.3 * X
    if kind == "copies":
        X[300:900] = X[0]  # many more copies than a block holds
    got, seen = pk.knn_projected(frame(spark, X), "key", 8)
    rows = got.collect()
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    far = np.sort(D, axis=1)[:, 7]
    assert all(abs(r["dist"] - D[r["key"], r["nbr"]]) < 1e-9 and r["key"] != r["nbr"] for r in rows)
    hit = np.zeros(len(X))
    for r in rows:
        hit[r["key"]] += r["dist"] <= far[r["key"]] * (1 + 1e-9)
    assert seen >= 0.9 and np.minimum(hit, 8).mean() / 8 > 0.87
    ranks = {}
    for r in rows:
        ranks.setdefault(r["key"], []).append((r["rank"], r["dist"]))
    assert all([a for a, _ in sorted(v)] == list(range(1, len(v) + 1)) and [d for _, d in sorted(v)] == sorted(d for _, d in v) for v in ranks.values())


def test_projected_neighbours_of_few_points_and_unreachable_recall(spark, monkeypatch):
    assert pk.knn_projected(frame(spark, np.zeros((0, 3))), "key", 2)[0].count() == 0
    got, seen = pk.knn_projected(frame(spark, np.array([[0.0, 0.0], [1.0, 0.0], [5.0, 0.0]])), "key", 5)
    assert seen == 1.0 and {(r["key"], r["nbr"]) for r in got.collect()} == {(a, b) for a in range(3) for b in range(3) if a != b}
    monkeypatch.setattr(pk, "MOST_TREES", 1)
    rng = np.random.default_rng(1)
    with pytest.raises(RuntimeError, match="less than"):
        pk.knn_projected(frame(spark, rng.normal(size=(3000, 60))), "key", 5, recall=0.99, trees=1)


def test_projected_neighbours_of_points_without_structure_are_found_in_tiles(spark, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(pk, "TILE", 300)
    monkeypatch.setattr(pk, "MOST_TREES", 1)
    X = rng.normal(size=(1500, 60))
    X[700:720] = X[3]  # copies
    got, seen = pk.knn_projected(frame(spark, X), "key", 5, recall=0.99, trees=1, or_all=True)
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j), r + 1) for i in range(len(X)) for r, j in enumerate(np.lexsort((np.arange(len(X)), d[i]))[:5])}
    rows = got.collect()
    assert seen == 1.0 and {(r["key"], r["nbr"], r["rank"]) for r in rows} == want and len(rows) == len(want)
    assert all(abs(r["dist"] - d[r["key"], r["nbr"]]) < 1e-12 for r in rows)


def _measures_by_definition(X, lab, truth):
    pairs = [(i, j) for i in range(len(X)) for j in range(i)]
    a, b = (np.array([v[i] == v[j] for i, j in pairs], float) for v in (lab, truth))
    expected, most = a.sum() * b.sum() / len(pairs), (a.sum() + b.sum()) / 2
    entropy = lambda v: -sum(np.mean(v == c) * np.log(np.mean(v == c)) for c in set(v))
    both = np.array([100 * p + q for p, q in zip(lab, truth)])
    nmi = 2 * (entropy(lab) + entropy(truth) - entropy(both)) / (entropy(lab) + entropy(truth))
    kept, score = np.flatnonzero(lab >= 0), []
    for i in kept:
        to = {c: ((X[[j for j in kept if lab[j] == c and j != i]] - X[i]) ** 2).sum(1) for c in set(lab[kept])}
        own, other = to[lab[i]], min((d.mean() for c, d in to.items() if c != lab[i]), default=np.nan)
        score.append((other - own.mean()) / max(other, own.mean()) if len(own) else 0.0)
    return len(set(lab[kept])), ((a * b).sum() - expected) / (most - expected), nmi, np.mean(score)


def test_compare_clusterings_is_read_back_measure_by_measure(spark):
    """Four labellings in one plan of nested scalar subqueries waited for one another without end."""
    rng = np.random.default_rng(4)
    X, truth = rng.normal(size=(60, 2)) + np.repeat([[0, 0], [3, 0], [0, 3]], 20, axis=0), np.repeat([0, 1, 2], 20)
    labs = {"right": truth, "noisy": np.where(rng.random(60) < 0.2, -1, truth), "other": rng.integers(0, 4, 60), "one": np.where(np.arange(60) == 7, 1, 0)}
    as_frame = lambda v, name: spark.createDataFrame([(i, int(c)) for i, c in enumerate(v)], f"key long, {name} int")
    got = cl.compare_clusterings({n: as_frame(v, "cluster") for n, v in labs.items()}, as_frame(truth, "label"), frame(spark, X), "key")
    assert "scalar-subquery" not in got._jdf.queryExecution().analyzed().toString()
    assert got.dtypes == [("method", "string"), ("n_clusters", "int"), ("ari", "double"), ("nmi", "double"), ("silhouette", "double")]
    rows = got.collect()
    assert [r["method"] for r in rows] == list(labs)
    for r in rows:
        assert tuple(r)[1:] == pytest.approx(_measures_by_definition(X, labs[r["method"]], truth))
    alone = cl.compare_clusterings({"all": as_frame(truth * 0, "cluster")}, as_frame(truth, "label"), frame(spark, X), "key").first()
    assert alone["n_clusters"] == 1 and alone["silhouette"] is None
