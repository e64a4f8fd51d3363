"""The label diagnosis forms no more rows, pairs and halvings than its points ask for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cluster as cl
from tessera.operators import distance as di
from tessera.operators import labels as lb


@pytest.mark.parametrize("given", [False, True])
def test_block_search_sorts_little_more_than_the_neighbours(monkeypatch, given):
    """Lines of far points among lattices: cells are long, and most of them lie within the first bounds."""
    rng = np.random.default_rng(1)
    y = np.stack([rng.exponential(size=3000), np.round(rng.normal(size=3000) * 3) / 3, rng.normal(size=3000)], axis=1)
    y[::100] *= 50
    x, place, need = y[::2], rng.permutation(3000), 21
    d = di._distances(x, y)
    r = np.sort(d, axis=1)[:, 400] if given else None
    sorted_rows, real = [], np.lexsort
    monkeypatch.setattr(di.np, "lexsort", lambda keys: sorted_rows.append(len(keys[0])) or real(keys))
    row, other, far = di._search(x, r, y, place, need)
    monkeypatch.undo()
    assert max(sorted_rows) < 2 * need * len(x)
    want = [np.lexsort((place, one))[:need] for one in d]
    assert (row == np.repeat(np.arange(len(x)), need)).all() and (other == np.concatenate(want)).all()
    assert (far == np.concatenate([one[w] for one, w in zip(d, want)])).all()


def _lof(X, keys, k):
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    nb = np.array([np.lexsort((keys, d))[:k] for d in D])
    far = np.take_along_axis(D, nb, 1)
    lrd = 1 / (np.maximum(far[nb, k - 1], far).mean(axis=1) + 1e-10)
    return dict(zip(keys.tolist(), lrd[nb].mean(axis=1) / lrd))


def test_lof_of_copies_takes_no_pairs(spark, monkeypatch):
    """Places of 30 copies beside places of few: scores by definition, and no table of k rows a point."""
    rng = np.random.default_rng(3)
    X = np.concatenate([np.repeat(rng.normal(size=(20, 3)), 30, axis=0), np.repeat(rng.normal(size=(30, 3)), 5, axis=0), rng.normal(size=(50, 3))])
    keys = rng.permutation(len(X))
    df = spark.createDataFrame([(int(k), [float(v) for v in r]) for k, r in zip(keys, X)], "key long, x array<double>")
    cuts = []
    monkeypatch.setattr(lb, "cut_lineage", lambda d, f=lb.cut_lineage: cuts.append(f(d)) or cuts[-1])
    got = {r["key"]: r["lof_score"] for r in lb.lof(df, "key", 10).collect()}
    want = _lof(X, keys, 10)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    assert max(c.count() for c in cuts) <= len(X)


def test_lof_pools_the_rows_of_a_repeated_key(spark):
    """Key 3 stands among copies and alone: its score follows all its rows, as it did when every pair was formed."""
    rows = [(i, [0.0, 0.0]) for i in range(6)] + [(3, [9.0, 0.0])] + [(i, [float(i), 1.0]) for i in range(10, 14)] + [(2, [0.0, 0.0])]
    got = {r["key"]: r["lof_score"] for r in lb.lof(spark.createDataFrame(rows, "key long, x array<double>"), "key", 3).collect()}
    assert sorted(got) == [*range(6), *range(10, 14)] and all(got[i] == 1.0 for i in (0, 1, 2, 4, 5))
    assert got[3] == pytest.approx(7398345638.49457) and got[10] == pytest.approx(1.0956250425161704)


def test_cells_that_links_join_are_not_halved(spark, monkeypatch):
    """An even cloud is one cluster by its cells' own links: open pairs inside it are not looked into."""
    rng = np.random.default_rng(4)
    X = np.concatenate([rng.random((3000, 3)), rng.random((500, 3)) + [5, 0, 0]])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(X)], "key long, x array<double>")
    cuts = []
    monkeypatch.setattr(cl, "cut_lineage", lambda d, f=cl.cut_lineage: cuts.append(f(d)) or cuts[-1])
    got = {r["key"]: r["cluster"] for r in cl.dbscan(df, "key", 0.6, 5).collect()}
    assert {got[i] for i in range(3000)} == {0} and {got[i] for i in range(3000, 3500)} == {1}
    assert not [c for c in cuts if "up" in c.columns]


def test_memberships_name_each_centre_once(spark):
    """A column named inside a lambda is worked out for every element: distances are asked for once a row."""
    centres = [[0.125, 1.0], [2.0, 3.0], [0.0, 5.0]]
    u = cl.memberships(F.col("x"), centres, 1.3)
    assert str(u).count("0.125") == 1
    rows = [(0, [0.125, 1.0]), (1, [1.0, 2.0])]
    got = {r["key"]: r["u"] for r in spark.createDataFrame(rows, "key long, x array<double>").select("key", u.alias("u")).collect()}
    assert got[0] == [1.0, 0.0, 0.0]
    d = np.sqrt(((np.array([1.0, 2.0]) - np.array(centres)) ** 2).sum(axis=1))
    inv = (d.min() / d) ** (2 / 0.3)
    assert np.allclose(got[1], inv / inv.sum())
