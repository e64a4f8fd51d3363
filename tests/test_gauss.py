"""Sums of Gaussians by cells against all pairs, and subtractive clustering over them."""

import numpy as np
import pyarrow as pa
import pytest

from tessera.operators import cluster as cl
from tessera.operators import gauss
from test_bruteforce import _centres_by_definition


def frame(spark, X, w=None):
    w = np.ones(len(X), int) if w is None else w
    rows = [(i, [float(v) for v in r], int(k)) for i, (r, k) in enumerate(zip(X, w))]
    return spark.createDataFrame(rows, "key long, x array<double>, __w long").repartition(5)


def blobs(seed, n, dims):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, dims)) * rng.choice([0.05, 0.4, 1.5], (n, 1)) + rng.integers(-2, 3, (n, 1))
    X[5], X[7], X[11:14] = 60.0, -33.3, X[:3] + 4.5  # alone, alone, and at the edge of what others reach
    return X


@pytest.mark.parametrize("dims, alpha", [(1, 4.0), (2, 0.7), (3, 4.0)])
def test_sums_by_cells_are_those_of_all_pairs(spark, monkeypatch, dims, alpha):
    X, w = blobs(dims, 700, dims), np.random.default_rng(9).integers(1, 50, 700)
    w[9] = 10 ** 6
    monkeypatch.setattr(gauss, "GROUP", 60)  # a cell's points are dealt over several tasks
    got = {r["key"]: r["__p"] for r in gauss.gauss_sums(frame(spark, X, w), "key", "__w", alpha).collect()}
    want = np.exp(-alpha * ((X[:, None] - X[None]) ** 2).sum(-1)) @ w
    assert len(got) == 700
    assert all(abs(got[i] - v) < 1e-10 * v and abs(got[i] - v) < 1e-12 * want.max() for i, v in enumerate(want))


def test_sums_along_a_line_of_many_stretches(spark):
    X = np.stack([np.arange(0, 300, 0.5), np.zeros(600)], axis=1)
    got = {r["key"]: r["__p"] for r in gauss.gauss_sums(frame(spark, X), "key", "__w", 1.0).collect()}
    want = np.exp(-((X[:, None] - X[None]) ** 2).sum(-1)).sum(1)
    assert np.allclose([got[i] for i in range(600)], want, rtol=1e-12, atol=0)


def test_sums_by_cells_are_left_to_pairs_where_they_cannot_be_laid_out(spark, monkeypatch):
    for X in ([[1.0, float("nan")], [0.0, 0.0]], [[1.0], [0.0, 0.0]], [[1e9, 0.0], [0.0, 0.0]]):
        assert gauss.gauss_sums(frame(spark, X), "key", "__w", 4.0) is None
    assert gauss.gauss_sums(frame(spark, [[1.0, 2.0]]).limit(0), "key", "__w", 4.0) is None
    thin = frame(spark, np.arange(60).reshape(20, 3) * 50.0)
    assert gauss.gauss_sums(thin, "key", "__w", 4.0) is not None
    monkeypatch.setattr(gauss, "ROOM", 10 * gauss.NODES ** 3)
    assert gauss.gauss_sums(thin, "key", "__w", 4.0) is None


def test_subtractive_of_many_locations_forms_no_pairs(spark, monkeypatch):
    """Above ``FEW`` locations the centres are those by definition, without a tile."""
    X = blobs(21, 900, 3)
    X[300:420] = X[17]
    monkeypatch.setattr(cl, "FEW", 100)
    monkeypatch.setattr(cl, "_tile_potentials", None)
    labels, centres = cl.subtractive(frame(spark, X), "key", ra=1.0, accept=0.4, reject=0.15, max_centres=10)
    want = _centres_by_definition(X, 1.0, 0.4, 0.15, 10)
    assert len(centres) == len(want) > 1 and np.allclose(np.array(centres), want, atol=1e-9)
    near = ((X[:, None] - want[None]) ** 2).sum(-1).argmin(1)
    assert {r["key"]: r["cluster"] for r in labels.collect()} == dict(enumerate(near.tolist()))


def test_tiles_do_not_send_a_location_to_ever_more_tasks(spark, monkeypatch):
    """Where cells do not serve, a location goes to ``TILES`` tiles however many there are, as long as a tile stays in memory."""
    X = blobs(22, 500, 3)
    monkeypatch.setattr(cl, "FEW", 100)
    monkeypatch.setattr(gauss, "ROOM", 0)
    monkeypatch.setattr(gauss, "PER_POINT", 0)
    monkeypatch.setattr(cl, "TILE", 10)
    monkeypatch.setattr(cl, "TILES", 4)
    loc = frame(spark, X)
    with monkeypatch.context() as m:  # each tile tells how many rows it was sent
        m.setattr(cl, "_tile_sums", lambda alpha: lambda group: pa.table({"id": group["id"].slice(0, 1), "p": [float(group.num_rows)]}))
        assert sum(r["__p"] for r in cl._potentials(loc, "key", 4.0, "x").collect()) == 4 * 500
    got = {r["key"]: r["__p"] for r in cl._potentials(loc, "key", 4.0, "x").collect()}
    want = np.exp(-4.0 * ((X[:, None] - X[None]) ** 2).sum(-1)).sum(1)
    assert np.allclose([got[i] for i in range(500)], want, rtol=1e-9, atol=0)
    _, centres = cl.subtractive(loc, "key", ra=1.0, accept=0.4, max_centres=10)
    assert np.allclose(np.array(centres), _centres_by_definition(X, 1.0, 0.4, 0.15, 10), atol=1e-9)
