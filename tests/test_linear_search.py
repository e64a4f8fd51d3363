"""Penalised fits from sufficient statistics against closed forms and row-by-row searches; encodings per file."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import linear_search as ls
from tessera.sources import io


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 4)) * [1, 10, 0.1, 0] + [5, -3, 0, 2]  # the last one is constant
    x[:, 1] += 3 * x[:, 0]
    y = 2 * x[:, 0] - 0.3 * x[:, 1] + 4 * x[:, 2] + rng.normal(size=900)
    fold = rng.integers(0, 5, 900)
    rows = [(*map(float, r), float(t), int(f)) for r, t, f in zip(x, y, fold)]
    return spark.createDataFrame(rows + [(1.0, 1.0, 1.0, 1.0, 99.0, None)], "a double, b double, c double, d double, y double, fold int").repartition(6), x, y, fold


def _objective(kind, x, y, b, b0, alpha):
    sd = x.std(axis=0)
    sse = ((y - b0 - x @ b) ** 2).sum()
    return sse + alpha * ((b * sd) ** 2).sum() if kind == "ridge" else sse / (2 * len(y)) + alpha * np.abs(b * sd).sum()


@pytest.mark.parametrize("kind, alphas", [("ridge", [1e-3, 10.0, 1e4]), ("lasso", [1e-4, 0.3, 50.0])])
def test_search_follows_the_definition(data, kind, alphas):
    df, x, y, fold = data
    table, best = ls.linear_search(df, ["a", "b", "c", "d"], "y", "fold", kind, alphas)
    got = {r["alpha"]: r for r in table.collect()}
    rng = np.random.default_rng(0)
    for alpha in alphas:
        scores = []
        for f in range(5):
            g = {k: v for k, v in ls.fold_products(df, ["a", "b", "c", "d"], "y", "fold").items()} if f == 0 else g
            b, b0 = ls.FITS[kind](sum(v for k, v in g.items() if k != f), alpha)
            tx, ty = x[fold != f], y[fold != f]
            # no small step from the fit lowers the objective of the training rows
            least = _objective(kind, tx, ty, b, b0, alpha)
            for _ in range(60):
                step = rng.normal(size=5) * rng.choice([1e-2, 1e-4])
                assert _objective(kind, tx, ty, b + step[:4] * [1, 1, 1, 0], b0 + step[4], alpha) >= least - 1e-9 * abs(least)
            vx, vy = x[fold == f], y[fold == f]
            scores.append(1 - ((vy - b0 - vx @ b) ** 2).sum() / ((vy - vy.mean()) ** 2).sum())
        assert got[alpha]["mean_r2"] == pytest.approx(np.mean(scores), abs=1e-9) and got[alpha]["std_r2"] == pytest.approx(np.std(scores), abs=1e-9)
    assert [r["rnk"] for r in sorted(got.values(), key=lambda r: -r["mean_r2"])] == [1, 2, 3]
    assert best["alpha"] == max(got.values(), key=lambda r: r["mean_r2"])["alpha"] and best["coefficients"]["d"] == 0.0
    fitted = df.where("fold is not null").select(F.sum(F.pow(F.col("y") - ls.linear_prediction(best), 2))).first()[0]
    assert 1 - fitted / ((y - y.mean()) ** 2).sum() == pytest.approx(best["r2"])


def test_one_scan_serves_all_penalties(data, monkeypatch):
    calls, real = [], ls.fold_products
    monkeypatch.setattr(ls, "fold_products", lambda *a: calls.append(1) or real(*a))
    ls.linear_search(data[0], ["a", "b"], "y", "fold", "ridge", ls.log_uniform(1e-3, 1e3, 20, 1))
    assert len(calls) == 1


def test_nulls_and_single_folds_are_refused(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (None, 1.0, 1)], "a double, y double, fold int")
    with pytest.raises(Exception, match="finite values"):
        ls.linear_search(df, ["a"], "y", "fold", "ridge", [1.0])
    with pytest.raises(ValueError, match="two folds"):
        ls.linear_search(df.where("fold = 0"), ["a"], "y", "fold", "ridge", [1.0])


def test_each_file_is_read_in_its_own_encoding(spark, tmp_path):
    folder = tmp_path / "in put"
    folder.mkdir()
    (folder / "one.csv").write_bytes("id,name\n1,café\n2,naïve\n".encode())
    (folder / "two.csv").write_bytes("id,name\n3,café\n4,plain\n".encode("latin-1"))
    (folder / "three.csv").write_bytes(b"id,name\n5,ascii\n")
    got = {r["id"]: r["name"] for r in io.read_csv(spark, str(folder)).collect()}
    assert got == {"1": "café", "2": "naïve", "3": "café", "4": "plain", "5": "ascii"}
    only = tmp_path / "only"
    only.mkdir()
    (only / "a.csv").write_bytes("id,prénom\n1,x\n".encode("latin-1"))
    assert io.read_csv(spark, str(only)).columns == ["id", "prénom"]
    assert io.read_csv(spark, str(only), schema="id int, n string").first()["id"] == 1
