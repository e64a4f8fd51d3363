"""Models on small made tables: closed forms, planted NULLs, three classes, pipelines inside cross-validation."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import features as fe
from tessera.operators import metrics as me
from tessera.operators import models as md


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 2))
    y = 1.5 + x @ np.array([2.0, -1.0]) + rng.normal(size=240) * 0.3
    c = np.digitize(x[:, 0] + 0.2 * rng.normal(size=240), [-0.5, 0.5])
    rows = [(i, float(a), float(b), float(t), int(k), int(k > 0), i % 4) for i, ((a, b), t, k) in enumerate(zip(x, y, c))]
    return spark.createDataFrame(rows, "key long, a double, b double, y double, c int, z int, fold int"), x, y, c


def _coef(model):
    return np.array([*model.stages[-1].coefficients.toArray(), model.stages[-1].intercept])


def test_ridge_and_lasso_equal_their_definitions(table):
    df, x, y, _ = table
    xc, yc = x - x.mean(axis=0), y - y.mean()
    got = _coef(md.build_model("ridge", ["a", "b"], "y", reg_param=md.ridge_reg_param(df, "y", 7.0)).fit(df))
    want = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(2), xc.T @ yc)
    assert np.allclose(got[:2], want, atol=1e-5)
    got = _coef(md.build_model("lasso", ["a", "b"], "y", alpha=0.4).fit(df))
    w = np.zeros(2)
    for _ in range(500):  # coordinate descent on |y - xw|^2 / 2n + alpha |w|_1
        for j in range(2):
            r = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / len(y)
            w[j] = np.sign(r) * max(abs(r) - 0.4, 0) / (xc[:, j] @ xc[:, j] / len(y))
    assert np.allclose(got[:2], w, atol=1e-4)


def test_logistic_equals_newton(table):
    df, x, _, c = table
    got = _coef(md.build_model("logistic", ["a", "b"], "z", n_rows=240, C=0.5).fit(df))
    t, xa, w = (c > 0).astype(float), np.column_stack([x, np.ones(240)]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-xa @ w))
        pen = np.diag([2.0, 2.0, 0.0])
        w -= np.linalg.solve(xa.T * (p * (1 - p)) @ xa + pen, xa.T @ (p - t) + pen @ w)
    assert np.allclose(got, w, atol=1e-3)


def test_no_row_is_lost(table):
    df = table[0].withColumn("a", F.when(F.col("key") % 12 == 0, None).when(F.col("key") % 12 == 1, float("nan")).otherwise(F.col("a")))
    m = md.build_model("forest", ["a", "b"], "c", impute=True, scale=True, n_estimators=5, max_depth=4).fit(df)
    assert md.predict(m, df, "key", "c").count() == 240
    assert md.score_batch(m, df, "key", [(0.0, "x")], positive=2).count() == 240
    with pytest.raises(Exception, match="(?i)null|nan|invalid"):
        md.predict(md.build_model("tree", ["a", "b"], "c", max_depth=2).fit(df), df, "key", "c").count()
    with pytest.raises(Exception, match="(?i)null|nan|invalid"):
        fe.pca_project(df.withColumn("a", F.when(F.col("key") < 9, None).otherwise(F.col("a"))), "key", ["a", "b"], 2)[0].count()


def test_three_classes(table):
    df = table[0]
    m = md.build_model("forest", ["a", "b"], "c", n_estimators=10, max_depth=5).fit(df)
    p = md.predict(m, df, "key", "c", all_classes=True).collect()
    assert all(len(r["probs"]) == 3 and abs(sum(r["probs"]) - 1) < 1e-9 for r in p)
    y, q = np.array([r["y"] for r in p]), np.array([r["p"] for r in p])
    got = me.model_metrics(df.sparkSession.createDataFrame([(int(a), int(b)) for a, b in zip(y, q)], "y int, p int"), []).first()
    f1, n = [], []
    for k in range(3):
        tp, fp, fn = ((y == k) & (q == k)).sum(), ((y != k) & (q == k)).sum(), ((y == k) & (q != k)).sum()
        f1.append(2 * tp / (2 * tp + fp + fn))
        n.append((y == k).sum())
    assert np.isclose(got["accuracy"], (y == q).mean()) and np.isclose(got["f1_macro"], np.mean(f1)) and np.isclose(got["f1_weighted"], np.dot(f1, n) / 240)


def test_metrics_count_every_class(spark):
    pred = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (None, 1), (0, None), (1, 1)], "y int, p int")
    got = me.binary_model_metrics(pred, []).first()
    assert np.isclose(got["accuracy"], 3 / 6) and got["recall_macro"] < 0.7
    long = {(r["actual"], r["predicted"]): r["n"] for r in me.confusion_long(pred, [0, 1]).collect()}
    assert sum(long.values()) == 6 and long[2, 1] == 1 and long[None, 1] == 1 and long[0, 1] == 0
    with pytest.raises(Exception, match="outside labels"):
        me.confusion_matrix(pred, [0, 1]).collect()


def test_search_returns_the_best_model(table):
    df = table[0]
    grid = md.param_grid("tree", {"max_depth": [1, 4]}, {"impute": True, "scale": True})
    best, params, res = md.search_fit(df, "fold", "tree", ["a", "b"], "c", grid, metric="f1_weighted")
    rows = {json.loads(r["params"])["max_depth"]: r for r in res.collect()}
    assert params["max_depth"] == 4 and rows[4]["rnk"] == 1 and rows[4]["mean"] > rows[1]["mean"]
    assert best.stages[-1].depth > 1
    by_hand = [r["score"] for r in md.cv_scores(df, "fold", "tree", ["a", "b"], "c", grid[1], metric="f1_weighted").collect()]
    assert len(by_hand) == 4 and np.isclose(np.mean(by_hand), rows[4]["mean"])
    r2 = md.grid_search(df, "fold", "ridge", ["a", "b"], "y", [{"reg_param": 0.001}, {"reg_param": 5.0}], metric="r2").orderBy("rnk").collect()
    assert json.loads(r2[0]["params"])["reg_param"] == 0.001 and r2[0]["mean"] > 0.9


def test_pipeline_statistics_come_from_the_training_folds(table):
    df = table[0].withColumn("a", F.when(F.col("fold") == 0, F.col("a") + 1000.0).otherwise(F.col("a")))
    m = md.build_model("logistic", ["a", "b"], "z", n_rows=180, impute=True, scale=True).fit(df.where("fold != 0"))
    assert abs(m.stages[2].mean[0]) < 1


def test_weighted_votes_and_calibration(table):
    df = table[0]
    w = md.with_class_weights(df, "c")
    assert w.count() == 240 and np.isclose(w.agg(F.sum("weight")).first()[0], 240)
    base = md.build_model("svm", ["a", "b"], "c", reg=0.01).fit(df)
    heavy = md.build_model("svm", ["a", "b"], "c", weight="w", reg=0.01).fit(df.withColumn("w", F.when(F.col("c") == 2, 50.0).otherwise(1.0)))
    said = [md.predict(m, df, "key", "c").where("p = 2").count() for m in (base, heavy)]
    assert said[1] > said[0]
    scores = df.select("key", F.col("a").alias("prob"), F.col("z").cast("double").alias("y"))
    cal = md.calibrate(scores, scores, "key").join(scores, "key").orderBy("prob").collect()
    p = [r["p_calibrated"] for r in cal]
    assert p == sorted(p) and np.isclose(np.mean(p), np.mean([r["y"] for r in cal]), atol=1e-6)


def test_poisson_terms(spark):
    uniform = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / float(1 << 40)
    got = spark.range(200000).select(md.poisson1(uniform).alias("k")).agg(F.avg("k"), F.var_samp("k")).first()
    assert abs(got[0] - 1) < 0.02 and abs(got[1] - 1) < 0.03
    assert spark.range(1).select(md.poisson1(F.lit(1.0 - 2**-53))).first()[0] > 14


def test_pca_of_two_columns_in_closed_form(table):
    df, x, _, _ = table
    proj, ev = fe.pca_project(df, "key", ["a", "b"], 2)
    r = np.corrcoef(x.T)[0, 1]
    assert np.allclose(sorted((q["explained_variance"] for q in ev.collect()), reverse=True), [(1 + abs(r)) / 2, (1 - abs(r)) / 2], atol=1e-6)
    assert proj.count() == 240


def test_sparse_one_hot(spark):
    df = spark.createDataFrame([(f"v{i:04d}",) for i in range(700)] + [(None,)], "s string")
    out, model = fe.one_hot_sparse(df, "s")
    got = {r["s"]: r["s_vec"] for r in out.collect()}
    assert len(got) == 701 and got["v0003"].size == 700 and list(got["v0003"].indices) == [3] and got[None].numNonzeros() == 0
    assert model.transform(spark.createDataFrame([("new",)], "s string")).first()["s_vec"].numNonzeros() == 0
