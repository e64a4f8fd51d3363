"""Supervised models, tuning and scoring (M1-M24) on ``pyspark.ml``.

Models are ``Pipeline``s (VectorAssembler + estimator).  Parameter
conventions that differ between libraries are translated here: logistic C
-> regParam = 1/(C n), ridge alpha -> regParam = alpha * std(y) / n, unlimited
tree depth -> 30.  Everything returned to the driver is bounded: parameter
maps, coefficients, importances, per-fold scores.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hash_unit, linear_class_round

MAX_DEPTH = 30  # Spark's limit; stands in for "unlimited"


def _estimator(kind: str, label: str, weight: str | None, n_rows: int | None, **p):
    common = {"featuresCol": "features", "labelCol": label}
    if weight and kind not in ("gbt_noweight",):
        common["weightCol"] = weight
    if kind == "tree":
        return DecisionTreeClassifier(maxDepth=min(p.get("max_depth") or MAX_DEPTH, MAX_DEPTH),
                                      minInstancesPerNode=p.get("min_samples_leaf", 1),
                                      impurity=p.get("criterion", "gini"), seed=p.get("seed", 42),
                                      maxBins=p.get("max_bins", 64), **common)
    if kind == "forest":
        return RandomForestClassifier(numTrees=p.get("n_estimators", 100),
                                      maxDepth=min(p.get("max_depth") or MAX_DEPTH, MAX_DEPTH),
                                      minInstancesPerNode=p.get("min_samples_leaf", 1),
                                      featureSubsetStrategy=p.get("max_features", "sqrt"),
                                      impurity=p.get("criterion", "gini"), seed=p.get("seed", 42),
                                      bootstrap=p.get("bootstrap", True), **common)
    if kind == "gbt":
        return GBTClassifier(maxIter=p.get("n_estimators", 100), maxDepth=p.get("max_depth", 3),
                             stepSize=p.get("learning_rate", 0.1), seed=p.get("seed", 42), **common)
    if kind == "logistic":
        c = p.get("C", 1.0)
        reg = 1.0 / (c * n_rows) if n_rows else 0.0
        return LogisticRegression(regParam=reg, elasticNetParam=0.0, standardization=False,
                                  maxIter=p.get("max_iter", 200), tol=1e-6, family="auto", **common)
    if kind == "svm":
        svc = LinearSVC(regParam=p.get("reg", 0.01), maxIter=p.get("max_iter", 200), featuresCol="features")
        return OneVsRest(classifier=svc, featuresCol="features", labelCol=label, **({"weightCol": weight} if weight else {}))
    if kind in ("linear", "ridge", "lasso"):
        kw = {"featuresCol": "features", "labelCol": label, "standardization": False}
        if weight:
            kw["weightCol"] = weight
        if kind == "linear":
            return LinearRegression(regParam=0.0, **kw)
        if kind == "ridge":
            return LinearRegression(regParam=p["reg_param"], elasticNetParam=0.0, **kw)
        return LinearRegression(regParam=p.get("alpha", 1.0), elasticNetParam=1.0, maxIter=1000, tol=1e-10, **kw)
    raise ValueError(kind)


def build_model(kind: str, features: Sequence[str], label: str, weight: str | None = None,
                n_rows: int | None = None, impute: bool = False, scale: bool = False,
                handle_invalid: str = "error", **params) -> Pipeline:
    """A Pipeline of [median imputer,] VectorAssembler, [standard scaler,] and the estimator ``kind``.

    All stages are fitted together, so inside cross-validation no fold's statistics reach another.
    A NULL or NaN feature raises unless ``impute`` fills it; rows are never left out silently.

    kinds: tree, forest, gbt (binary), logistic, svm (one-vs-rest linear), linear,
    ridge (pass ``reg_param`` from :func:`ridge_reg_param`), lasso.
    """
    features = list(features)
    stages: list = []
    if impute:
        stages.append(Imputer(inputCols=features, outputCols=[f"__i_{c}" for c in features], strategy="median", relativeError=1e-4))
        features = [f"__i_{c}" for c in features]
    stages.append(VectorAssembler(inputCols=features, outputCol="__raw" if scale else "features", handleInvalid=handle_invalid))
    if scale:
        stages.append(StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=[*stages, _estimator(kind, label, weight, n_rows, **params)])


def ridge_reg_param(df: DataFrame, label: str, alpha: float) -> float:
    """M6: Spark regParam equal to a closed-form ridge penalty alpha: alpha * std_pop(y) / n."""
    r = df.agg(F.stddev_pop(label).alias("s"), F.count(F.lit(1)).alias("n")).first()
    return alpha * r["s"] / r["n"]


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight) with weight = n / (k * n_c)  ('balanced'), over the rows that have a label."""
    c = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    w = Window.partitionBy()  # one row per class
    return c.select(label, (F.sum("__nc").over(w) / (F.count(F.lit(1)).over(w) * F.col("__nc"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """``df`` with its classes' balanced weights; rows without a label stay, with weight 0."""
    out = df.join(class_weights(df, label).withColumnRenamed("weight", name), label, "left")
    return out.withColumn(name, F.coalesce(name, F.lit(0.0)))


def predict(model: PipelineModel, df: DataFrame, key: str, label: str, classes: int | None = None,
            all_classes: bool = False) -> DataFrame:
    """(key, y, p[, prob][, probs]) -- prob = P(class 1) when the model exposes probabilities;
    ``all_classes`` adds the array of all of them."""
    out = model.transform(df)
    cols = [key, F.col(label).alias("y")]
    if "probability" in out.columns:
        cols.append(vector_to_array("probability")[1].alias("prob"))
        if all_classes:
            cols.append(vector_to_array("probability").alias("probs"))
    pred = F.col("prediction")
    if classes is not None and isinstance(model.stages[-1].__class__.__name__, str) and \
            model.stages[-1].__class__.__name__ == "LinearRegressionModel":
        pred = linear_class_round(F.col("prediction"), classes)
    return out.select(*cols, pred.cast("int").alias("p"))


# ---------------------------------------------------------------- tuning
def param_grid(est_kind: str, grid: Mapping[str, Sequence], base: Mapping | None = None) -> list[dict]:
    keys = list(grid)
    out = [{}]
    for k in keys:
        out = [dict(o, **{k: v}) for o in out for v in grid[k]]
    return [dict(base or {}, **o) for o in out]


REGRESSORS = ("linear", "ridge", "lasso")
SCORES = ("accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted", "recall_pos", "f1_pos", "r2")


def _folds(df: DataFrame, fold: str) -> list[tuple[int, int]]:
    """(fold id, rows outside it)."""
    n = {r[0]: r[1] for r in df.groupBy(fold).count().collect()}  # k fold ids
    return [(f, sum(n.values()) - n[f]) for f in sorted(n)]


def _fold_score(df, fold, f, n_rows, kind, features, label, params, metric, key, weight) -> float:
    from .metrics import model_metrics, regression_metrics
    m = build_model(kind, features, label, weight, n_rows=n_rows, **params).fit(df.where(F.col(fold) != f))
    test = df.where(F.col(fold) == f)
    if metric == "r2":
        return float(regression_metrics(m.transform(test).select(F.col(label).alias("y"), F.col("prediction").alias("yhat"))).first()["r2"])
    return float(model_metrics(predict(m, test, key, label), []).first()[metric])


def cv_scores(df: DataFrame, fold: str, kind: str, features, label: str, params: Mapping,
              metric: str = "f1_macro", key: str = "key", weight: str | None = None) -> DataFrame:
    """(fold, score) -- fit the whole pipeline on the other folds, score this fold.

    Class metrics regard every class that stands in labels or predictions; ``r2`` is for regressors.
    """
    if metric not in SCORES:
        raise ValueError(metric)
    rows = [(int(f), _fold_score(df, fold, f, n, kind, features, label, params, metric, key, weight)) for f, n in _folds(df, fold)]
    return df.sparkSession.createDataFrame(rows, "fold int, score double")


def grid_search(df: DataFrame, fold: str, kind: str, features, label: str, grid: Sequence[Mapping],
                metric: str = "f1_macro", key: str = "key", weight: str | None = None, parallelism: int = 4) -> DataFrame:
    """(params json, mean, std (ddof 0), rnk) over the given parameter maps.

    Folds are counted once; ``parallelism`` fits run at a time, each a Spark job of its own.
    """
    if metric not in SCORES:
        raise ValueError(metric)
    folds, grid = _folds(df, fold), [dict(g) for g in grid]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        scores = list(pool.map(lambda t: _fold_score(df, fold, t[1][0], t[1][1], kind, features, label, grid[t[0]], metric, key, weight),
                               [(i, f) for i in range(len(grid)) for f in folds]))
    rows = []
    for i, params in enumerate(grid):
        sc = scores[i * len(folds): (i + 1) * len(folds)]
        mean = sum(sc) / len(sc)
        rows.append((_json(params), mean, math.sqrt(sum((s - mean) ** 2 for s in sc) / len(sc))))
    res = df.sparkSession.createDataFrame(rows, "params string, mean double, std double")
    return res.withColumn("rnk", F.rank().over(Window.orderBy(F.col("mean").desc())))  # one row per candidate


def search_fit(df: DataFrame, fold: str, kind: str, features, label: str, grid: Sequence[Mapping],
               metric: str = "f1_macro", key: str = "key", weight: str | None = None) -> tuple[PipelineModel, dict, DataFrame]:
    """(best model fitted again on all rows, its parameters, the table of :func:`grid_search`)."""
    table = grid_search(df, fold, kind, features, label, grid, metric, key, weight)
    mean = {r["params"]: r["mean"] for r in table.collect()}  # one row per candidate
    best = max(grid, key=lambda g: mean[_json(g)])  # the first of equals
    return build_model(kind, features, label, weight, n_rows=df.count(), **best).fit(df), dict(best), table


def random_maps(dists: Mapping[str, tuple], n: int, seed: int = 42) -> list[dict]:
    """N parameter maps; ('loguniform', lo, hi) or ('choice', [...])."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        m = {}
        for k, spec in dists.items():
            if spec[0] == "loguniform":
                m[k] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
            elif spec[0] == "choice":
                m[k] = rng.choice(list(spec[1]))
            else:
                raise ValueError(spec[0])
        out.append(m)
    return out


def _json(d: Mapping) -> str:
    import json
    return json.dumps({k: (round(v, 10) if isinstance(v, float) else v) for k, v in sorted(d.items())})


def param_sweep(train: DataFrame, test: DataFrame, kind: str, features, label: str, name: str,
                values: Sequence, key: str = "key", **base) -> DataFrame:
    """(value, accuracy) for each value of parameter ``name``."""
    from .metrics import accuracy
    rows = []
    for v in values:
        m = build_model(kind, features, label, **dict(base, **{name: v})).fit(train)
        rows.append((float(v), float(accuracy(predict(m, test, key, label)).first()[0])))
    return train.sparkSession.createDataFrame(rows, "value double, accuracy double")


# ---------------------------------------------------------------- inspection
def importance(model: PipelineModel, names: Sequence[str], k: int | None = None) -> DataFrame:
    """(feature, importance, rnk) ranked, importance > 0."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = sorted([(n, float(v)) for n, v in zip(names, imp) if v > 0], key=lambda t: (-t[1], t[0]))
    rows = [(n, v, i + 1) for i, (n, v) in enumerate(rows)][:k]
    return _spark_of(model).createDataFrame(rows, "feature string, importance double, rnk int")


def coef_importance(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """(feature, importance) = mean |coefficient| over classes."""
    lm = model.stages[-1]
    mat = lm.coefficientMatrix.toArray() if hasattr(lm, "coefficientMatrix") else [lm.coefficients.toArray()]
    rows = [(n, float(sum(abs(r[j]) for r in mat) / len(mat))) for j, n in enumerate(names)]
    return _spark_of(model).createDataFrame(rows, "feature string, importance double")


def tree_rules(model: PipelineModel) -> DataFrame:
    """(line_no, rule) of the fitted tree, plus depth and leaf count on every row."""
    t = model.stages[-1]
    lines = t.toDebugString.splitlines()
    leaves = (t.numNodes + 1) // 2
    return _spark_of(model).createDataFrame([(i, ln, t.depth, leaves) for i, ln in enumerate(lines)],
                                            "line_no int, rule string, depth int, n_leaves int")


def _spark_of(_model):
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


# ---------------------------------------------------------------- bagging extras
def poisson1(u):
    """Poisson(1) draw from a uniform column by inverse CDF, down to the last term that a double tells apart."""
    cdf, p, k, expr = 0.0, math.exp(-1.0), 0, None
    while cdf + p > cdf:
        cdf += p
        expr = F.when(u < F.lit(cdf), F.lit(float(k))) if expr is None else expr.when(u < F.lit(cdf), F.lit(float(k)))
        k += 1
        p /= k
    return expr.otherwise(F.lit(float(k)))


def oob_score(df: DataFrame, key: str, features, label: str, n_trees: int = 25, seed: int = 42,
              **tree_params) -> tuple[DataFrame, DataFrame]:
    """Out-of-bag accuracy of a bagged forest; returns (score row, per-row OOB votes).

    Tree b trains on Poisson(1) bootstrap weights from md5(key, seed + b);
    rows with weight 0 are out of bag for that tree and get its vote.
    """
    votes = None
    for b in range(n_trees):
        w = poisson1(hash_unit(key, seed + b))
        d = df.withColumn("__w", w)
        m = build_model("forest", features, label, weight="__w", n_estimators=1,
                        seed=seed + b, bootstrap=False, **tree_params)
        fit = m.fit(d.where(F.col("__w") > 0))
        oob = fit.transform(d.where(F.col("__w") == 0)).select(key, F.col("prediction").alias("vote"))
        votes = oob if votes is None else votes.unionByName(oob)
    agg = votes.groupBy(key, "vote").agg(F.count(F.lit(1)).alias("n"))
    best = agg.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("vote").alias("v"))).alias("b"))
    res = best.select(key, F.col("b.v").alias("oob_prediction")).join(df.select(key, label), key)
    score = res.agg(F.avg(F.when(F.col("oob_prediction") == F.col(label), 1.0).otherwise(0.0)).alias("oob_score"),
                    F.count(F.lit(1)).alias("n_scored"))
    return score, res


def score_batch(model: PipelineModel, df: DataFrame, key: str, tiers: Sequence[tuple[float, str]],
                positive: int = 1) -> DataFrame:
    """Key, p_0..p_k, prediction, action -- action from the first tier whose threshold the
    probability of class ``positive`` reaches (tiers sorted high -> low)."""
    out = model.transform(df)
    arr = vector_to_array("probability")
    k = model.stages[-1].numClasses
    prob1 = arr[positive]
    act = None
    for thr, name in sorted(tiers, key=lambda t: -t[0]):
        act = F.when(prob1 >= thr, F.lit(name)) if act is None else act.when(prob1 >= thr, F.lit(name))
    return out.select(key, *[arr[i].alias(f"p_{i}") for i in range(k)], F.col("prediction").cast("int").alias("prediction"),
                      act.alias("action"))


def overfit_gap(train_pred: DataFrame, test_pred: DataFrame, model_col: str = "model") -> DataFrame:
    """(model, train, test, gap) accuracy on both splits."""
    def acc(p):
        return p.groupBy(model_col).agg(F.avg(F.when(F.col("y") == F.col("p"), 1.0).otherwise(0.0)).alias("a"))
    tr = acc(train_pred).withColumnRenamed("a", "train")
    te = acc(test_pred).withColumnRenamed("a", "test")
    return tr.join(te, model_col).withColumn("gap", F.col("train") - F.col("test"))


def calibrate(train_scores: DataFrame, df: DataFrame, key: str, score: str = "prob", label: str = "y") -> DataFrame:
    """Isotonic calibration of a score: (key, p_calibrated)."""
    iso = IsotonicRegression(featuresCol=score, labelCol=label, predictionCol="p_calibrated").fit(train_scores)
    return iso.transform(df).select(key, "p_calibrated")


def knn_classify(train: DataFrame, test: DataFrame, key: str, k: int, x: str = "x", label: str = "label") -> DataFrame:
    """M8: (key, prediction) = majority label of the k nearest training points (ties -> smallest label)."""
    from .distance import knn_between
    nb = knn_between(test.select(key, x), train.select(F.col(key), x), key, k, x)
    lab = train.select(F.col(key).alias("nbr"), F.col(label).alias("__l"))
    votes = nb.join(lab, "nbr").groupBy(key, "__l").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("k"), F.col("__l").alias("v"))).alias("b"))
    return best.select(key, F.col("b.v").alias("prediction"))
