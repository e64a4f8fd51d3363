"""Model queries (M1-M24).  Model outputs have no SQL twin; class weights do."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models as md
from ..operators.linear_search import linear_prediction, linear_search, log_uniform
from ..operators.metrics import binary_model_metrics, model_metrics, regression_metrics
from ..session import cut_lineage
from ..sources.tables import LABEL_CLASSES, load, rfm_cte, rfm_points
from ..functions.columns import hash_unit
from .common import R, hash_unit_sql, rounded
from .modelling import DOC_FEATURES, ORDER_FEATURES, doc_table, order_table
from .registry import query

FEATS = DOC_FEATURES


def _tt(spark, sf):
    t = doc_table(spark, sf)
    return t, t.where(F.col("split") == "train"), t.where(F.col("split") == "test")


def _fit_predict(spark, sf, kind, label="y", **params):
    t, train, test = _tt(spark, sf)
    n = train.count()
    m = md.build_model(kind, FEATS, label, n_rows=n, **params).fit(train)
    return md.predict(m, test, "key", "y", classes=2 if kind == "linear" else None)


@query("model_tree")
def q_model_tree(spark, sf):
    return _fit_predict(spark, sf, "tree", max_depth=5, min_samples_leaf=5, criterion="gini")


@query("model_forest")
def q_model_forest(spark, sf):
    return _fit_predict(spark, sf, "forest", n_estimators=100, max_depth=8, max_features="sqrt")


@query("model_gbt")
def q_model_gbt(spark, sf):
    return _fit_predict(spark, sf, "gbt", n_estimators=100, max_depth=3, learning_rate=0.1)


@query("model_logistic")
def q_model_logistic(spark, sf):
    return _fit_predict(spark, sf, "logistic", C=1.0)


@query("model_linear_class")
def q_model_linear_class(spark, sf):
    return _fit_predict(spark, sf, "linear")


@query("model_svm")
def q_model_svm(spark, sf):
    return _fit_predict(spark, sf, "svm", reg=0.01)


def _regression(spark, sf, kind, **params):
    t = order_table(spark, sf)
    train, test = t.where(F.col("split") == "train"), t.where(F.col("split") == "test")
    if kind == "ridge":
        params = {"reg_param": md.ridge_reg_param(train, "y", params.get("alpha", 1.0))}
    m = md.build_model(kind, ORDER_FEATURES, "y", **params).fit(train)
    return m.transform(test).select("key", "y", F.col("prediction").alias("yhat"))


@query("model_ridge")
def q_model_ridge(spark, sf):
    return _regression(spark, sf, "ridge", alpha=1.0)


@query("model_lasso")
def q_model_lasso(spark, sf):
    return _regression(spark, sf, "lasso", alpha=10.0)


@query("regression_report")
def q_regression_report(spark, sf):
    out = None
    for kind, p in (("ridge", {"alpha": 1.0}), ("lasso", {"alpha": 10.0}), ("linear", {})):
        r = regression_metrics(_regression(spark, sf, kind, **p)).select(F.lit(kind).alias("model"), "*")
        out = r if out is None else out.unionByName(r)
    return out


@query("knn_classify", sql=f"""WITH {rfm_cte('duck')},
s AS (SELECT rz.*, t.label, {hash_unit_sql('rz.key', 13)} < 0.25 AS test FROM rz JOIN truth t ON t.key = rz.key),
n AS (SELECT a.key, b.label, row_number() OVER (PARTITION BY a.key ORDER BY sqrt((a.z0 - b.z0) * (a.z0 - b.z0) + (a.z1 - b.z1) * (a.z1 - b.z1)
             + (a.z2 - b.z2) * (a.z2 - b.z2)), b.key) AS r FROM s a JOIN s b ON a.test AND NOT b.test),
v AS (SELECT key, label, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, label) AS place FROM n WHERE r <= 7 GROUP BY key, label)
SELECT key, label AS prediction FROM v WHERE place = 1""")
def q_knn_classify(spark, sf):
    pts = cut_lineage(rfm_points(spark, sf).select("key", "x", "label", F.when(hash_unit("key", 13) < 0.25, "test").otherwise("train").alias("split")))
    return md.knn_classify(pts.where(F.col("split") == "train"), pts.where(F.col("split") == "test"), "key", 7)


@query("class_weights", sql=f"""
WITH c AS (SELECT quality, count(*) AS nc FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY quality)
SELECT quality AS y, {R('sum(nc) OVER () / (count(*) OVER () * nc)')} AS weight FROM c""")
def q_class_weights(spark, sf):
    t = doc_table(spark, sf)
    return rounded(md.class_weights(t, "y"))


@query("model_tree_balanced")
def q_model_tree_balanced(spark, sf):
    t, train, test = _tt(spark, sf)
    w = md.with_class_weights(train, "y")
    m = md.build_model("tree", FEATS, "y", weight="weight", max_depth=5).fit(w)
    return md.predict(m, test, "key", "y")


@query("grid_search")
def q_grid_search(spark, sf):
    _, train, _ = _tt(spark, sf)
    grid = md.param_grid("tree", {"max_depth": [2, 4, 6], "min_samples_leaf": [1, 5]})
    return md.grid_search(train, "fold", "tree", FEATS, "y", grid)


@query("random_search")
def q_random_search(spark, sf):
    _, train, _ = _tt(spark, sf)
    maps = md.random_maps({"C": ("loguniform", 1e-3, 1e2)}, 5, seed=42)
    return md.grid_search(train, "fold", "logistic", FEATS, "y", maps)


@query("cv_scores")
def q_cv_scores(spark, sf):
    _, train, _ = _tt(spark, sf)
    s = md.cv_scores(train, "fold", "forest", FEATS, "y", {"n_estimators": 20, "max_depth": 6})
    return s.agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), F.count(F.lit(1)).alias("folds"))


@query("leak_free_fit")
def q_leak_free_fit(spark, sf):
    """Imputer, scaler and logistic model as one pipeline, fitted on train rows with planted NULLs."""
    _, train, test = _tt(spark, sf)
    holes = [F.when(hash_unit("key", 31) < 0.1, F.lit(None)).otherwise(F.col(c)).alias(c) if c == "n_words" else F.col(c) for c in train.columns]
    m = md.build_model("logistic", FEATS, "y", n_rows=train.count(), impute=True, scale=True, C=1.0).fit(train.select(*holes))
    return md.predict(m, test.select(*holes), "key", "y")


RFM_FEATURES = ["z0", "z1", "z2"]


def _rfm_table(spark, sf):
    """Customer points with three classes: y (noisy label), y_true, split and fold; one customer in ten lacks z2."""
    index = F.array(*map(F.lit, LABEL_CLASSES))
    t = rfm_points(spark, sf).select(
        "key", "z0", "z1", F.when(hash_unit("key", 31) < 0.1, F.lit(None)).otherwise(F.col("z2")).alias("z2"),
        (F.array_position(index, F.col("label")) - 1).cast("int").alias("y"), (F.array_position(index, F.col("label_true")) - 1).cast("int").alias("y_true"),
        F.when(hash_unit("key", 13) < 0.25, "test").otherwise("train").alias("split"), F.floor(hash_unit("key", 17) * 4).cast("int").alias("fold"))
    return cut_lineage(t)


@query("multiclass_forest")
def q_multiclass_forest(spark, sf):
    """M2 on three classes, imputed inside the pipeline; every test row is scored."""
    t = _rfm_table(spark, sf)
    m = md.build_model("forest", RFM_FEATURES, "y", impute=True, n_estimators=50, max_depth=6).fit(t.where("split = 'train'"))
    return md.predict(m, t.where("split = 'test'"), "key", "y", all_classes=True)


@query("multiclass_search")
def q_multiclass_search(spark, sf):
    """Three-class tree tuned on weighted F1, then fitted again; scores of the best on the test rows."""
    t = _rfm_table(spark, sf)
    grid = md.param_grid("tree", {"max_depth": [2, 4, 8]}, {"impute": True, "scale": True})
    best, params, _ = md.search_fit(t.where("split = 'train'"), "fold", "tree", RFM_FEATURES, "y", grid, metric="f1_weighted")
    return model_metrics(md.predict(best, t.where("split = 'test'"), "key", "y"), [], range(len(LABEL_CLASSES))).withColumn("max_depth", F.lit(params["max_depth"]))


@query("multiclass_two_labels")
def q_multiclass_two_labels(spark, sf):
    """M23 on three classes: three models x two label sources, all judged on the true test labels."""
    t = _rfm_table(spark, sf)
    train, test, preds = t.where("split = 'train'"), t.where("split = 'test'"), None
    for source in ("y", "y_true"):
        for kind, p in (("tree", {"max_depth": 6}), ("logistic", {"C": 1.0, "n_rows": train.count()}), ("linear", {})):
            m = md.build_model(kind, RFM_FEATURES, source, impute=True, scale=True, **p).fit(train)
            one = md.predict(m, test, "key", "y_true", classes=len(LABEL_CLASSES) if kind == "linear" else None).select(F.lit(kind).alias("model"), F.lit(source).alias("label_source"), "y", "p")
            preds = one if preds is None else preds.unionByName(one)
    return model_metrics(preds, ["model", "label_source"], range(len(LABEL_CLASSES)))


@query("param_sweep")
def q_param_sweep(spark, sf):
    _, train, test = _tt(spark, sf)
    return md.param_sweep(train, test, "forest", FEATS, "y", "n_estimators", [5, 10, 25, 50], max_depth=6)


def _forest(spark, sf):
    t, train, test = _tt(spark, sf)
    return md.build_model("forest", FEATS, "y", n_estimators=50, max_depth=8).fit(train), t, train, test


@query("feature_importance")
def q_feature_importance(spark, sf):
    return md.importance(_forest(spark, sf)[0], FEATS, 10)


@query("coef_importance")
def q_coef_importance(spark, sf):
    _, train, _ = _tt(spark, sf)
    m = md.build_model("logistic", FEATS, "y", n_rows=train.count(), C=1.0).fit(train)
    return md.coef_importance(m, FEATS)


@query("tree_rules")
def q_tree_rules(spark, sf):
    _, train, _ = _tt(spark, sf)
    return md.tree_rules(md.build_model("tree", FEATS, "y", max_depth=4).fit(train))


@query("oob_score")
def q_oob_score(spark, sf):
    _, train, _ = _tt(spark, sf)
    return md.oob_score(train, "key", FEATS, "y", n_trees=15, max_depth=8)[0]


@query("score_batch")
def q_score_batch(spark, sf):
    m, _, _, test = _forest(spark, sf)
    return md.score_batch(m, test, "key", [(0.8, "approve"), (0.5, "review"), (0.0, "reject")])


@query("overfit_gap")
def q_overfit_gap(spark, sf):
    t, train, test = _tt(spark, sf)
    n = train.count()
    trp, tep = None, None
    for kind, p in (("tree", {"max_depth": 8}), ("forest", {"n_estimators": 30, "max_depth": 8}),
                    ("logistic", {"C": 1.0})):
        m = md.build_model(kind, FEATS, "y", n_rows=n, **p).fit(train)
        a = md.predict(m, train, "key", "y").select(F.lit(kind).alias("model"), "y", "p")
        b = md.predict(m, test, "key", "y").select(F.lit(kind).alias("model"), "y", "p")
        trp = a if trp is None else trp.unionByName(a)
        tep = b if tep is None else tep.unionByName(b)
    return md.overfit_gap(trp, tep)


@query("train_two_labels_ml")
def q_train_two_labels_ml(spark, sf):
    """Three models x two label sources, all tested on the original test labels."""
    t, train, test = _tt(spark, sf)
    n = train.count()
    preds = None
    for src, col in (("original", "y"), ("corrected", "y_corrected")):
        for kind, p in (("tree", {"max_depth": 6}), ("logistic", {"C": 1.0}), ("linear", {})):
            m = md.build_model(kind, FEATS, col, n_rows=n, **p).fit(train)
            pr = md.predict(m, test, "key", "y", classes=2 if kind == "linear" else None)
            pr = pr.select(F.lit(kind).alias("model"), F.lit(src).alias("label_source"), "y", "p")
            preds = pr if preds is None else preds.unionByName(pr)
    return binary_model_metrics(preds, ["model", "label_source"])


@query("calibrate")
def q_calibrate(spark, sf):
    m, _, train, test = _forest(spark, sf)
    tr = md.predict(m, train, "key", "y")
    return md.calibrate(tr, md.predict(m, test, "key", "y"), "key")


SEARCH_ALPHAS = {"ridge": log_uniform(1e3, 1e6, 20, seed=42), "lasso": log_uniform(1e1, 1e4, 20, seed=42)}


def _search_rows(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select(F.col("l_extendedprice").alias("y"), F.col("l_quantity").cast("double").alias("a"), F.col("l_discount").cast("double").alias("b"),
                     (F.col("l_orderkey") % 5).alias("fold"))


def _search_sql(kind: str) -> str:
    """The whole search row by row: each penalty's fit on four folds in closed form, its R^2 on the fifth."""
    two = kind == "ridge"
    alphas = ", ".join(f"(CAST({a!r} AS DOUBLE))" for a in SEARCH_ALPHAS[kind])
    if two:
        coef = """(q1 * (1 + alpha / n) - rho * q2) / ((1 + alpha / n) * (1 + alpha / n) - rho * rho) / sa AS ca,
                  (q2 * (1 + alpha / n) - rho * q1) / ((1 + alpha / n) * (1 + alpha / n) - rho * rho) / sb AS cb"""
    else:
        coef = "sign(q1) * greatest(abs(q1) - alpha, 0) / sa AS ca, 0.0 AS cb"
    return f"""WITH r AS (SELECT l_extendedprice AS y, CAST(l_quantity AS DOUBLE) AS a, CAST(l_discount AS DOUBLE) AS b, l_orderkey % 5 AS fold FROM lineitem),
f AS (SELECT DISTINCT fold FROM r), al(alpha) AS (VALUES {alphas}),
t AS (SELECT f.fold, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, stddev_pop(a) AS sa, stddev_pop(b) AS sb, corr(a, b) AS rho,
             covar_pop(a, y) / stddev_pop(a) AS q1, covar_pop(b, y) / stddev_pop(b) AS q2 FROM f JOIN r ON r.fold <> f.fold GROUP BY f.fold),
m AS (SELECT fold, alpha, ma, mb, my, {coef} FROM t, al),
e AS (SELECT m.fold, alpha, 1 - sum(pow(y - my - ca * (a - ma) - cb * (b - mb), 2)) / (var_pop(y) * count(*)) AS r2 FROM m JOIN r ON r.fold = m.fold GROUP BY m.fold, alpha),
s AS (SELECT alpha, avg(r2) AS mean_r2, stddev_pop(r2) AS std_r2 FROM e GROUP BY alpha)
SELECT {R('alpha')} AS alpha, {R('mean_r2')} AS mean_r2, {R('std_r2')} AS std_r2, CAST(row_number() OVER (ORDER BY mean_r2 DESC, alpha) AS INTEGER) AS rnk FROM s"""


@query("ridge_search", sql=_search_sql("ridge"))
def q_ridge_search(spark, sf):
    """Twenty log-uniform penalties by five folds on R^2, from one scan."""
    return rounded(linear_search(_search_rows(spark, sf), ["a", "b"], "y", "fold", "ridge", SEARCH_ALPHAS["ridge"])[0])


@query("lasso_search", sql=_search_sql("lasso"))
def q_lasso_search(spark, sf):
    return rounded(linear_search(_search_rows(spark, sf), ["a"], "y", "fold", "lasso", SEARCH_ALPHAS["lasso"])[0])


@query("linear_search_refit")
def q_linear_search_refit(spark, sf):
    """Ridge and lasso on all order features, tuned on train rows, fitted again and judged on the test rows."""
    t, out = order_table(spark, sf), None
    train = t.where(F.col("split") == "train").withColumn("fold", F.col("key") % 5)
    for kind, alphas in SEARCH_ALPHAS.items():
        _, best = linear_search(train, ORDER_FEATURES, "y", "fold", kind, alphas)
        r = regression_metrics(t.where(F.col("split") == "test").select("y", linear_prediction(best).alias("yhat")))
        r = r.select(F.lit(kind).alias("model"), F.lit(best["alpha"]).alias("alpha"), "*")
        out = r if out is None else out.unionByName(r)
    return rounded(out)
