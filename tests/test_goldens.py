"""Numbers published by the reference, reproduced with our operators on literal rows."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import metrics as me
from tessera.operators import report as rp

# The reference's test-split scores (8 rows: y_true, prob, pred).
FINANCE_TEST = [(1, 1.0, 1), (1, 1.0, 1), (0, 0.7005802366375145, 1), (1, 0.7585415302354752, 1),
             (0, 1.0, 1), (1, 0.6666666666666666, 1), (1, 0.380621666822442, 1), (1, 0.8906462134979801, 1)]

# Supervised metrics table (model, label_source, accuracy, precision_macro,
# recall_macro, f1_macro, recall_pos, f1_pos).
SUPERVISED = [
    ("DecisionTree", "original", 0.67, 0.6582, 0.6561, 0.6406, 0.6732, 0.7199),
    ("LogisticRegression", "original", 0.7251, 0.7066, 0.7055, 0.6913, 0.662, 0.7448),
    ("LinearRegression", "original", 0.6763, 0.7041, 0.6722, 0.6512, 0.5662, 0.6955),
    ("DecisionTree", "corrected", 0.5723, 0.6177, 0.5799, 0.5572, 0.4732, 0.6022),
    ("LogisticRegression", "corrected", 0.6537, 0.6443, 0.6135, 0.6134, 0.569, 0.6847),
    ("LinearRegression", "corrected", 0.642, 0.649, 0.5482, 0.5441, 0.338, 0.4979),
]
METRICS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "recall_pos", "f1_pos"]


@pytest.fixture
def finance(spark):
    rows = [(i, y, p, d, "test") for i, (y, p, d) in enumerate(FINANCE_TEST)]
    return spark.createDataFrame(rows, "key int, y int, prob double, p int, split string")


def test_finance_split_report(finance):
    r = me.split_report(finance).first()
    assert r["n"] == 8 and r["prevalence"] == pytest.approx(0.75)
    assert r["roc_auc"] == pytest.approx(0.41666666666666663, abs=1e-9)
    assert r["pr_auc"] == pytest.approx(0.7246031746031746, abs=1e-9)
    assert r["brier"] == pytest.approx(0.256976717741419, abs=1e-9)
    assert r["log_loss"] == pytest.approx(4.87664280248795, abs=1e-6)
    assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (0, 2, 0, 6)
    assert r["precision"] == pytest.approx(0.75) and r["recall"] == pytest.approx(1.0)
    assert r["f1"] == pytest.approx(0.8571428571428571)


def test_movies_logistic_confusion(spark):
    # TN 83, FP 3, FN 11, TP 28 -> accuracy .888, F1 .80, precision .90, recall .72
    rows = [(0, 0)] * 83 + [(0, 1)] * 3 + [(1, 0)] * 11 + [(1, 1)] * 28
    pred = spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(rows)], "key int, y int, p int")
    assert me.accuracy(pred).first()[0] == pytest.approx(0.888)
    pc = {r["label"]: r for r in me.prf(pred, [0, 1]).collect()}
    assert pc[1]["precision"] == pytest.approx(28 / 31, abs=1e-3)
    assert round(pc[1]["recall"], 2) == 0.72 and round(pc[1]["f1"], 2) == 0.80
    cm = {r["actual"]: r for r in me.confusion_matrix(pred, [0, 1]).collect()}
    assert (cm[0]["0"], cm[0]["1"], cm[1]["0"], cm[1]["1"]) == (83, 3, 11, 28)


@pytest.fixture
def supervised(spark):
    rows = [(*r, i) for i, r in enumerate(SUPERVISED)]
    return spark.createDataFrame(rows, ["model", "label_source", *METRICS, "row_order"])


def test_comparison_verdict(supervised):
    v = rp.verdict_text(rp.verdict_counts(supervised, METRICS)).first()
    assert (v["improved"], v["degraded"], v["unchanged"], v["total"]) == (0, 18, 0, 18)
    assert v["verdict"] == "degraded"


def test_winners_and_ranking(supervised):
    w = rp.winners(supervised, METRICS)
    wins = {r["source"]: r["n"] for r in rp.wins_by_source(w).collect()}
    assert wins == {"original": 6}
    best = rp.ranking(supervised, "f1_macro").where("rnk = 1").first()
    assert (best["model"], best["label_source"]) == ("LogisticRegression", "original")


def test_delta_sign(supervised):
    d = {r["model"]: r for r in rp.delta(supervised, METRICS).collect()}
    assert d["LogisticRegression"]["accuracy"] == pytest.approx(0.6537 - 0.7251)
