"""Metrics over classes that nobody listed, rows without a label, and one-vs-rest ranking."""

import numpy as np
import pytest

from tessera.operators import metrics as me
from tessera.operators.models import with_class_weights
from tessera.operators.order import previous_row


def test_totals_count_every_row(spark):
    rows = [(0, 0), (1, 1), (2, 0), (2, 2), (None, 1), (1, None), (0, 5)]
    pred = spark.createDataFrame(rows, "y int, p int")
    per = {r["label"]: r for r in me.prf(pred, [0, 1, 7]).collect()}
    assert sum(r["support"] for r in per.values()) == len(rows)
    assert set(per) == {0, 1, 2, 5, 7, None}
    assert (per[0]["precision"], per[0]["recall"]) == (0.5, 0.5) and per[2]["recall"] == 0.5 and per[2]["precision"] == 1.0 and per[7]["support"] == 0
    report = {r["label"]: r for r in me.classification_report(pred, [0, 1]).collect()}
    assert report["weighted avg"]["support"] == report["macro avg"]["support"] == len(rows)
    assert report["weighted avg"]["recall"] == pytest.approx(3 / 7)
    assert me.prf(spark.createDataFrame([], "y int, p int"), [0, 1]).count() == 2


def test_rows_without_a_label_rank_nothing(spark):
    rows = [(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.6), (None, 0.95), (None, 0.1)]
    got = me.ranking_metrics(spark.createDataFrame(rows, "y int, prob double")).first()
    want = me.ranking_metrics(spark.createDataFrame([r for r in rows if r[0] is not None], "y int, prob double")).first()
    assert got == want and got["roc_auc"] == 0.75


def test_class_weights_keep_rows_without_a_label(spark):
    got = with_class_weights(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "key int, y string"), "y").collect()
    assert {r["key"]: r["weight"] for r in got} == {1: 0.75, 2: 0.75, 3: 1.5, 4: 0.0}


def _auc(own, score):
    a, b = score[own], score[~own]
    return ((a[:, None] > b).sum() + 0.5 * (a[:, None] == b).sum()) / (len(a) * len(b))


def test_one_vs_rest_by_definition(spark):
    rng = np.random.default_rng(2)
    probs = np.round(rng.dirichlet([1, 1, 1], 400), 2)  # ties
    y = np.array(["a", "b", "c"])[(probs + rng.normal(size=probs.shape) * 0.4).argmax(axis=1)]
    rows = [(str(c), p.tolist()) for c, p in zip(y, probs)] + [(None, [1.0, 0.0, 0.0])] * 5
    df = spark.createDataFrame(rows, "y string, probs array<double>")
    got = {r["label"]: r for r in me.one_vs_rest(df, ["a", "b", "c"]).collect()}
    auc = {c: _auc(y == c, probs[:, i]) for i, c in enumerate("abc")}
    n = {c: int((y == c).sum()) for c in "abc"}
    assert all(got[c]["roc_auc"] == pytest.approx(auc[c]) and (got[c]["n"], got[c]["support"]) == (400, n[c]) for c in "abc")
    assert got["macro avg"]["roc_auc"] == pytest.approx(np.mean(list(auc.values())))
    assert got["weighted avg"]["roc_auc"] == pytest.approx(sum(auc[c] * n[c] for c in "abc") / 400)


def test_one_vs_rest_of_odd_classes(spark):
    df = spark.createDataFrame([("a", [0.6, 0.4, 0.0]), ("a", [0.2, 0.8, 0.0]), ("z", [0.5, 0.5, 0.0])], "y string, probs array<double>")
    got = {r["label"]: r for r in me.one_vs_rest(df, ["a", "b", "c"]).collect()}
    assert got["a"]["roc_auc"] == 0.5 and got["b"]["roc_auc"] is None and got["macro avg"]["roc_auc"] == 0.5 and got["weighted avg"]["roc_auc"] == 0.5
    assert got["macro avg"]["support"] == 2 and got["a"]["n"] == 3
    none = {r["label"]: r for r in me.one_vs_rest(df.limit(0), ["a", "b"]).collect()}
    assert none["a"]["n"] == 0 and none["macro avg"]["roc_auc"] is None
    with pytest.raises(Exception, match="expected 2 probabilities, found 3"):
        me.one_vs_rest(df, ["a", "b"]).collect()


@pytest.mark.parametrize("limit", [10**6, 50, 0])
@pytest.mark.parametrize("by", [["g"], ["g", "h"], []])
def test_previous_row_with_hot_groups(spark, limit, by):
    rng = np.random.default_rng(3)
    rows = [(None if i % 11 == 0 else int(rng.integers(0, 5)) if i % 3 else 0, int(rng.integers(0, 2)), int(rng.integers(0, 40)), i, None if i % 13 == 0 else float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, h int, t int, key int, x double").repartition(6)
    got = {r["key"]: r["prev_x"] for r in previous_row(df, by, ["t", "key"], ["x"], window_rows=limit).collect()}
    want, last = {}, {}
    for r in sorted(rows, key=lambda r: (r[2], r[3]) if by else (r[2], r[3])):
        group = r[:len(by)]
        want[r[3]] = last.get(group)
        last[group] = r[4]
    assert got == want


def test_previous_row_takes_one_exchange(spark, capsys):
    df = spark.range(1000).selectExpr("id % 10 as g", "id as t", "cast(id as double) as x").repartition(4)
    previous_row(df, ["g"], ["t"], ["x"]).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
