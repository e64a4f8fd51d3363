"""Evaluation queries (E1-E13) with their SQL twins."""

from __future__ import annotations

from ..operators import metrics as me
from ..sources.tables import (LINE_PRED_SQL, ORDER_PRED_SQL, ORDER_PROB_SQL, doc_pred, doc_pred_sql, line_pred, order_pred, order_prob)
from .common import R, rounded
from .registry import query

DP = f"dp AS ({doc_pred_sql('duck')})"
OP = f"op AS ({ORDER_PRED_SQL})"
LP = f"lp AS ({LINE_PRED_SQL})"
STATUS = ["F", "O", "P"]


def _d(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


@query("accuracy", sql=f"WITH {OP} SELECT {R('avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM op")
def q_accuracy(spark, sf):
    return rounded(me.accuracy(order_pred(spark, sf)))


_PRF_SQL = f"""
WITH {OP}, lab(label) AS (VALUES ('F'), ('O'), ('P')),
c AS (SELECT label, sum(CASE WHEN y = label AND p = label THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN y <> label AND p = label THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y = label AND p <> label THEN 1 ELSE 0 END) AS fn,
             CAST(sum(CASE WHEN y = label THEN 1 ELSE 0 END) AS BIGINT) AS support FROM lab, op GROUP BY label),
pr AS (SELECT label, {_d('tp', 'tp + fp')} AS precision, {_d('tp', 'tp + fn')} AS recall, support FROM c),
pc AS (SELECT label, precision, recall, {_d('2 * precision * recall', 'precision + recall')} AS f1, support FROM pr)
"""


@query("prf_per_class", sql=_PRF_SQL + f"""
SELECT label, {R('precision')} AS precision, {R('recall')} AS recall, {R('f1')} AS f1, support FROM pc
""")
def q_prf_per_class(spark, sf):
    return rounded(me.prf(order_pred(spark, sf), STATUS))


@query("classification_report", sql=_PRF_SQL + f"""
SELECT label, {R('precision')} AS precision, {R('recall')} AS recall, {R('f1')} AS f1, support FROM pc
UNION ALL
SELECT 'macro avg', {R('avg(precision)')}, {R('avg(recall)')}, {R('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM pc
UNION ALL
SELECT 'weighted avg', {R('sum(precision * support) / sum(support)')}, {R('sum(recall * support) / sum(support)')},
       {R('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM pc
""")
def q_classification_report(spark, sf):
    return rounded(me.classification_report(order_pred(spark, sf), STATUS))


@query("confusion_matrix", sql=f"""
WITH {OP}, lab(actual) AS (VALUES ('F'), ('O'), ('P'))
SELECT actual, {', '.join(f"CAST(count(CASE WHEN p = '{s}' THEN 1 END) AS BIGINT) AS \"{s}\"" for s in STATUS)}
FROM lab LEFT JOIN op ON op.y = lab.actual GROUP BY actual
""")
def q_confusion_matrix(spark, sf):
    return me.confusion_matrix(order_pred(spark, sf), STATUS)


@query("confusion_binary", sql=f"""
WITH {DP} SELECT CAST(sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM dp
""")
def q_confusion_binary(spark, sf):
    return me.binary_counts(doc_pred(spark, sf))


# AUC by average ranks (Mann-Whitney), AP by descending thresholds -- written
# independently of the running-sum formulation used on the Spark side.
_RANK_SQL = f"""
WITH {DP},
rk AS (SELECT y, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2.0 AS r FROM dp),
auc AS (SELECT (sum(CASE WHEN y = 1 THEN r ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
               / (sum(y) * (count(*) - sum(y))) AS roc_auc FROM rk),
s AS (SELECT prob, sum(y) AS pos, count(*) - sum(y) AS neg FROM dp GROUP BY prob),
cs AS (SELECT prob, pos, sum(pos) OVER (ORDER BY prob DESC) AS tp, sum(neg) OVER (ORDER BY prob DESC) AS fp FROM s),
ap AS (SELECT sum(pos * tp / (tp + fp)) / sum(pos) AS pr_auc FROM cs)
"""


@query("roc_auc", sql=_RANK_SQL + f"SELECT {R('roc_auc')} AS roc_auc, {R('pr_auc')} AS pr_auc FROM auc, ap")
def q_roc_auc(spark, sf):
    return rounded(me.ranking_metrics(doc_pred(spark, sf)))


@query("roc_curve", sql=f"""
WITH {DP}, s AS (SELECT prob, sum(y) AS pos, count(*) - sum(y) AS neg FROM dp GROUP BY prob),
cs AS (SELECT prob, sum(pos) OVER (ORDER BY prob DESC) AS tp, sum(neg) OVER (ORDER BY prob DESC) AS fp,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM s)
SELECT {R('prob')} AS threshold, {R('fp / N')} AS fpr, {R('tp / P')} AS tpr FROM cs
""")
def q_roc_curve(spark, sf):
    return rounded(me.roc_curve(doc_pred(spark, sf)))


@query("regression_metrics", sql=f"""
WITH {LP} SELECT {R('1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))')} AS r2,
  {R('avg(abs(y - yhat))')} AS mae, {R('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse FROM lp
""")
def q_regression_metrics(spark, sf):
    return rounded(me.regression_metrics(line_pred(spark, sf)))


@query("residuals", sql=f"WITH {LP} SELECT key, {R('y - yhat')} AS residual FROM lp")
def q_residuals(spark, sf):
    return rounded(me.residuals(line_pred(spark, sf), "key"))


@query("prob_histogram", sql=f"""
WITH {DP}, r AS (SELECT min(prob) AS lo, max(prob) AS hi FROM dp),
b AS (SELECT y AS "by", CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((prob - lo) / ((hi - lo) / 20.0)), 19) END AS INTEGER) AS bin,
             lo, hi FROM dp, r)
SELECT "by", bin, {R('lo + bin * (hi - lo) / 20.0')} AS lo, {R('lo + (bin + 1) * (hi - lo) / 20.0')} AS hi, count(*) AS n
FROM b GROUP BY "by", bin, lo, hi
""")
def q_prob_histogram(spark, sf):
    return rounded(me.prob_histogram(doc_pred(spark, sf), bins=20))


@query("brier", sql=f"WITH {DP} SELECT {R('avg((prob - y) * (prob - y))')} AS brier FROM dp")
def q_brier(spark, sf):
    return rounded(me.brier(doc_pred(spark, sf)))


_EPS = "CAST(2.220446049250313e-16 AS DOUBLE)"


@query("log_loss", sql=f"""
WITH {DP}, c AS (SELECT y, least(greatest(prob, {_EPS}), 1 - {_EPS}) AS pc FROM dp)
SELECT {R('avg(CASE WHEN y = 1 THEN -ln(pc) ELSE -ln(1 - pc) END)')} AS log_loss FROM c
""")
def q_log_loss(spark, sf):
    return rounded(me.log_loss(doc_pred(spark, sf)))


@query("split_report", sql=f"""
WITH {DP},
rk AS (SELECT split, y, rank() OVER (PARTITION BY split ORDER BY prob)
                        + (count(*) OVER (PARTITION BY split, prob) - 1) / 2.0 AS r FROM dp),
auc AS (SELECT split, (sum(CASE WHEN y = 1 THEN r ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
               / nullif(sum(y) * (count(*) - sum(y)), 0) AS roc_auc FROM rk GROUP BY split),
s AS (SELECT split, prob, sum(y) AS pos, count(*) - sum(y) AS neg FROM dp GROUP BY split, prob),
cs AS (SELECT split, pos, sum(pos) OVER (PARTITION BY split ORDER BY prob DESC) AS tp,
              sum(neg) OVER (PARTITION BY split ORDER BY prob DESC) AS fp FROM s),
ap AS (SELECT split, sum(pos * tp / (tp + fp)) / nullif(sum(pos), 0) AS pr_auc FROM cs GROUP BY split),
eps AS (SELECT split, y, p, prob, least(greatest(prob, {_EPS}), 1 - {_EPS}) AS pc FROM dp),
b AS (SELECT split, count(*) AS n, avg(CAST(y AS DOUBLE)) AS prevalence, avg((prob - y) * (prob - y)) AS brier,
             avg(CASE WHEN y = 1 THEN -ln(pc) ELSE -ln(1 - pc) END) AS log_loss,
             CAST(sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
             CAST(sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM eps GROUP BY split),
m AS (SELECT *, {_d('tp', 'tp + fp')} AS precision, {_d('tp', 'tp + fn')} AS recall FROM b)
SELECT m.split, n, {R('prevalence')} AS prevalence, {R('roc_auc')} AS roc_auc, {R('pr_auc')} AS pr_auc,
       {R('brier')} AS brier, {R('log_loss')} AS log_loss, {R('precision')} AS precision, {R('recall')} AS recall,
       {R(_d('2 * precision * recall', 'precision + recall'))} AS f1, tn, fp, fn, tp
FROM m JOIN auc ON m.split = auc.split JOIN ap ON m.split = ap.split
""")
def q_split_report(spark, sf):
    return rounded(me.split_report(doc_pred(spark, sf)))


# every pair of an own and another row, by average ranks within each class; AP from descending cumulative sums
@query("roc_auc_ovr", sql=f"""
WITH pr AS ({ORDER_PROB_SQL}),
l AS (SELECT 'F' AS label, pf AS s, y FROM pr WHERE y IS NOT NULL UNION ALL SELECT 'O', po, y FROM pr WHERE y IS NOT NULL
      UNION ALL SELECT 'P', pp, y FROM pr WHERE y IS NOT NULL),
o AS (SELECT label, s, CASE WHEN y = label THEN 1 ELSE 0 END AS own FROM l),
rk AS (SELECT label, own, rank() OVER (PARTITION BY label ORDER BY s) + (count(*) OVER (PARTITION BY label, s) - 1) / 2.0 AS r FROM o),
a AS (SELECT label, count(*) AS n, CAST(sum(own) AS BIGINT) AS support,
             (sum(CASE WHEN own = 1 THEN r ELSE 0 END) - sum(own) * (sum(own) + 1) / 2.0) / nullif(CAST(sum(own) AS DOUBLE) * (count(*) - sum(own)), 0) AS roc_auc
      FROM rk GROUP BY label),
c AS (SELECT label, s, sum(own) AS pos, count(*) - sum(own) AS neg FROM o GROUP BY label, s),
cs AS (SELECT label, pos, sum(pos) OVER (PARTITION BY label ORDER BY s DESC) AS tp, sum(neg) OVER (PARTITION BY label ORDER BY s DESC) AS fp FROM c),
ap AS (SELECT label, sum(pos * tp / (tp + fp)) / nullif(sum(pos), 0) AS pr_auc FROM cs GROUP BY label),
per AS (SELECT a.label, n, support, roc_auc, pr_auc FROM a JOIN ap ON a.label = ap.label)
SELECT label, n, support, {R('roc_auc')} AS roc_auc, {R('pr_auc')} AS pr_auc FROM per
UNION ALL SELECT 'macro avg', max(n), CAST(sum(support) AS BIGINT), {R('avg(roc_auc)')}, {R('avg(pr_auc)')} FROM per
UNION ALL SELECT 'weighted avg', max(n), CAST(sum(support) AS BIGINT), {R('sum(roc_auc * support) / sum(support)')}, {R('sum(pr_auc * support) / sum(support)')} FROM per
""")
def q_roc_auc_ovr(spark, sf):
    return rounded(me.one_vs_rest(order_prob(spark, sf), STATUS))
