"""Model-comparison and report queries (M21-M23, R1-R9) with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import report as rp
from .common import R, rounded
from .experiments import METRICS, METRICS_CTE, SOURCES, two_label_metrics
from .registry import query

W = f"WITH {METRICS_CTE}"


@query("train_two_labels", sql=W + f"""
SELECT model, label_source, row_order, {', '.join(f'{R(m)} AS {m}' for m in METRICS)} FROM metrics
""")
def q_train_two_labels(spark, sf):
    return rounded(two_label_metrics(spark, sf))


_wide_cols = ", ".join(
    f"{R(f'max(CASE WHEN label_source = {chr(39)}{s}{chr(39)} THEN {m} END)')} AS {m}__{s}"
    for m in METRICS for s in SOURCES)


@query("pivot_wide", sql=W + f"SELECT model, {_wide_cols} FROM metrics GROUP BY model")
def q_pivot_wide(spark, sf):
    return rounded(rp.pivot_wide(two_label_metrics(spark, sf), METRICS, SOURCES))


_delta_cols = ", ".join(
    f"max(CASE WHEN label_source = 'corrected' THEN {m} END) - max(CASE WHEN label_source = 'original' THEN {m} END) AS {m}"
    for m in METRICS)
DELTA = f"dl AS (SELECT model, {_delta_cols} FROM metrics GROUP BY model)"


@query("metric_delta", sql=W + f", {DELTA} SELECT model, {', '.join(f'{R(m)} AS {m}' for m in METRICS)} FROM dl")
def q_metric_delta(spark, sf):
    return rounded(rp.delta(two_label_metrics(spark, sf), METRICS))


_dl_long = " UNION ALL ".join(f"SELECT {m} AS d FROM dl" for m in METRICS)


@query("verdict", sql=W + f""", {DELTA}, l AS ({_dl_long}),
c AS (SELECT CAST(sum(CASE WHEN d > 0 THEN 1 ELSE 0 END) AS BIGINT) AS improved,
             CAST(sum(CASE WHEN d < 0 THEN 1 ELSE 0 END) AS BIGINT) AS degraded,
             CAST(sum(CASE WHEN d = 0 THEN 1 ELSE 0 END) AS BIGINT) AS unchanged, count(d) AS total FROM l)
SELECT *, CASE WHEN degraded > improved THEN 'degraded' WHEN improved > degraded THEN 'improved'
               ELSE 'neutral' END AS verdict FROM c
""")
def q_verdict(spark, sf):
    return rp.verdict_text(rp.verdict_counts(two_label_metrics(spark, sf), METRICS))


_m_long = " UNION ALL ".join(f"SELECT '{m}' AS metric, model, label_source, row_order, {m} AS value FROM metrics"
                             for m in METRICS)
WIN = f"""mlong AS ({_m_long}),
win AS (SELECT metric, model || ' (' || label_source || ')' AS winner, value FROM (
          SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, row_order) AS r FROM mlong) x WHERE r = 1)"""


@query("winners", sql=W + f", {WIN} SELECT metric, winner, {R('value')} AS value FROM win")
def q_winners(spark, sf):
    return rounded(rp.winners(two_label_metrics(spark, sf), METRICS))


@query("wins_by_source", sql=W + f""", {WIN}
SELECT regexp_extract(winner, '\\((.*)\\)', 1) AS source, count(*) AS n FROM win GROUP BY 1
""")
def q_wins_by_source(spark, sf):
    return rp.wins_by_source(rp.winners(two_label_metrics(spark, sf), METRICS))


@query("ranking", sql=W + f"""
SELECT model, label_source, row_order, {', '.join(f'{R(m)} AS {m}' for m in METRICS)},
       CAST(row_number() OVER (ORDER BY f1_macro DESC, row_order) AS INTEGER) AS rnk FROM metrics
""")
def q_ranking(spark, sf):
    return rounded(rp.ranking(two_label_metrics(spark, sf), "f1_macro"))


@query("normalise_by_max", sql=W + f"""
SELECT model, label_source, {R('f1_macro')} AS f1_macro, {R('f1_macro / max(f1_macro) OVER ()')} AS f1_macro_rel
FROM metrics
""")
def q_normalise_by_max(spark, sf):
    m = rp.normalise_by_max(two_label_metrics(spark, sf), "f1_macro")
    return rounded(m.select("model", "label_source", "f1_macro", "f1_macro_rel"))


@query("compare_models", sql=W + f"""
SELECT model, label_source, {R('accuracy')} AS accuracy, {R('max(accuracy) OVER () - accuracy')} AS gap FROM metrics
""")
def q_compare_models(spark, sf):
    m = rp.compare_models(two_label_metrics(spark, sf), "accuracy")
    return rounded(m.select("model", "label_source", "accuracy", "gap"))


@query("flatten_json", sql=W + " " + " UNION ALL ".join(f"SELECT model, '{m}__' || label_source AS name, {R(m)} AS value FROM metrics" for m in METRICS))
def q_flatten_json(spark, sf):
    """The JSON objects, parsed again."""
    j = rp.flatten_json(two_label_metrics(spark, sf), METRICS)
    return rounded(j.select("model", F.explode(F.from_json("json", "map<string,double>")).alias("name", "value")))
