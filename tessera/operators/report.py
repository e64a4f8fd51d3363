"""Comparison and reporting (R1-R9) over a long metrics table.

Input: ``metrics(model, label_source, <metric columns>...)`` -- one row per
trained (model, label source).  All operators are small aggregations/pivots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .order import attach_row
from .quantile import unpivot


def pivot_wide(metrics: DataFrame, metric_cols: Sequence[str], sources: Sequence[str]) -> DataFrame:
    """Model + one column ``<metric>__<source>`` per metric and label source."""
    long = unpivot(metrics, metric_cols, ["model", "label_source"], "metric", "value")
    long = long.withColumn("__k", F.concat_ws("__", "metric", "label_source"))
    keys = [f"{m}__{s}" for m in metric_cols for s in sources]
    return long.groupBy("model").pivot("__k", keys).agg(F.first("value"))


def delta(metrics: DataFrame, metric_cols: Sequence[str], base: str = "original", other: str = "corrected") -> DataFrame:
    """R2: model + ``<metric>`` = other - base."""
    wide = pivot_wide(metrics, metric_cols, [base, other])
    return wide.select("model", *[(F.col(f"{m}__{other}") - F.col(f"{m}__{base}")).alias(m) for m in metric_cols])


def verdict_counts(metrics: DataFrame, metric_cols: Sequence[str], base: str = "original",
                   other: str = "corrected") -> DataFrame:
    """Improved / degraded / unchanged / total over all (model, metric) pairs."""
    d = unpivot(delta(metrics, metric_cols, base, other), metric_cols, ["model"], "metric", "d")
    return d.agg(F.sum(F.when(F.col("d") > 0, 1).otherwise(0)).cast("long").alias("improved"),
                 F.sum(F.when(F.col("d") < 0, 1).otherwise(0)).cast("long").alias("degraded"),
                 F.sum(F.when(F.col("d") == 0, 1).otherwise(0)).cast("long").alias("unchanged"),
                 F.count(F.col("d")).alias("total"))


def winners(metrics: DataFrame, metric_cols: Sequence[str], order_col: str = "row_order") -> DataFrame:
    """Metric, winner ('model (source)'), value -- first row in input order on ties."""
    long = unpivot(metrics, metric_cols, ["model", "label_source", order_col], "metric", "value")
    w = Window.partitionBy("metric").orderBy(F.col("value").desc(), F.col(order_col))
    r = long.withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1)
    return r.select("metric", F.format_string("%s (%s)", "model", "label_source").alias("winner"), "value")


def wins_by_source(winner_table: DataFrame) -> DataFrame:
    """Source, n -- the label source is read back from the winner text."""
    return winner_table.groupBy(F.regexp_extract("winner", r"\((.*)\)", 1).alias("source")).agg(
        F.count(F.lit(1)).alias("n"))


def ranking(metrics: DataFrame, metric: str, order_col: str = "row_order") -> DataFrame:
    """1-based rank by ``metric`` descending (stable on input order)."""
    w = Window.orderBy(F.col(metric).desc(), F.col(order_col))  # one row per trained model
    return metrics.withColumn("rnk", F.row_number().over(w))


def flatten_json(metrics: DataFrame, metric_cols: Sequence[str]) -> DataFrame:
    """Per model one JSON object ``{"<metric>__<source>": value}``."""
    long = unpivot(metrics, metric_cols, ["model", "label_source"], "metric", "value")
    entries = long.groupBy("model").agg(F.sort_array(F.collect_list(F.struct(
        F.concat_ws("__", "metric", "label_source").alias("k"), F.col("value").alias("v")))).alias("__e"))
    return entries.select("model", F.to_json(F.map_from_entries("__e")).alias("json"))


def verdict_text(counts: DataFrame) -> DataFrame:
    """Sign-based verdict from :func:`verdict_counts`."""
    v = (F.when(F.col("degraded") > F.col("improved"), F.lit("degraded"))
         .when(F.col("improved") > F.col("degraded"), F.lit("improved")).otherwise(F.lit("neutral")))
    return counts.select("*", v.alias("verdict"))


def normalise_by_max(metrics: DataFrame, metric: str) -> DataFrame:
    """Metric / max(metric) (chart data)."""
    return metrics.withColumn(f"{metric}_rel", F.col(metric) / metrics.select(F.max(metric)).scalar())


def compare_models(metrics: DataFrame, metric: str) -> DataFrame:
    """The best row by ``metric`` and each row's gap to it."""
    best = metrics.agg(F.max(metric).alias("__best"))
    return attach_row(metrics, best).withColumn("gap", F.col("__best") - F.col(metric)).drop("__best")
