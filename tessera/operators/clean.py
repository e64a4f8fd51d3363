"""Cleaning operators.

Fitting is a single one-row aggregate (medians, quantile bounds) that is
joined back as a broadcast -- its size is one row regardless of data size --
so ``fit_on=`` (e.g. the train split) never leaks test statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import MISSING_TOKENS, normalise_token
from .order import attach_row, top1_by
from .quantile import quantile_table


def normalise_missing(df: DataFrame, tokens: Sequence[str] = MISSING_TOKENS,
                      cols: Sequence[str] | None = None) -> DataFrame:
    """S3: trim every string column and map missing-value tokens to NULL."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    targets = set(cols or strings)
    return df.select(*[normalise_token(c, tokens).alias(c) if c in targets else F.col(c) for c in df.columns])


def _one_row_quantiles(fit_df: DataFrame, cols: Sequence[str], qs: Sequence[float], exact: bool) -> DataFrame:
    """One row with ``{col}__q{i}`` for each column/quantile (bounded: one row)."""
    t = quantile_table(fit_df, cols, qs, exact=exact)
    aggs = [F.first(F.when(F.col("column") == c, F.col(f"q{i}")), ignorenulls=True).alias(f"{c}__q{i}")
            for c in cols for i in range(len(qs))]
    return t.agg(*aggs)


def median_fit(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
               exact: bool = True) -> DataFrame:
    """C9 fit: column, n_filled (in ``df``), value (median of ``fit_on``)."""
    fit = _one_row_quantiles(fit_on if fit_on is not None else df, cols, [0.5], exact)
    nulls = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(f"{c}__n")
                     for c in cols])
    row = attach_row(fit, nulls)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n_filled"), F.col(f"{c}__q0").alias("value"))
        for c in cols])))


def impute_median(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                  exact: bool = True) -> DataFrame:
    """Fill NULLs of numeric ``cols`` with the median fitted on ``fit_on``."""
    fit = _one_row_quantiles(fit_on if fit_on is not None else df, cols, [0.5], exact)
    j = attach_row(df, fit)
    return j.select(*[
        F.coalesce(F.col(c).cast("double"), F.col(f"{c}__q0")).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def impute_sentinel(df: DataFrame, cols: Sequence[str], value: str = "__MISSING__") -> DataFrame:
    """Categorical NULL -> sentinel."""
    return df.fillna(value, subset=list(cols))


def impute_mode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """C11: NULL -> most frequent value (ties to the smallest) of ``fit_on``."""
    src = fit_on if fit_on is not None else df
    j = df
    for c in cols:
        j = attach_row(j, top1_by(src, [], c, name=f"{c}__mode").select(f"{c}__mode"))
    return j.select(*[F.coalesce(F.col(c), F.col(f"{c}__mode")).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows where every column is NULL."""
    return df.na.drop(how="all")


def drop_any_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows missing any critical column."""
    return df.na.drop(how="any", subset=list(subset))


def winsorize(df: DataFrame, cols: Sequence[str], lo: float = 0.01, hi: float = 0.99,
              fit_on: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """C14: clip each column to its [lo, hi] quantiles (NULLs stay NULL)."""
    fit = _one_row_quantiles(fit_on if fit_on is not None else df, cols, [lo, hi], exact)
    j = attach_row(df, fit)

    def clip(c):
        x = F.col(c).cast("double")
        return (F.when(x.isNull(), x).when(x < F.col(f"{c}__q0"), F.col(f"{c}__q0"))
                .when(x > F.col(f"{c}__q1"), F.col(f"{c}__q1")).otherwise(x))
    return j.select(*[clip(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """column, q1, q3, lower, upper, n_non_null."""
    q = quantile_table(df, cols, [0.25, 0.75], exact=exact)
    n = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_non_null")) for c in cols])))
    iqr = F.col("q1") - F.col("q0")
    return n.join(q, "column", "left").select(
        "column", F.col("q0").alias("q1"), F.col("q1").alias("q3"),
        (F.col("q0") - k * iqr).alias("lower"), (F.col("q1") + k * iqr).alias("upper"), "n_non_null")


def iqr_outlier_report(df: DataFrame, cols: Sequence[str], k: float = 1.5, top: int | None = None,
                       exact: bool = True) -> DataFrame:
    """Column, lower, upper, n_outliers (outside [lower, upper]), sorted desc."""
    b = iqr_bounds(df, cols, k, exact)
    wide = b.agg(*[F.first(F.when(F.col("column") == c, F.struct("lower", "upper")), ignorenulls=True).alias(c)
                   for c in cols])
    j = attach_row(df.select(*cols), wide.select(*[F.col(c).alias(f"{c}__b") for c in cols]))
    counts = j.agg(*[
        F.sum(F.when((F.col(c) < F.col(f"{c}__b.lower")) | (F.col(c) > F.col(f"{c}__b.upper")), 1)
              .otherwise(0)).cast("long").alias(c) for c in cols])
    long = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_outliers")) for c in cols])))
    out = b.select("column", "lower", "upper").join(long, "column").orderBy(
        F.col("n_outliers").desc(), "column")
    return out.limit(top) if top else out


def remove_outliers_iqr(df: DataFrame, col: str, min_non_null: int = 100, k: float = 1.5,
                        exact: bool = True) -> DataFrame:
    """Drop rows outside the IQR fences of ``col``; NULLs are kept.

    When fewer than ``min_non_null`` values are present the filter is skipped
    (the guard is part of the one-row fit, so the plan stays lazy).
    """
    b = iqr_bounds(df, [col], k, exact).select("lower", "upper", "n_non_null")
    x = F.col(col)
    keep = (x.isNull() | (F.col("n_non_null") < min_non_null) | x.between(F.col("lower"), F.col("upper")))
    return attach_row(df, b).where(keep).drop("lower", "upper", "n_non_null")


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C17: NULL -> 0.0 on derived columns."""
    return df.select(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remove id/date/target columns before modelling."""
    return df.drop(*cols)
