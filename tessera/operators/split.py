"""Deterministic splits and folds.

Rows are ordered by ``md5(key ':' seed)`` read as a uniform number, so a
split does not depend on partitioning or on the engine (the SQL oracle
computes the same hash).  Exact per-class counts come from skew-safe row
numbers: a window over (class, hash bucket) plus bucket offsets, so one big
class is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_unit
from ..session import split_buckets
from .order import rank_within, uniform_bucket


def _ranked(df: DataFrame, key: str, groups: Sequence[str], seed) -> DataFrame:
    u = hash_unit(key, seed)
    d = df.withColumn("__u", u)
    nb = split_buckets(df.sparkSession)
    return rank_within(d, list(groups), ["__u", key], name="__r", size_name="__n",
                       bucket=uniform_bucket(F.col("__u"), nb))


def _round_half_up(x):
    return F.floor(x + F.lit(0.5))


def random_split(df: DataFrame, key: str, test_frac: float = 0.2, seed: int = 42,
                 name: str = "split") -> DataFrame:
    """Exactly ceil(n * test_frac) rows get 'test' (lowest hashes), the rest 'train'."""
    r = _ranked(df, key, [], seed)
    n_test = F.ceil(F.col("__n") * F.lit(float(test_frac)))
    return r.withColumn(name, F.when(F.col("__r") < n_test, "test").otherwise("train")).drop(
        "__u", "__r", "__n")


def stratified_split(df: DataFrame, key: str, label: str, test_frac: float = 0.25, seed: int = 42,
                     name: str = "split") -> DataFrame:
    """Per class, round(n_c * test_frac) rows (half up) get 'test'."""
    r = _ranked(df, key, [label], seed)
    n_test = _round_half_up(F.col("__n") * F.lit(float(test_frac)))
    return r.withColumn(name, F.when(F.col("__r") < n_test, "test").otherwise("train")).drop(
        "__u", "__r", "__n")


def stratified_three_way(df: DataFrame, key: str, label: str, valid_frac: float = 0.15,
                         test_frac: float = 0.15, seed: int = 42, name: str = "split") -> DataFrame:
    """Per class, test then valid share by hash order (both rounded half up), rest train."""
    r = _ranked(df, key, [label], seed)
    n_test = _round_half_up(F.col("__n") * F.lit(float(test_frac)))
    n_valid = _round_half_up(F.col("__n") * F.lit(float(valid_frac)))
    s = F.when(F.col("__r") < n_test, "test").when(F.col("__r") < n_test + n_valid, "valid").otherwise("train")
    return r.withColumn(name, s).drop("__u", "__r", "__n")


def time_split(df: DataFrame, ts: str, cutoff: str, name: str = "split") -> DataFrame:
    """T4: ts < cutoff -> 'train', ts >= cutoff -> 'test'; NULL dates are dropped."""
    t = F.col(ts)
    c = F.lit(cutoff).cast("timestamp")
    return df.where(t.isNotNull()).withColumn(name, F.when(t < c, "train").otherwise("test"))


def period_split(df: DataFrame, period: str, valid, test, name: str = "split") -> DataFrame:
    """T5: period < valid -> train, == valid -> valid, == test -> test (others dropped)."""
    p = F.col(period)
    s = F.when(p == F.lit(test), "test").when(p == F.lit(valid), "valid").when(p < F.lit(valid), "train")
    return df.withColumn(name, s).where(F.col(name).isNotNull())


def stratified_kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """fold = (row number within class in hash order) mod k -- balanced per class."""
    r = _ranked(df, key, [label], seed)
    return r.withColumn(name, (F.col("__r") % k).cast("int")).drop("__u", "__r", "__n")


def expanding_folds(df: DataFrame, period: str, k: int, name: str = "fold") -> DataFrame:
    """K expanding-window folds over the last k periods.

    Fold i (1..k) tests on the i-th of the last k distinct periods and trains on
    every earlier period.  Output: input columns + fold + role ('train'/'test').
    The distinct periods are few (years, quarters); their count is checked.
    """
    periods = [r[0] for r in df.select(period).where(F.col(period).isNotNull()).distinct()
               .orderBy(F.col(period).desc()).limit(k).collect()]
    periods = sorted(periods)
    if len(periods) < k:
        raise ValueError(f"only {len(periods)} periods for {k} folds")
    # each row is emitted once per fold it takes part in (the output is that
    # long by definition); the k test periods are literals, so no join
    folds = F.array(*[F.struct(F.lit(i + 1).cast("long").alias(name), F.lit(p).alias("__test_period"))
                      for i, p in enumerate(periods)])
    mine = F.filter(folds, lambda f: f["__test_period"] >= F.col(period))
    j = df.select("*", F.inline(mine))
    role = F.when(F.col(period) == F.col("__test_period"), "test").otherwise("train")
    return j.withColumn("role", role).drop("__test_period")


def labels_changed(df: DataFrame, a: str, b: str) -> DataFrame:
    """N rows whose two labels differ, and the fraction."""
    diff = F.when(~F.col(a).eqNullSafe(F.col(b)), 1).otherwise(0)
    return df.agg(F.sum(diff).cast("long").alias("n"), F.avg(diff).alias("frac"))
