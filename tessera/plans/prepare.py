"""Flagship 'prepare' plan on orders (the reference's preparation CLI, end to end).

orders (+ planted NULL prices) -> median impute (C9) -> winsorize 1%/99% (C14)
-> per-customer return and log return (F1, F2) -> stratified 75/25 split by
priority (T2) -> standard scaling fitted on train only (F9) -> train rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_unit
from ..operators import clean, features, split
from ..session import cut_lineage
from ..sources.tables import load

NUMERIC = ["o_totalprice"]


def orders_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.withColumn("o_totalprice",
                        F.when(hash_unit("o_orderkey", 5) < 0.05, F.lit(None)).otherwise(F.col("o_totalprice")))


def prepare(spark: SparkSession, sf_dir: str, train_fit: bool = False) -> DataFrame:
    """All rows with split and scaled features (train-fitted scaler).

    ``train_fit`` splits first and fits the median and the winsor bounds on the train rows alone, so that nothing
    of a test row reaches a train row's values but a customer's own previous price.
    """
    o = orders_with_nulls(spark, sf_dir)
    rows = None
    if train_fit:
        o = cut_lineage(split.stratified_split(o, "o_orderkey", "o_orderpriority", 0.25, 42))
        rows = o.where(F.col("split") == "train")
    o = clean.impute_median(o, NUMERIC, fit_on=rows)
    o = clean.winsorize(o, NUMERIC, 0.01, 0.99, fit_on=None if rows is None else clean.impute_median(rows, NUMERIC))
    o = features.pct_change(o, "o_totalprice", ["o_custkey"], ["o_orderdate"], "o_orderkey")
    o = features.log_return(o, "o_totalprice")
    o = clean.fill_zero(o, ["o_totalprice_ret"])
    if not train_fit:
        o = split.stratified_split(o, "o_orderkey", "o_orderpriority", 0.25, 42)
    # fit (train rows) and apply (all rows) both read this: materialise once
    o = cut_lineage(o)
    cols = ["o_totalprice", "o_totalprice_ret", "o_totalprice_logret"]
    train = o.where(F.col("split") == "train")
    return features.standard_scale(o, cols, fit_on=train)


def prepare_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled train rows (the entry point's flagship result)."""
    return prepare(spark, sf_dir).where(F.col("split") == "train")
