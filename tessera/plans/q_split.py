"""Split and fold queries (T1-T9) with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hash_unit
from ..operators import split
from ..sources.tables import load
from .common import R, hash_unit_sql
from .registry import query

U = hash_unit_sql("o_orderkey", 42)


def _orders(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")


@query("random_split", sql=f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {U}, o_orderkey) - 1 AS rn, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN rn < ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r
""")
def q_random_split(spark, sf):
    return split.random_split(_orders(spark, sf), "o_orderkey", 0.2, 42).select("o_orderkey", "split")


_STRAT = f"""r AS (SELECT o_orderkey, o_orderpriority,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY {U}, o_orderkey) - 1 AS rn,
  count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders)"""


@query("stratified_split", sql=f"""
WITH {_STRAT}
SELECT o_orderkey, CASE WHEN rn < floor(n * 0.25 + 0.5) THEN 'test' ELSE 'train' END AS split FROM r
""")
def q_stratified_split(spark, sf):
    return split.stratified_split(_orders(spark, sf), "o_orderkey", "o_orderpriority", 0.25, 42).select(
        "o_orderkey", "split")


@query("stratified_three_way", sql=f"""
WITH {_STRAT}
SELECT o_orderkey, CASE WHEN rn < floor(n * 0.15 + 0.5) THEN 'test'
                        WHEN rn < 2 * floor(n * 0.15 + 0.5) THEN 'valid' ELSE 'train' END AS split FROM r
""")
def q_stratified_three_way(spark, sf):
    return split.stratified_three_way(_orders(spark, sf), "o_orderkey", "o_orderpriority", 0.15, 0.15, 42).select(
        "o_orderkey", "split")


@query("stratified_kfold", sql=f"WITH {_STRAT} SELECT o_orderkey, CAST(rn % 5 AS INTEGER) AS fold FROM r")
def q_stratified_kfold(spark, sf):
    return split.stratified_kfold(_orders(spark, sf), "o_orderkey", "o_orderpriority", 5, 42).select(
        "o_orderkey", "fold")


@query("time_split", sql="""
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' ELSE 'test' END AS split
FROM orders WHERE o_orderdate IS NOT NULL
""")
def q_time_split(spark, sf):
    return split.time_split(_orders(spark, sf), "o_orderdate", "1999-01-01").select("o_orderkey", "split")


@query("period_split", sql="""
SELECT o_orderkey, CASE WHEN year(o_orderdate) = 2001 THEN 'test' WHEN year(o_orderdate) = 2000 THEN 'valid'
                        ELSE 'train' END AS split
FROM orders WHERE year(o_orderdate) <= 2001
""")
def q_period_split(spark, sf):
    o = _orders(spark, sf).withColumn("year", F.year("o_orderdate"))
    return split.period_split(o, "year", 2000, 2001).select("o_orderkey", "split")


@query("expanding_folds", sql="""
WITH y AS (SELECT DISTINCT year(o_orderdate) AS yr FROM orders ORDER BY yr DESC LIMIT 3),
f AS (SELECT yr, CAST(row_number() OVER (ORDER BY yr) AS BIGINT) AS fold FROM y)
SELECT o_orderkey, fold, CASE WHEN year(o_orderdate) = yr THEN 'test' ELSE 'train' END AS role
FROM orders, f WHERE year(o_orderdate) <= yr
""")
def q_expanding_folds(spark, sf):
    o = _orders(spark, sf).withColumn("year", F.year("o_orderdate"))
    return split.expanding_folds(o, "year", 3).select("o_orderkey", "fold", "role")


@query("labels_changed", sql=f"""
WITH c AS (SELECT o_orderpriority AS a,
                  CASE WHEN {hash_unit_sql('o_orderkey', 7)} < 0.1 THEN '1-URGENT' ELSE o_orderpriority END AS b
           FROM orders)
SELECT CAST(sum(CASE WHEN a IS DISTINCT FROM b THEN 1 ELSE 0 END) AS BIGINT) AS n,
       {R('avg(CASE WHEN a IS DISTINCT FROM b THEN 1 ELSE 0 END)')} AS frac FROM c
""")
def q_labels_changed(spark, sf):
    o = _orders(spark, sf)
    c = o.select(F.col("o_orderpriority").alias("a"),
                 F.when(hash_unit("o_orderkey", 7) < 0.1, F.lit("1-URGENT")).otherwise(
                     F.col("o_orderpriority")).alias("b"))
    from .common import rounded
    return rounded(split.labels_changed(c, "a", "b"))


@query("aligned_label_split", sql=f"""
WITH d AS (SELECT l.doc_id AS key, l.quality AS y,
                  CASE WHEN {hash_unit_sql('l.doc_id', 3)} < 0.15 THEN 1 - l.quality ELSE l.quality END AS y_corrected
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {hash_unit_sql('key', 42)}, key) - 1 AS rn,
             count(*) OVER (PARTITION BY y) AS n FROM d)
SELECT key, y, y_corrected, CASE WHEN rn < floor(n * 0.25 + 0.5) THEN 'test' ELSE 'train' END AS split FROM r
""")
def q_aligned_label_split(spark, sf):
    """One split; both label columns ride on the same rows."""
    d = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id").select(
        F.col("doc_id").alias("key"), F.col("quality").alias("y"),
        F.when(hash_unit("doc_id", 3) < 0.15, 1 - F.col("quality")).otherwise(F.col("quality")).alias("y_corrected"))
    return split.stratified_split(d, "key", "y", 0.25, 42).select("key", "y", "y_corrected", "split")
