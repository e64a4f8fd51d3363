"""Test tables and the deterministic fixtures derived from them.

Every derived column is a pure function of the row (md5 of its key), written
once as a Spark expression and once as the SQL text the oracle uses, so both
engines see the same planted NULLs, messy strings and labels.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .io import read_parquet

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------- lineitem + planted NULLs
LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

_LI_HASH_SQL = "md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))"

LINEITEM_NULLS_SQL = f"""
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN substr(h, 1, 1) = '0' THEN NULL ELSE l_quantity END AS l_quantity,
         CASE WHEN substr(h, 1, 2) = 'ff' THEN NULL ELSE l_extendedprice END AS l_extendedprice,
         CASE WHEN substr(h, 2, 1) = '1' THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN substr(h, 3, 1) = '2' THEN NULL ELSE l_tax END AS l_tax,
         CASE WHEN substr(h, 4, 1) = '3' THEN NULL ELSE l_returnflag END AS l_returnflag,
         l_linestatus, l_shipdate
  FROM (SELECT *, {_LI_HASH_SQL} AS h FROM lineitem) t
"""


def lineitem_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with NULLs planted by an md5 rule on the row's key columns."""
    li = load(spark, sf_dir, "lineitem")
    h = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in
                                 ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]]))

    def null_if(cond, c):
        return F.when(cond, F.lit(None)).otherwise(F.col(c)).alias(c)
    return li.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        null_if(F.substring(h, 1, 1) == "0", "l_quantity"),
        null_if(F.substring(h, 1, 2) == "ff", "l_extendedprice"),
        null_if(F.substring(h, 2, 1) == "1", "l_discount"),
        null_if(F.substring(h, 3, 1) == "2", "l_tax"),
        null_if(F.substring(h, 4, 1) == "3", "l_returnflag"),
        "l_linestatus", "l_shipdate")


# ---------------------------------------------------------------- messy text from part
# p_retailprice is turned into integer-valued text in several styles, chosen by
# md5(p_partkey): integers only, because double->text formatting differs
# between engines.
MESSY_PART_SQL = """
  SELECT p_partkey, p_name, p_type, p_size, p_retailprice,
         CASE substr(h, 1, 1)
           WHEN '0' THEN NULL
           WHEN '1' THEN ''
           WHEN '2' THEN '-'
           WHEN '3' THEN 'nan'
           WHEN '4' THEN '$' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) || 'K'
           WHEN '5' THEN '€' || CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) || 'M'
           WHEN '6' THEN '£' || CAST(p_size AS STRING) || 'b'
           WHEN '7' THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS STRING) || 'd'
           WHEN '8' THEN 'None'
           ELSE '$' || CAST(CAST(floor(p_retailprice) * 1000 AS BIGINT) AS STRING)
         END AS money_raw,
         CASE WHEN substr(h, 2, 1) < '8'
              THEN ' ' || CAST(CAST(floor(p_retailprice) * 1000 + p_size AS BIGINT) AS STRING) || ' '
              ELSE substr(h, 3, 3) END AS number_raw,
         CASE WHEN substr(h, 6, 1) < '4' THEN '(' || CAST(1990 + p_size AS STRING) || ')'
              WHEN substr(h, 6, 1) < '8' THEN '(' || CAST(1990 + p_size AS STRING) || '–'
                                         || CAST(2000 + p_size AS STRING) || ')'
              WHEN substr(h, 6, 1) < 'c' THEN '(' || CAST(1990 + p_size AS STRING) || '– )'
              ELSE 'no year' END AS year_raw,
         CASE WHEN substr(h, 7, 1) < '8' THEN '  ' || p_type || chr(10) || p_name || ' '
              ELSE p_type END AS text_raw,
         CASE WHEN substr(h, 8, 1) < 'c' THEN CAST(1990 + p_size AS STRING) || '-0'
                                         || CAST(1 + p_size % 9 AS STRING) || '-1'
                                         || CAST(p_size % 10 AS STRING)
              ELSE 'not a date' END AS date_raw,
         CASE substr(h, 9, 1) WHEN '0' THEN 'NA' WHEN '1' THEN ' N/A ' WHEN '2' THEN '?'
              WHEN '3' THEN '-999' WHEN '4' THEN 'na' ELSE ' ' || p_brand || ' ' END AS brand_raw,
         CAST(p_size AS STRING) || ',' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') AS votes_raw
  FROM (SELECT *, md5(CAST(p_partkey AS STRING)) AS h FROM part) t
"""


def sql_over(spark: SparkSession, sf_dir: str, sql: str, names) -> DataFrame:
    """Run ``sql`` written against bare table names over ``sf_dir``'s parquet tables.

    Table names after FROM/JOIN become parameters of ``spark.sql`` -- no
    session-global temp views are registered.
    """
    import re
    text = sql
    args = {}
    for n in names:
        text = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", text)
        args[n] = load(spark, sf_dir, n)
    return spark.sql(text, **args)


def messy_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_over(spark, sf_dir, MESSY_PART_SQL, ["part"])


# ---------------------------------------------------------------- customer-year panel from orders
# A (unit, year) panel with finance-style indicators derived from orders.
PANEL_SQL = """
  SELECT o_custkey AS unit, CAST(year(o_orderdate) AS INTEGER) AS yr,
         sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END) AS flow,
         sum(o_totalprice) AS income,
         sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice ELSE 0 END) AS cost,
         count(*) / 3.0 AS liquidity,
         avg(CAST(day(o_orderdate) AS DOUBLE)) * 2 AS cash_days
  FROM orders GROUP BY o_custkey, year(o_orderdate)
"""


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_over(spark, sf_dir, PANEL_SQL, ["orders"])


# ---------------------------------------------------------------- prediction tables
def hash_unit_spark(key: str, seed) -> str:
    """Spark SQL text of functions.columns.hash_unit."""
    return (f"(CAST(conv(substr(md5(concat(CAST({key} AS STRING), ':{seed}')), 1, 13), 16, 10) AS DOUBLE)"
            f" / CAST(4503599627370496 AS DOUBLE))")


def hash_unit_duck(key: str, seed) -> str:
    return (f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 13)) AS BIGINT)"
            f" / CAST(4503599627370496 AS DOUBLE))")


# binary predictions over labelled documents: y = quality, score from length
DOC_PRED_SQL = """
  SELECT d.doc_id AS key, l.quality AS y, l.toxic AS y2,
         CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 2000.0) AS prob,
         CASE WHEN d.n_chars >= 2000 THEN 1 ELSE 0 END AS p,
         CASE WHEN {h5} < 0.6 THEN 'train' WHEN {h5} < 0.8 THEN 'valid' ELSE 'test' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

# multi-class predictions over orders: y = status, p = a rule on the order year
ORDER_PRED_SQL = """
  SELECT o_orderkey AS key, o_orderstatus AS y,
         CASE WHEN year(o_orderdate) < 1998 THEN 'F' WHEN year(o_orderdate) >= 2000 THEN 'P' ELSE 'O' END AS p
  FROM orders
"""

# multi-class probabilities over orders, F, O and P in this order; one customer in fifty has unlabelled orders
_ORDER_WEIGHTS = """
  SELECT o_orderkey AS key, CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_orderstatus END AS y,
         CAST(2003 - year(o_orderdate) AS DOUBLE) AS wf, 1.0 + floor(o_totalprice / 50000.0) / 2.0 AS wo, 0.5 + CAST(o_custkey % 7 AS DOUBLE) AS wp
  FROM orders
"""
ORDER_PROB_SQL = f"SELECT key, y, wf / (wf + wo + wp) AS pf, wo / (wf + wo + wp) AS po, wp / (wf + wo + wp) AS pp FROM ({_ORDER_WEIGHTS}) w"

# regression predictions over lineitem
LINE_PRED_SQL = """
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS key,
         l_extendedprice AS y, l_quantity * 1500.0 AS yhat
  FROM lineitem
"""


def doc_pred_sql(dialect: str) -> str:
    h = hash_unit_spark if dialect == "spark" else hash_unit_duck
    return DOC_PRED_SQL.format(h5=h("d.doc_id", 5))


def doc_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_over(spark, sf_dir, doc_pred_sql("spark"), ["documents", "labels"])


def order_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_over(spark, sf_dir, ORDER_PRED_SQL, ["orders"])


def order_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, y, probs) with the probabilities of F, O and P."""
    return sql_over(spark, sf_dir, ORDER_PROB_SQL, ["orders"]).select("key", "y", F.array("pf", "po", "pp").alias("probs"))


def line_pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_over(spark, sf_dir, LINE_PRED_SQL, ["lineitem"])


# documents with an original and a corrected label and a train/test split
DOC_LABELS_SQL = """
  SELECT d.doc_id, d.n_chars, d.lang, d.source, l.quality,
         CASE WHEN {h3} < 0.15 THEN 1 - l.quality ELSE l.quality END AS quality_corrected,
         CASE WHEN {h5} < 0.75 THEN 'train' ELSE 'test' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def doc_labels_sql(dialect: str) -> str:
    h = hash_unit_spark if dialect == "spark" else hash_unit_duck
    return DOC_LABELS_SQL.format(h3=h("d.doc_id", 3), h5=h("d.doc_id", 5))


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql_over(spark, sf_dir, doc_labels_sql("spark"), ["documents", "labels"])


# ---------------------------------------------------------------- customer RFM points
# the last order date: an uncorrelated scalar subquery (one value, no join)
_LAST_ORDER = "(SELECT max(o_orderdate) FROM orders)"

# recency (days from a customer's last order to the last order overall),
# frequency (orders) and monetary (total price) per customer, standardised
# (population std) to z0, z1, z2.  label: a frequency rule (integer
# comparisons, exact in both engines) with 10% of labels rotated by md5 --
# planted label noise for the suspicion ensemble to find.
_RFM = """
  SELECT o.o_custkey AS key, c.c_mktsegment AS segment,
         CAST({days} AS DOUBLE) AS recency, CAST(count(*) AS DOUBLE) AS frequency,
         sum(o.o_totalprice) AS monetary, count(*) AS n_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY o.o_custkey, c.c_mktsegment
"""
_RFM_Z = """
  SELECT key, segment, n_orders,
         (recency - avg(recency) OVER ()) / stddev_pop(recency) OVER () AS z0,
         (frequency - avg(frequency) OVER ()) / stddev_pop(frequency) OVER () AS z1,
         (monetary - avg(monetary) OVER ()) / stddev_pop(monetary) OVER () AS z2
  FROM rfm
"""
_RFM_LABEL = """
  SELECT key, CASE WHEN {h} < 0.1 THEN CASE base WHEN 'high' THEN 'low' WHEN 'low' THEN 'mid' ELSE 'high' END
                   ELSE base END AS label, base AS label_true
  FROM (SELECT key, CASE WHEN n_orders < 8 THEN 'low' WHEN n_orders > 12 THEN 'high' ELSE 'mid' END AS base FROM rz) t
"""
LABEL_CLASSES = ["high", "low", "mid"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def rfm_cte(dialect: str) -> str:
    """SQL CTEs ``rfm``, ``rz`` (standardised points) and ``truth`` (planted-noise labels)."""
    if dialect == "spark":
        days, h = f"datediff(CAST({_LAST_ORDER} AS DATE), CAST(max(o.o_orderdate) AS DATE))", hash_unit_spark("key", 11)
    else:
        days, h = f"date_diff('day', CAST(max(o.o_orderdate) AS DATE), CAST({_LAST_ORDER} AS DATE))", hash_unit_duck("key", 11)
    return (f"rfm AS ({_RFM.format(days=days)}),\n rz AS ({_RFM_Z}),\n"
            f" truth AS ({_RFM_LABEL.format(h=h)})")


def rfm_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, segment, n_orders, z0, z1, z2, x=array(z0,z1,z2), label, label_true).

    The Spark side standardises with the one-row scaler fit (no global window).
    """
    from ..operators.features import standard_scale
    from ..functions.columns import hash_unit
    days = f"datediff(CAST({_LAST_ORDER} AS DATE), CAST(max(o.o_orderdate) AS DATE))"
    rfm = cut_lineage(sql_over(spark, sf_dir, _RFM.format(days=days), ["orders", "customer"]))  # the fit and every later scan read it
    z = standard_scale(rfm, ["recency", "frequency", "monetary"]).select(
        "key", "segment", "n_orders", F.col("recency_std").alias("z0"), F.col("frequency_std").alias("z1"),
        F.col("monetary_std").alias("z2"))
    base = F.when(F.col("n_orders") < 8, "low").when(F.col("n_orders") > 12, "high").otherwise("mid")
    rot = F.when(base == "high", "low").when(base == "low", "mid").otherwise("high")
    return z.select("*", F.when(hash_unit("key", 11) < 0.1, rot).otherwise(base).alias("label"),
                    base.alias("label_true"), F.array("z0", "z1", "z2").alias("x"))
