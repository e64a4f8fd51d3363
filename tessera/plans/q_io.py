"""Source/sink queries (S1-S12): round trips through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import hash_unit
from ..sources import io
from ..sources.tables import load
from .common import hash_unit_sql
from .registry import query


def _accented_customers(spark, sf):
    c = load(spark, sf, "customer")
    name = F.concat(F.col("c_name"), F.when(hash_unit("c_custkey", 17) < 0.3, F.lit("é")).otherwise(F.lit("")))
    return c.select(F.col("c_custkey").alias("﻿Customer Key\t"), name.alias(" Customer Name "),
                    F.col("c_mktsegment").alias("Segment (market)"))


@query("csv_roundtrip", sql=f"""
SELECT c_custkey AS customer_key, c_name || CASE WHEN {hash_unit_sql('c_custkey', 17)} < 0.3 THEN 'é' ELSE '' END
       AS customer_name, c_mktsegment AS segment_market FROM customer
""")
def q_csv_roundtrip(spark, sf):
    """Write latin-1 ';' CSV with a BOM'd, tabbed header; read it back robustly."""
    path = io.scratch_path(spark, "csv")
    io.write_csv(_accented_customers(spark, sf), path, sep=";", encoding="ISO-8859-1")
    df = io.read_csv(spark, path, sep=";", encoding="utf-8", fallback="ISO-8859-1", snake=True)
    return df.select(F.col("customer_key").cast("long").alias("customer_key"), "customer_name", "segment_market")


@query("csv_mixed_encodings", sql=f"""
SELECT c_custkey AS customer_key, c_name || CASE WHEN {hash_unit_sql('c_custkey', 17)} < 0.3 THEN 'é' ELSE '' END
       AS customer_name, c_mktsegment AS segment_market FROM customer
""")
def q_csv_mixed_encodings(spark, sf):
    """A folder of files in two encodings, each read in its own."""
    path, c = io.scratch_path(spark, "csv-mixed"), _accented_customers(spark, sf)
    half = F.col("`\ufeffCustomer Key\t`") % 2
    io.write_csv(c.where(half == 0), f"{path}/latin", sep=";", encoding="ISO-8859-1")
    io.write_csv(c.where(half == 1), f"{path}/utf8", sep=";", encoding="utf-8")
    df = io.read_csv(spark, f"{path}/*", sep=";", encoding="utf-8", fallback="ISO-8859-1", snake=True)
    return df.select(F.col("customer_key").cast("long").alias("customer_key"), "customer_name", "segment_market")


@query("expect_contract", sql="""
SELECT 'required:o_orderkey' AS "check", true AS passed, CAST(1 AS BIGINT) AS observed
UNION ALL SELECT 'required:o_custkey', true, 1
UNION ALL SELECT 'no_nulls:o_orderkey', count(*) FILTER (WHERE o_orderkey IS NULL) = 0,
                 count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders
UNION ALL SELECT 'no_nulls:o_totalprice', count(*) FILTER (WHERE o_totalprice IS NULL) = 0,
                 count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'unique:o_orderkey', count(*) = count(DISTINCT o_orderkey), count(*) - count(DISTINCT o_orderkey)
          FROM orders
UNION ALL SELECT 'unique:o_custkey', count(*) = count(DISTINCT o_custkey), count(*) - count(DISTINCT o_custkey)
          FROM orders
""")
def q_expect_contract(spark, sf):
    return io.expect(load(spark, sf, "orders"), required=["o_orderkey", "o_custkey"],
                     no_nulls=["o_orderkey", "o_totalprice"], unique=["o_orderkey", "o_custkey"])


@query("hand_off", sql="""
SELECT count(*) AS n_written, count(*) AS n_read, CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra
FROM orders
""")
def q_hand_off(spark, sf):
    o = load(spark, sf, "orders")
    return io.hand_off(o, io.scratch_path(spark, "handoff"), "o_orderkey")


@query("parquet_partitioned", sql="""
SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY o_orderstatus
""")
def q_parquet_partitioned(spark, sf):
    """Write partitioned by status, read one partition set back (partition pruning)."""
    path = io.scratch_path(spark, "pq")
    io.write_parquet(load(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    back = spark.read.parquet(path)
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                             F.countDistinct("o_custkey").alias("n_customers"))


@query("json_summary", sql="""
SELECT count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers, round(sum(o_totalprice), 2) AS revenue FROM orders
""")
def q_json_summary(spark, sf):
    """One-row summary written as JSON lines and parsed again."""
    o = load(spark, sf, "orders")
    summary = o.agg(F.count(F.lit(1)).alias("n_orders"), F.countDistinct("o_custkey").alias("n_customers"),
                    F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    path = io.scratch_path(spark, "json")
    io.write_json_summary(summary, path)
    return spark.read.schema(summary.schema).json(path)


@query("model_persistence")
def q_model_persistence(spark, sf):
    """Save a fitted pipeline, load it and score with the loaded copy."""
    from ..operators import models as md
    from .modelling import DOC_FEATURES, doc_table
    t = doc_table(spark, sf)
    m = md.build_model("tree", DOC_FEATURES, "y", max_depth=4).fit(t.where(F.col("split") == "train"))
    path = io.scratch_path(spark, "model")
    io.save_model(m, path)
    return md.predict(io.load_model(path), t.where(F.col("split") == "test"), "key", "y")
