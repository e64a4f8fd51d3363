"""Model-ready tables derived from the test data.

* documents joined to labels, with text statistics computed over the whole
  text by built-in string functions (JVM side), a stratified train/test split
  and stratified folds on the train part;
* orders with line aggregates (a regression target: total price).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hash_unit
from ..operators.features import standard_scale
from ..operators.split import stratified_kfold, stratified_split
from ..session import cut_lineage, input_stamp
from ..sources.tables import load

DOC_FEATURES = ["n_chars", "n_words", "n_lines", "avg_word_len", "digit_frac", "upper_frac", "punct_frac",
                "uniq_frac", "lang_en", "lang_de", "lang_fr"]
ORDER_FEATURES = ["n_lines", "sum_qty", "avg_disc", "avg_tax", "max_price"]

_cache: dict = {}


def doc_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, y (quality), y_corrected, features..., split, fold (train rows only)."""
    ck = ("doc", spark.sparkContext.applicationId, sf_dir, input_stamp(spark, [f"{sf_dir}/{t}.parquet" for t in ("documents", "labels")]))
    if ck in _cache:
        return _cache[ck]
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    text = F.col("text")
    n_chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.split(F.trim(text), r"\s+")
    n_words = F.greatest(F.size(words), F.lit(1)).cast("double")
    t = cut_lineage(d.select(  # the texts are read once: the split, the scaler's fit and the folds read their statistics
        F.col("doc_id").alias("key"), F.col("quality").alias("y"),
        F.when(hash_unit("doc_id", 3) < 0.15, 1 - F.col("quality")).otherwise(F.col("quality")).alias("y_corrected"),
        F.col("n_chars").cast("double").alias("n_chars"), n_words.alias("n_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        (n_chars / n_words).alias("avg_word_len"),
        (F.length(F.regexp_replace(text, r"[^0-9]+", "")) / n_chars).alias("digit_frac"),
        (F.length(F.regexp_replace(text, r"[^A-Z]+", "")) / n_chars).alias("upper_frac"),
        ((F.length(text) - F.length(F.regexp_replace(text, r"[!-/:-@\[-`{-~]+", ""))) / n_chars).alias("punct_frac"),
        (F.size(F.array_distinct(F.split(F.lower(F.trim(text)), r"\s+"))) / n_words).alias("uniq_frac"),
        *[(F.col("lang") == lg).cast("double").alias(f"lang_{lg}") for lg in ("en", "de", "fr")]))
    t = cut_lineage(stratified_split(t, "key", "y", 0.25, 42))
    # scale every feature with a fit on the train rows only (no test leakage)
    t = standard_scale(t, DOC_FEATURES, fit_on=t.where(F.col("split") == "train"), replace=True)
    train = stratified_kfold(t.where(F.col("split") == "train"), "key", "y", 5, 7)
    t = t.join(train.select("key", "fold"), "key", "left")
    t = cut_lineage(t)
    _cache[ck] = t
    return t


def order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, y (o_totalprice), line aggregates, split."""
    ck = ("ord", spark.sparkContext.applicationId, sf_dir, input_stamp(spark, [f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem")]))
    if ck in _cache:
        return _cache[ck]
    li = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_discount").alias("avg_disc"), F.avg("l_tax").alias("avg_tax"),
        F.max("l_extendedprice").alias("max_price"))
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    t = o.join(li, "l_orderkey").select(F.col("l_orderkey").alias("key"), F.col("o_totalprice").alias("y"),
                                        *ORDER_FEATURES)
    t = t.withColumn("split", F.when(hash_unit("key", 9) < 0.3, "test").otherwise("train"))
    t = cut_lineage(t)
    _cache[ck] = t
    return t
