"""A small train-under-two-label-sources experiment over the document tables.

Three rule models are *fitted* on the train split under each label source
(original vs corrected quality) and evaluated on the test split against the
original labels -- the shape of the reference's model comparison (M23).  The
output metrics table feeds the comparison/report operators (R1-R9).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import binary_model_metrics
from ..sources.tables import doc_labels, doc_labels_sql

MODELS = ["length", "lang", "source"]
SOURCES = ["original", "corrected"]
METRICS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "recall_pos", "f1_pos"]


def two_label_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_labels(spark, sf_dir)
    long = d.select("*", F.lit("original").alias("label_source"), F.col("quality").alias("y_src")).unionByName(
        d.select("*", F.lit("corrected").alias("label_source"), F.col("quality_corrected").alias("y_src")))
    train, test = long.where(F.col("split") == "train"), long.where(F.col("split") == "test")
    # fitted state: one row per label source / per (source, category) -- small, AQE broadcasts it
    t = train.where(F.col("y_src") == 0).groupBy("label_source").agg(F.avg("n_chars").alias("__t"))
    out = [test.join(F.broadcast(t), "label_source").select(
        F.lit("length").alias("model"), "label_source", "doc_id", F.col("quality").alias("y"),
        F.when(F.col("n_chars") > F.col("__t"), 1).otherwise(0).alias("p"))]
    for model, col in (("lang", "lang"), ("source", "source")):
        m = train.groupBy("label_source", col).agg(
            F.when(F.avg("y_src") >= 0.5, 1).otherwise(0).alias("__p"))
        out.append(test.join(m, ["label_source", col], "left").select(
            F.lit(model).alias("model"), "label_source", "doc_id", F.col("quality").alias("y"),
            F.coalesce("__p", F.lit(1)).alias("p")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def two_label_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, label_source, row_order, accuracy, precision_macro, recall_macro, f1_macro, recall_pos, f1_pos."""
    m = binary_model_metrics(two_label_predictions(spark, sf_dir), ["model", "label_source"])
    order = F.create_map(*[x for i, v in enumerate(MODELS) for x in (F.lit(v), F.lit(i))])
    src = F.when(F.col("label_source") == "original", 0).otherwise(1)
    return m.withColumn("row_order", (src * len(MODELS) + order[F.col("model")]).cast("int"))


def _div(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


METRICS_CTE = f"""
d AS ({doc_labels_sql('duck')}),
lng AS (SELECT *, 'original' AS label_source, quality AS y_src FROM d
        UNION ALL SELECT *, 'corrected' AS label_source, quality_corrected AS y_src FROM d),
tr AS (SELECT * FROM lng WHERE split = 'train'), te AS (SELECT * FROM lng WHERE split = 'test'),
ft AS (SELECT label_source, avg(n_chars) AS t FROM tr WHERE y_src = 0 GROUP BY label_source),
ml AS (SELECT label_source, lang, CASE WHEN avg(y_src) >= 0.5 THEN 1 ELSE 0 END AS p FROM tr GROUP BY 1, 2),
ms AS (SELECT label_source, source, CASE WHEN avg(y_src) >= 0.5 THEN 1 ELSE 0 END AS p FROM tr GROUP BY 1, 2),
pred AS (
  SELECT 'length' AS model, te.label_source, te.doc_id, te.quality AS y,
         CASE WHEN te.n_chars > ft.t THEN 1 ELSE 0 END AS p FROM te JOIN ft ON te.label_source = ft.label_source
  UNION ALL
  SELECT 'lang', te.label_source, te.doc_id, te.quality, coalesce(ml.p, 1)
  FROM te LEFT JOIN ml ON te.label_source = ml.label_source AND te.lang = ml.lang
  UNION ALL
  SELECT 'source', te.label_source, te.doc_id, te.quality, coalesce(ms.p, 1)
  FROM te LEFT JOIN ms ON te.label_source = ms.label_source AND te.source = ms.source),
bc AS (SELECT model, label_source,
              sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS tn
       FROM pred GROUP BY 1, 2),
pr AS (SELECT *, {_div('tp', 'tp + fp')} AS p1, {_div('tp', 'tp + fn')} AS r1,
              {_div('tn', 'tn + fn')} AS p0, {_div('tn', 'tn + fp')} AS r0 FROM bc),
f AS (SELECT *, {_div('2 * p1 * r1', 'p1 + r1')} AS f1_1, {_div('2 * p0 * r0', 'p0 + r0')} AS f1_0 FROM pr),
metrics AS (SELECT model, label_source,
       CAST((CASE WHEN label_source = 'original' THEN 0 ELSE 1 END) * 3
            + CASE model WHEN 'length' THEN 0 WHEN 'lang' THEN 1 ELSE 2 END AS INTEGER) AS row_order,
       {_div('tp + tn', 'tp + tn + fp + fn')} AS accuracy, (p0 + p1) / 2 AS precision_macro,
       (r0 + r1) / 2 AS recall_macro, (f1_0 + f1_1) / 2 AS f1_macro, r1 AS recall_pos, f1_1 AS f1_pos FROM f)
"""
