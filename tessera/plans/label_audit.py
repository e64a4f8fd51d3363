"""Label audit plan: three (plus LOF) suspicion signals over customer RFM points.

Clusters come from fixed centres (the per-label means), memberships from
fuzzy c-means memberships to those centres (m = 1.3), density noise from
DBSCAN, local outliers from LOF.  The diagnosis table is cut to the
checkpoint folder once per session and reused by every label query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cluster as cl
from ..operators import labels as lb
from ..session import cut_lineage, input_stamp
from ..sources.tables import LABEL_CLASSES, rfm_points

M = 1.3
AMBIGUITY = 0.5
EPS = 0.35
MIN_SAMPLES = 6
LOF_K = 20
CONTAMINATION = 0.1
CUTOFF = 2
FLAGS = ["flag_discord", "flag_ambiguous", "flag_noise"]

_cache: dict = {}


def label_centres(pts: DataFrame) -> list[list[float]]:
    rows = pts.groupBy("label").agg(F.avg("z0").alias("c0"), F.avg("z1").alias("c1"), F.avg("z2").alias("c2")) \
        .orderBy("label").collect()  # one row per class
    return [[r["c0"], r["c1"], r["c2"]] for r in rows]


def diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, label, cluster, majority, flag_discord, max_u, flag_ambiguous, flag_noise,
    lof_score, flag_lof, suspicion_score, is_suspect."""
    ck = (spark.sparkContext.applicationId, sf_dir, input_stamp(spark, [f"{sf_dir}/{t}.parquet" for t in ["orders", "customer"]]))
    if ck in _cache:
        return _cache[ck]
    pts = cut_lineage(rfm_points(spark, sf_dir).select("key", "x", "z0", "z1", "z2", "label"))
    centres = label_centres(pts)
    clusters = cl.assign_nearest(pts, "key", centres)
    truth = pts.select("key", "label")
    disc = lb.flag_discord(clusters, truth, "key")
    u = cl.memberships(F.col("x"), centres, M)
    amb = lb.flag_ambiguous(pts.select("key", u.alias("u")), "key", AMBIGUITY)
    noise = lb.flag_noise(cl.dbscan(pts.select("key", "x"), "key", EPS, MIN_SAMPLES), "key")
    lof = lb.lof(pts.select("key", "x"), "key", LOF_K, CONTAMINATION)
    diag = truth.join(disc, "key").join(amb, "key").join(noise, "key").join(lof, "key")
    diag = lb.suspicion(diag, "key", FLAGS, CUTOFF)
    diag = cut_lineage(diag)
    _cache[ck] = diag
    return diag


def relabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lb.relabel(diagnosis(spark, sf_dir), "key")


CLASSES = LABEL_CLASSES
