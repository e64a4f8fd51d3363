"""Label validation and correction.

Inputs are keyed tables: ``truth(key, label)``, cluster labels
``(key, cluster)``, soft memberships ``(key, u)``, density labels
``(key, cluster)`` with -1 noise, and point vectors for LOF.  Every output
is a keyed DataFrame or a small aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .metrics import filled
from .order import attach_row, top1_by


def cluster_majority(clusters: DataFrame, truth: DataFrame, key: str, cluster: str = "cluster",
                     label: str = "label") -> DataFrame:
    """L1: (cluster, majority) = most frequent true label per cluster, ties to the smallest."""
    j = clusters.select(key, cluster).join(truth.select(key, label), key)
    return top1_by(j, [cluster], label, name="majority").select(cluster, "majority")


def flag_discord(clusters: DataFrame, truth: DataFrame, key: str, cluster: str = "cluster",
                 label: str = "label") -> DataFrame:
    """L2: (key, cluster, majority, flag_discord) -- label differs from its cluster's majority."""
    maj = cluster_majority(clusters, truth, key, cluster, label)
    j = clusters.select(key, cluster).join(truth.select(key, label), key).join(maj, cluster)  # one row per cluster
    return j.select(key, cluster, "majority", (F.col(label) != F.col("majority")).cast("int").alias("flag_discord"))


def lof(points: DataFrame, key: str, k: int = 20, contamination: float = 0.1, x: str = "x",
        exact: bool = True) -> DataFrame:
    """L3: (key, lof_score, flag_lof) -- local outlier factor (Breunig 2000).

    k-distance and neighbours come from the exact grid kNN (self excluded);
    reach-dist(p, o) = max(kdist(o), d(p, o)); lrd(p) = 1 / (mean reach-dist
    + 1e-10); LOF(p) = mean lrd(o) / lrd(p).  Flagged: score strictly above
    its (1 - contamination) quantile.

    A point of k-distance 0 has k copies, and so have they: all reach-dists among them are 0 and the score is 1,
    which takes no pairs (where keys repeat, their rows are pooled, and all pairs are formed).
    """
    from .distance import knn_lists
    from .quantile import quantile_table
    n = points.count()
    kk = min(k, n - 1)
    nb = cut_lineage(knn_lists(points, key, kk, x, include_self=False))  # read several times
    far = F.get("near", F.lit(kk - 1))["dist"]
    unique = nb.groupBy(key).agg(F.count(F.lit(1)).alias("__c")).where("__c > 1").isEmpty()
    copied = F.coalesce(far == 0, F.lit(False)) if unique else F.lit(False)
    copies, links = nb.where(copied).select(key), nb.where(~copied).select(key, F.inline("near")).withColumnRenamed("id", "nbr")
    kd = nb.where(far.isNotNull()).select(F.col(key).alias("nbr"), far.alias("__kd_o"))
    rd = links.join(kd, "nbr").select(key, F.greatest(F.col("__kd_o"), F.col("dist")).alias("__rd"))
    lrd = rd.groupBy(key).agg((1.0 / (F.avg("__rd") + 1e-10)).alias("__lrd"))
    lrd = cut_lineage(lrd.unionByName(copies.withColumn("__lrd", F.lit(1.0 / 1e-10))))
    score = links.select(key, "nbr").join(lrd.select(F.col(key).alias("nbr"), F.col("__lrd").alias("__lrd_o")), "nbr") \
        .groupBy(key).agg(F.avg("__lrd_o").alias("__m")).join(lrd, key) \
        .select(key, (F.col("__m") / F.col("__lrd")).alias("lof_score"))
    score = score.unionByName(copies.withColumn("lof_score", F.lit(1.0)))
    score = cut_lineage(score)
    thr = quantile_table(score, ["lof_score"], [1.0 - contamination], exact=exact).select(F.col("q0").alias("__t"))
    return attach_row(score, thr).select(  # one-row threshold
        key, "lof_score", (F.col("lof_score") > F.col("__t")).cast("int").alias("flag_lof"))


def flag_noise(density: DataFrame, key: str, cluster: str = "cluster") -> DataFrame:
    """L4: (key, flag_noise) -- density label -1."""
    return density.select(key, (F.col(cluster) == -1).cast("int").alias("flag_noise"))


def flag_ambiguous(soft: DataFrame, key: str, threshold: float = 0.5, u: str = "u") -> DataFrame:
    """(key, max_u, flag_ambiguous) -- largest membership below the threshold."""
    most = soft.select(key, F.array_max(F.col(u)).alias("max_u"))
    return most.withColumn("flag_ambiguous", (F.col("max_u") < threshold).cast("int"))


def suspicion(flags: DataFrame, key: str, flag_cols: Sequence[str], cutoff: int = 2) -> DataFrame:
    """Adds suspicion_score (sum of flags) and is_suspect (score >= cutoff)."""
    score = sum((F.coalesce(F.col(c), F.lit(0)) for c in flag_cols[1:]), F.coalesce(F.col(flag_cols[0]), F.lit(0)))
    return flags.withColumn("suspicion_score", score.cast("int")).withColumn(
        "is_suspect", (F.col("suspicion_score") >= cutoff).cast("int"))


def score_distribution(susp: DataFrame, n_flags: int = 3) -> DataFrame:
    """(score, n, pct) for every score 0..n_flags (zeros included)."""
    spark = susp.sparkSession
    dim = spark.range(0, n_flags + 1).select(F.col("id").cast("int").alias("suspicion_score"))
    c = susp.groupBy("suspicion_score").agg(F.count(F.lit(1)).alias("n"))
    j = F.broadcast(dim).join(c, "suspicion_score", "left").select(
        F.col("suspicion_score").alias("score"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return j.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))  # n_flags+1 rows


def relabel(susp: DataFrame, key: str, label: str = "label", majority: str = "majority") -> DataFrame:
    """(key, original, corrected, is_suspect, was_changed) -- suspects take their cluster majority."""
    corrected = F.when(F.col("is_suspect") == 1, F.col(majority)).otherwise(F.col(label))
    return susp.select(key, F.col(label).alias("original"), corrected.alias("corrected"), "is_suspect",
                       (corrected != F.col(label)).cast("int").alias("was_changed"))


def transition_long(rel: DataFrame, classes: Sequence) -> DataFrame:
    """L9 long: (original, corrected, n) for every class pair, zeros filled."""
    spark = rel.sparkSession
    dim = spark.createDataFrame([(a, b) for a in classes for b in classes], ["original", "corrected"])
    c = rel.groupBy("original", "corrected").agg(F.count(F.lit(1)).alias("n"))
    return filled(dim, c, ["original", "corrected"])  # labels outside ``classes`` keep their rows


def transition_matrix(rel: DataFrame, classes: Sequence) -> DataFrame:
    """Original + one count column per corrected class, fixed order."""
    listed = F.col("corrected").isin(list(classes))
    long = transition_long(rel, classes).withColumn(
        "corrected", F.when(listed, F.col("corrected")).otherwise(F.raise_error(F.concat(F.lit("label outside classes: "), F.coalesce(F.col("corrected").cast("string"), F.lit("NULL"))))))
    return long.groupBy("original").pivot("corrected", list(classes)).agg(F.first("n"))


def flag_rates(diag: DataFrame, label: str, flag_cols: Sequence[str]) -> DataFrame:
    """Per label: n, each flag count and %, suspects count and %."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in [*flag_cols, "is_suspect"]:
        aggs += [F.sum(c).cast("long").alias(f"n_{c}"), (F.avg(c) * 100.0).alias(f"pct_{c}")]
    return diag.groupBy(label).agg(*aggs)


def triage(diag: DataFrame, label: str, majority: str = "majority") -> DataFrame:
    """Per label: clearly_ok (majority agrees, not suspect), possibly_other
    (majority differs), borderline (suspect) -- counts and %; categories overlap."""
    ok = (F.col(label) == F.col(majority)) & (F.col("is_suspect") == 0)
    other = F.col(label) != F.col(majority)
    border = F.col("is_suspect") == 1
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, cond in (("clearly_ok", ok), ("possibly_other", other), ("borderline", border)):
        aggs += [F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(f"n_{name}"),
                 (F.avg(F.when(cond, 1.0).otherwise(0.0)) * 100.0).alias(f"pct_{name}")]
    return diag.groupBy(label).agg(*aggs)


def suspicion_reasons(diag: DataFrame, flag_cols: Sequence[str]) -> DataFrame:
    """(scope, only_<flag>..., combined) among suspects and among all flagged rows.

    With a cut-off of 2 the 'only' buckets are empty among suspects (a
    single flag cannot reach the cut-off), so the 'flagged' scope (any flag
    set) is reported too.
    """
    def only(c):
        cond = F.col(c) == 1
        for o in flag_cols:
            if o != c:
                cond = cond & (F.col(o) == 0)
        return cond

    any_flag = sum((F.col(c) for c in flag_cols[1:]), F.col(flag_cols[0])) >= 1
    out = None
    for scope, cond in (("suspects", F.col("is_suspect") == 1), ("flagged", any_flag)):
        sub = diag.where(cond)
        aggs = [F.count(F.lit(1)).alias("n")] + [
            F.sum(F.when(only(c), 1).otherwise(0)).cast("long").alias(f"only_{c}") for c in flag_cols]
        r = sub.agg(*aggs)
        r = r.select(F.lit(scope).alias("scope"), "n", *[f"only_{c}" for c in flag_cols],
                     (F.col("n") - sum((F.col(f"only_{c}") for c in flag_cols), F.lit(0))).cast("long").alias("combined"))
        out = r if out is None else out.unionByName(r)
    return out


def p_class_given_cluster(clusters: DataFrame, truth: DataFrame, key: str, cluster: str = "cluster",
                          label: str = "label") -> DataFrame:
    """(cluster, label, n, p) -- row-normalised contingency."""
    c = clusters.select(key, cluster).join(truth.select(key, label), key).groupBy(cluster, label).agg(
        F.count(F.lit(1)).alias("n"))
    return c.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(cluster)))  # one row per cell


def cluster_confusion(clusters: DataFrame, truth: DataFrame, key: str, classes: Sequence,
                      cluster: str = "cluster", label: str = "label") -> DataFrame:
    """(actual, predicted, n) with each cluster mapped to its majority label."""
    from .metrics import confusion_long
    d = flag_discord(clusters, truth, key, cluster, label).join(truth.select(key, label), key)
    return confusion_long(d.select(F.col(label).alias("y"), F.col("majority").alias("p")), classes)


def verdict(diags: Sequence[DataFrame], label: str = "label", positive=1) -> DataFrame:
    """Average suspicion % over datasets, tier, and discord % within the positive label."""
    rows = None
    for i, d in enumerate(diags):
        r = d.agg((F.avg("is_suspect") * 100.0).alias("pct_suspect"),
                  F.coalesce(F.avg(F.when(F.col(label) == positive, F.col("flag_discord"))) * 100.0,
                             F.lit(0.0)).alias("pct_discord_pos"))
        r = r.select(F.lit(i).alias("dataset"), "*")
        rows = r if rows is None else rows.unionByName(r)
    avg = rows.agg(F.avg("pct_suspect").alias("avg_pct"))
    tier = (F.when(F.col("avg_pct") < 10, F.lit("promote")).when(F.col("avg_pct") < 25, F.lit("retrain"))
            .otherwise(F.lit("question_process")))
    per = rows.groupBy().pivot("dataset").agg(F.first("pct_discord_pos"))
    return attach_row(avg.select("avg_pct", tier.alias("tier")),
                      per.select(*[F.col(c).alias(f"pct_discord_pos_{c}") for c in per.columns]))  # one-row tables


def class_shift(rel: DataFrame, classes: Sequence | None = None) -> DataFrame:
    """(label, before, after, delta)."""
    b = rel.groupBy(F.col("original").alias("label")).agg(F.count(F.lit(1)).alias("before"))
    a = rel.groupBy(F.col("corrected").alias("label")).agg(F.count(F.lit(1)).alias("after"))
    j = b.join(a, "label", "full")
    out = j.select("label", F.coalesce("before", F.lit(0)).cast("long").alias("before"),
                   F.coalesce("after", F.lit(0)).cast("long").alias("after"))
    return out.withColumn("delta", F.col("after") - F.col("before"))


def relabel_summary(susp: DataFrame, rel: DataFrame, classes: Sequence, flag_cols: Sequence[str],
                    cutoff: int, ambiguity: float) -> DataFrame:
    """One JSON row with thresholds, signal counts, score counts, totals and the transition list."""
    counts = susp.agg(F.count(F.lit(1)).alias("n_total"),
                      *[F.sum(c).cast("long").alias(c) for c in flag_cols],
                      *[F.sum(F.when(F.col("suspicion_score") == s, 1).otherwise(0)).cast("long").alias(f"score_{s}")
                        for s in range(len(flag_cols) + 1)],
                      F.sum("is_suspect").cast("long").alias("n_suspect"))
    changed = rel.agg(F.sum("was_changed").cast("long").alias("relabeled_total"),
                      F.avg("was_changed").alias("relabeled_fraction"))
    trans = transition_long(rel, classes).agg(F.sort_array(F.collect_list(F.struct("original", "corrected", "n"))).alias("transitions"))
    row = attach_row(attach_row(counts, changed), trans)  # one-row tables
    return row.select(F.to_json(F.struct(
        F.lit(cutoff).alias("cutoff"), F.lit(ambiguity).alias("ambiguity_threshold"), "*")).alias("json"))


def audit(points: DataFrame, key: str, label: str, k: int, eps: float, min_samples: int, m: float = 1.3, ambiguity: float = 0.5,
          cutoff: int = 2, x: str = "x", seed: int = 42, n_init: int = 15) -> DataFrame:
    """The whole audit from clusterings that never see the label: one row per point.

    k-means clusters give each label a majority to agree with (discord), fuzzy memberships tell who stands between
    clusters (ambiguous), density clusters who stands alone (noise).  Columns: key, label, cluster, majority,
    flag_discord, max_u, flag_ambiguous, flag_noise, suspicion_score, is_suspect.
    """
    from . import cluster as cl
    pts, truth = points.select(key, x), points.select(key, F.col(label).alias("label"))
    clusters = cl.kmeans(pts, key, k, n_init=n_init, seed=seed, x=x)[0]
    soft = cl.fuzzy_cmeans(pts, key, k, m=m, x=x, seed=seed)[0]
    found = truth.join(flag_discord(clusters, truth, key), key).join(flag_ambiguous(soft, key, ambiguity), key)
    found = found.join(flag_noise(cl.dbscan(pts, key, eps, min_samples, x), key), key)
    return suspicion(found, key, ["flag_discord", "flag_ambiguous", "flag_noise"], cutoff)
