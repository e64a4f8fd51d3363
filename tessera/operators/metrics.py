"""Evaluation (E1-E13): every metric is an aggregation over a keyed prediction table.

Ranking metrics (ROC AUC, ROC curve, average precision) first aggregate to one
row per distinct score, then take skew-safe running sums over score order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import attach_row, running_sums

EPS = 2.0 ** -52


def _div(a, b):
    """a / b with 0 for a zero denominator (zero_division=0)."""
    return F.coalesce(F.try_divide(a, F.nullif(b, F.lit(0))), F.lit(0.0))


def accuracy(pred: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """E1."""
    return pred.agg(F.avg(F.when(F.col(y) == F.col(p), 1.0).otherwise(0.0)).alias("accuracy"))


def filled(dim: DataFrame, counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows (keys..., n) of ``counts``, with 0 for those of ``dim`` it lacks; none of its own is lost."""
    zero = dim.select(*keys, F.lit(0).cast("long").alias("n"))
    return counts.select(*keys, "n").unionByName(zero).groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))


def class_counts(pred: DataFrame, labels: Sequence, y: str = "y", p: str = "p") -> DataFrame:
    """label, tp, fp, fn, support -- from one contingency aggregate.

    The classes are those of ``labels`` and every other one that stands in y or p, NULL among them, so the
    supports add up to the number of rows.
    """
    cont = pred.groupBy(F.col(y).alias("__y"), F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    hit, zero = F.col("__y").eqNullSafe(F.col("__p")), F.lit(0).cast("long")
    rows = cont.select(F.inline(F.array(
        F.struct(F.col("__y").alias("label"), F.when(hit, F.col("__n")).otherwise(zero).alias("tp"), zero.alias("fp"), F.when(hit, zero).otherwise(F.col("__n")).alias("fn"), F.col("__n").alias("support")),
        F.struct(F.col("__p").alias("label"), zero.alias("tp"), F.when(hit, zero).otherwise(F.col("__n")).alias("fp"), zero.alias("fn"), zero.alias("support")))))
    kind = rows.schema["label"].dataType
    dim = pred.sparkSession.createDataFrame([(v,) for v in labels], ["label"]) if labels else None  # the class list: bounded
    if dim is not None:
        rows = rows.unionByName(dim.select(F.col("label").cast(kind), *[zero.alias(c) for c in ("tp", "fp", "fn", "support")]))
    return rows.groupBy("label").agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "fp", "fn", "support")])


def prf(pred: DataFrame, labels: Sequence, y: str = "y", p: str = "p") -> DataFrame:
    """Label, precision, recall, f1, support per class (zero_division = 0)."""
    c = class_counts(pred, labels, y, p)
    prec = _div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div(F.col("tp"), F.col("tp") + F.col("fn"))
    c = c.select("label", prec.alias("precision"), rec.alias("recall"), "support")
    return c.select("label", "precision", "recall",
                    _div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")).alias("f1"),
                    "support")


def averaged(per_class: DataFrame) -> DataFrame:
    """macro and weighted averages of a :func:`prf` table."""
    s = F.col("support").cast("double")
    macro = per_class.agg(F.lit("macro avg").alias("label"), F.avg("precision").alias("precision"),
                          F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                          F.sum("support").cast("long").alias("support"))
    tot = F.sum(s)
    weighted = per_class.agg(F.lit("weighted avg").alias("label"),
                             _div(F.sum(F.col("precision") * s), tot).alias("precision"),
                             _div(F.sum(F.col("recall") * s), tot).alias("recall"),
                             _div(F.sum(F.col("f1") * s), tot).alias("f1"),
                             F.sum("support").cast("long").alias("support"))
    return macro.unionByName(weighted)


def classification_report(pred: DataFrame, labels: Sequence, y: str = "y", p: str = "p") -> DataFrame:
    """Per-class rows + macro avg + weighted avg (label as text)."""
    pc = prf(pred, labels, y, p).withColumn("label", F.col("label").cast("string"))
    return pc.unionByName(averaged(pc))


def confusion_long(pred: DataFrame, labels: Sequence, y: str = "y", p: str = "p") -> DataFrame:
    """E4 long form: actual, predicted, n for every label pair (zeros included) and any other pair there is."""
    spark = pred.sparkSession
    dim = spark.createDataFrame([(a, b) for a in labels for b in labels], ["actual", "predicted"])  # k^2 rows
    cont = pred.groupBy(F.col(y).alias("actual"), F.col(p).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    return filled(dim, cont, ["actual", "predicted"])


def confusion_matrix(pred: DataFrame, labels: Sequence, y: str = "y", p: str = "p") -> DataFrame:
    """E4 wide form: actual + one count column per predicted label, fixed order.

    A prediction outside ``labels`` has no column, so it raises; an actual label outside them is a row.
    """
    listed = F.col("predicted").isin(list(labels))
    long = confusion_long(pred, labels, y, p).withColumn(
        "predicted", F.when(listed, F.col("predicted")).otherwise(F.raise_error(F.concat(F.lit("prediction outside labels: "), F.coalesce(F.col("predicted").cast("string"), F.lit("NULL"))))))
    return long.groupBy("actual").pivot("predicted", list(labels)).agg(F.first("n"))


def binary_counts(pred: DataFrame, y: str = "y", p: str = "p", group: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp (per group)."""
    yy, pp = F.col(y), F.col(p)
    return pred.groupBy(*group).agg(
        F.sum(F.when((yy == 0) & (pp == 0), 1).otherwise(0)).cast("long").alias("tn"),
        F.sum(F.when((yy == 0) & (pp == 1), 1).otherwise(0)).cast("long").alias("fp"),
        F.sum(F.when((yy == 1) & (pp == 0), 1).otherwise(0)).cast("long").alias("fn"),
        F.sum(F.when((yy == 1) & (pp == 1), 1).otherwise(0)).cast("long").alias("tp"))


def _score_table(pred: DataFrame, y: str, score: str, group: Sequence[str]) -> DataFrame:
    """One row per (group, distinct score): positives and negatives at that score.  Rows without a label are neither."""
    return pred.where(F.col(y).isNotNull()).groupBy(*group, F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("long").alias("neg"))


def roc_curve(pred: DataFrame, y: str = "y", score: str = "prob", group: Sequence[str] = ()) -> DataFrame:
    """(group..., threshold, fpr, tpr) at every distinct score, descending thresholds."""
    st = _score_table(pred, y, score, group).withColumn("__neg_score", -F.col("score"))
    cum = running_sums(st, group, ["__neg_score"], ["pos", "neg"])
    tot = st.groupBy(*group).agg(F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    j = cum.join(tot, list(group)) if group else attach_row(cum, tot)
    return j.select(*group, F.col("score").alias("threshold"),
                    F.try_divide(F.col("cum_neg"), F.nullif(F.col("__N"), F.lit(0))).alias("fpr"),
                    F.try_divide(F.col("cum_pos"), F.nullif(F.col("__P"), F.lit(0))).alias("tpr"))


def ranking_metrics(pred: DataFrame, y: str = "y", score: str = "prob", group: Sequence[str] = ()) -> DataFrame:
    """E5 + E10: (group..., roc_auc, pr_auc).

    AUC = sum over scores of pos(s) * (negatives below s + neg(s)/2) / (P N),
    which counts ties as one half.  Average precision = sum over descending
    thresholds of (recall step) * precision.
    """
    st = _score_table(pred, y, score, group)
    asc = running_sums(st, group, ["score"], ["pos", "neg"], prefix="asc_")
    tot = st.groupBy(*group).agg(F.sum("pos").alias("__tp"), F.sum("neg").alias("__tn"))
    j = asc.join(tot, list(group)) if group else attach_row(asc, tot)
    # sums over descending scores: the total less the ascending sum, and the score's own rows
    j = j.withColumn("desc_pos", F.col("__tp") - F.col("asc_pos") + F.col("pos")).withColumn(
        "desc_neg", F.col("__tn") - F.col("asc_neg") + F.col("neg"))
    below = F.col("asc_neg") - F.col("neg")
    agg = j.groupBy(*group).agg(
        F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("__auc_num"),
        F.sum(F.col("pos") * F.col("desc_pos") / (F.col("desc_pos") + F.col("desc_neg"))).alias("__ap_num"),
        F.sum("pos").alias("__P"), F.sum("neg").alias("__N"))
    return agg.select(*group,
                      F.try_divide(F.col("__auc_num"), F.nullif(F.col("__P") * F.col("__N"), F.lit(0))).alias("roc_auc"),
                      F.try_divide(F.col("__ap_num"), F.nullif(F.col("__P"), F.lit(0))).alias("pr_auc"))


def one_vs_rest(pred: DataFrame, labels: Sequence, y: str = "y", probs: str = "probs") -> DataFrame:
    """E5 over several classes: label, n, support, roc_auc, pr_auc per class, then their macro and weighted averages.

    ``probs`` holds one probability per class of ``labels``, in their order.  The arrays are spread to (class,
    score) rows and ranked in one sort keyed by class.  Rows without a label count in neither side of any class;
    n is the number of rows that have one.  A class that all rows or none have has no ranking and counts in no
    average.  A label outside ``labels`` is one of the rest to every class; probabilities of another number raise.
    """
    k = len(labels)
    fit = F.when(F.size(probs) == k, F.col(probs)).otherwise(F.raise_error(F.concat(F.lit(f"expected {k} probabilities, found "), F.size(probs).cast("string"))))
    long = pred.where(F.col(y).isNotNull()).select(F.col(y).alias("__y"), F.posexplode(fit).alias("__c", "score"))
    name = F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("__c") + 1)
    long = long.select("__c", name.alias("label"), (F.col("__y") == name).cast("int").alias("__own"), "score")
    ranked = ranking_metrics(long, "__own", "score", ["__c"])
    size = long.groupBy("__c", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("__own").cast("long").alias("support"))
    # a row per class from here on; one with no rows at all is listed as well
    dim = pred.sparkSession.createDataFrame([(i, str(v)) for i, v in enumerate(labels)], "__c int, name string")
    per = dim.join(size, "__c", "left").join(ranked, "__c", "left").select(
        "__c", F.col("name").alias("label"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("support", F.lit(0)).alias("support"), "roc_auc", "pr_auc")
    shared = [F.max("n").alias("n"), F.sum("support").cast("long").alias("support")]
    weight = [F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum(F.when(F.col(c).isNotNull(), F.col("support")))).alias(c) for c in ("roc_auc", "pr_auc")]
    macro = per.agg(F.lit(k).alias("__c"), F.lit("macro avg").alias("label"), *shared, F.avg("roc_auc").alias("roc_auc"), F.avg("pr_auc").alias("pr_auc"))
    weighted = per.agg(F.lit(k + 1).alias("__c"), F.lit("weighted avg").alias("label"), *shared, *weight)
    return per.unionByName(macro).unionByName(weighted).orderBy("__c").drop("__c")


def brier(pred: DataFrame, y: str = "y", prob: str = "prob", group: Sequence[str] = ()) -> DataFrame:
    """Mean squared error of the positive-class probability."""
    return pred.groupBy(*group).agg(F.avg(F.pow(F.col(prob) - F.col(y), 2)).alias("brier"))


def log_loss(pred: DataFrame, y: str = "y", prob: str = "prob", eps: float = EPS,
             group: Sequence[str] = ()) -> DataFrame:
    """Binary cross-entropy with probabilities clipped to [eps, 1 - eps]."""
    pc = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    ll = F.when(F.col(y) == 1, -F.log(pc)).otherwise(-F.log(1 - pc))
    return pred.groupBy(*group).agg(F.avg(ll).alias("log_loss"))


def regression_metrics(pred: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """r2, mae, rmse."""
    e = F.col(y) - F.col(yhat)
    sums = pred.agg(F.sum(e * e).alias("sse"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                    F.var_pop(F.col(y)).alias("vy"), F.count(F.lit(1)).alias("n"))
    return sums.select((1 - F.try_divide(F.col("sse"), F.nullif(F.col("vy") * F.col("n"), F.lit(0)))).alias("r2"),
                       "mae", F.sqrt("mse").alias("rmse"))


def residuals(pred: DataFrame, key: str, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Key, residual = y - yhat."""
    return pred.select(key, (F.col(y) - F.col(yhat)).alias("residual"))


def prob_histogram(pred: DataFrame, prob: str = "prob", y: str = "y", bins: int = 20) -> DataFrame:
    """Histogram of predicted probabilities per true class."""
    from .profile import histogram
    return histogram(pred, prob, bins, by=y)


def split_report(pred: DataFrame, split: str = "split", y: str = "y", p: str = "p",
                 prob: str = "prob", eps: float = EPS) -> DataFrame:
    """Per split: n, prevalence, roc_auc, pr_auc, brier, log_loss, precision, recall, f1, tn, fp, fn, tp."""
    g = [split]
    pc = F.least(F.greatest(F.col(prob), F.lit(eps)), F.lit(1 - eps))
    yy, pp = F.col(y), F.col(p)

    def rows(a, b):
        return F.sum(F.when((yy == a) & (pp == b), 1).otherwise(0)).cast("long")

    base = pred.groupBy(*g).agg(  # one pass for all that needs no order
        F.count(F.lit(1)).alias("n"), F.avg(yy.cast("double")).alias("prevalence"), F.avg(F.pow(F.col(prob) - yy, 2)).alias("brier"),
        F.avg(F.when(yy == 1, -F.log(pc)).otherwise(-F.log(1 - pc))).alias("log_loss"),
        rows(0, 0).alias("tn"), rows(0, 1).alias("fp"), rows(1, 0).alias("fn"), rows(1, 1).alias("tp"))
    prec = _div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _div(F.col("tp"), F.col("tp") + F.col("fn"))
    base = base.select("*", prec.alias("precision"), rec.alias("recall"), _div(2 * prec * rec, prec + rec).alias("f1"))
    out = base.join(ranking_metrics(pred, y, prob, g), g, "left")
    return out.select(*g, "n", "prevalence", "roc_auc", "pr_auc", "brier", "log_loss", "precision", "recall",
                      "f1", "tn", "fp", "fn", "tp")


def model_metrics(pred: DataFrame, group: Sequence[str], labels: Sequence = (), y: str = "y", p: str = "p",
                  positive=1) -> DataFrame:
    """Per group: accuracy, precision/recall/f1 macro and f1 weighted over all classes, recall_pos, f1_pos.

    The classes are those of ``labels`` and every other one that stands in the group's y or p, so totals
    count every row.  One contingency aggregate; a class-sized table follows.
    """
    g = list(group)
    cont = pred.groupBy(*g, F.col(y).alias("__y"), F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    hit = F.col("__y").eqNullSafe(F.col("__p"))
    side = F.array(F.struct(F.col("__y").alias("label"), F.when(hit, F.col("__n")).otherwise(0).alias("tp"), F.lit(0).cast("long").alias("fp"),
                            F.when(hit, 0).otherwise(F.col("__n")).cast("long").alias("fn")),
                   F.struct(F.col("__p").alias("label"), F.lit(0).cast("long").alias("tp"), F.when(hit, 0).otherwise(F.col("__n")).cast("long").alias("fp"),
                            F.lit(0).cast("long").alias("fn")))
    rows = cont.select(*g, F.inline(side))
    if labels:
        zero = [F.lit(0).cast("long").alias(c) for c in ("tp", "fp", "fn")]
        rows = rows.unionByName(cont.select(*g).distinct().select(*g, F.explode(F.array(*[F.lit(v).cast(rows.schema["label"].dataType) for v in labels])).alias("label"), *zero))
    per = rows.groupBy(*g, "label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    prec, rec = _div(F.col("tp"), F.col("tp") + F.col("fp")), _div(F.col("tp"), F.col("tp") + F.col("fn"))
    per = per.select(*g, "label", "tp", (F.col("tp") + F.col("fn")).alias("n"), prec.alias("pr"), rec.alias("re"), _div(2 * prec * rec, prec + rec).alias("f1"))
    of = F.col("label").eqNullSafe(F.lit(positive))
    return per.groupBy(*g).agg(
        _div(F.sum("tp"), F.sum("n")).alias("accuracy"), F.avg("pr").alias("precision_macro"), F.avg("re").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"), _div(F.sum(F.col("f1") * F.col("n")), F.sum("n")).alias("f1_weighted"),
        F.coalesce(F.max(F.when(of, F.col("re"))), F.lit(0.0)).alias("recall_pos"), F.coalesce(F.max(F.when(of, F.col("f1"))), F.lit(0.0)).alias("f1_pos"))


def binary_model_metrics(pred: DataFrame, group: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """Per group: accuracy, precision/recall/f1 macro over {0, 1} and any further class, recall_pos, f1_pos."""
    return model_metrics(pred, group, (0, 1), y, p).drop("f1_weighted")
