"""Profiling / EDA operators (P1-P18): single-pass scans and aggregates.

Each operator fuses all its column statistics into one ``agg`` and turns the
one wide row into long rows with ``inline``/``stack``; no per-column loop of
jobs and nothing collected but fitted scalars.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .order import attach_row, top1_by
from .quantile import quantile_table, unpivot

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def _long_from_row(row_df: DataFrame, names: Sequence[str], fields: Sequence[str], prefix_fmt: str,
                   name: str = "column") -> DataFrame:
    """Turn one wide stats row (``{field}__{col}``) into one row per column."""
    structs = [F.struct(F.lit(c).alias(name), *[F.col(prefix_fmt.format(f=f, c=c)).alias(f) for f in fields])
               for c in names]
    return row_df.select(F.inline(F.array(*structs)))


def profile_shape(df: DataFrame) -> DataFrame:
    """n_rows, n_cols, n_numeric, n_other (schema counts need no job)."""
    n_num = len(numeric_columns(df))
    n_cols = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(n_cols).alias("n_cols"), F.lit(n_num).alias("n_numeric"),
        F.lit(n_cols - n_num).alias("n_other"))


def null_report(df: DataFrame, cols: Sequence[str] | None = None, top: int | None = None,
                keep_zero: bool = False) -> DataFrame:
    """Column, n_null, pct_null (of rows), pct_cells (of all cells)."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(f"n__{c}") for c in cols]
    row = df.agg(*aggs)
    long = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n__{c}").alias("n_null"), F.col("__n").alias("__n"))
        for c in cols])))
    out = long.select(
        "column", "n_null",
        (F.col("n_null") * 100.0 / F.col("__n")).alias("pct_null"),
        (F.col("n_null") * 100.0 / (F.col("__n") * F.lit(len(df.columns)))).alias("pct_cells"))
    if not keep_zero:
        out = out.where(F.col("n_null") > 0)
    out = out.orderBy(F.col("n_null").desc(), "column")
    return out.limit(top) if top else out


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of rows equal to an earlier row (all columns or ``cols``)."""
    cols = list(cols or df.columns)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Column, count, mean, std (ddof 1), min, q25, q50, q75, max."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"std__{c}"), F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    moments = _long_from_row(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"], "{f}__{c}")
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], exact=exact).select(
        "column", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"))
    return moments.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def central_tendency(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """P5: column, mean, median, mode (smallest value among the most frequent)."""
    cols = list(cols or numeric_columns(df))
    long = unpivot(df, cols)
    means = long.groupBy("column").agg(F.avg("value").alias("mean"))
    med = quantile_table(df, cols, [0.5], exact=exact).select("column", F.col("q0").alias("median"))
    mode = top1_by(long, ["column"], "value").select("column", "mode")
    return means.join(med, "column", "left").join(mode, "column", "left")


def dispersion(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Column, std (ddof 1), var, min, max."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.stddev_samp(x).alias(f"std__{c}"), F.var_samp(x).alias(f"var__{c}"),
                 F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    return _long_from_row(df.agg(*aggs), cols, ["std", "var", "min", "max"], "{f}__{c}")


def skewness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Bias-adjusted sample skewness G1 per column, sorted descending.

    Spark's ``skewness`` is the population g1; G1 = g1 * sqrt(n(n-1)) / (n-2).
    """
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.skewness(x).alias(f"g1__{c}"), F.count(x).alias(f"n__{c}")]
    long = _long_from_row(df.agg(*aggs), cols, ["g1", "n"], "{f}__{c}")
    n = F.col("n").cast("double")
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    return long.select("column", skew.alias("skew")).orderBy(F.col("skew").desc_nulls_last(), "column")


def group_describe(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Grp, column, mean, std, min, max for every column of every named group."""
    spark = df.sparkSession
    catalogue = spark.createDataFrame([(g, c) for g, cs in groups.items() for c in cs], "grp string, column string")
    cols = sorted({c for cs in groups.values() for c in cs})
    stats = unpivot(df, cols).groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    # catalogue is bounded by the number of named columns
    return F.broadcast(catalogue).join(stats, "column").select("grp", "column", "mean", "std", "min", "max")


def class_distribution(df: DataFrame, label: str, order: Sequence | None = None) -> DataFrame:
    """Label, n, pct, is_minority -- canonical order with absent classes as 0.

    Labels outside ``order``, NULL among them, follow as rows of their own, so n adds up to all rows.
    """
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    if order is not None:
        spark = df.sparkSession
        dim = spark.createDataFrame([(v, i) for i, v in enumerate(order)], ["label", "__ord"])
        counts = counts.select("label", "n", F.lit(None).cast("long").alias("__ord")).unionByName(
            dim.select("label", F.lit(0).cast("long").alias("n"), "__ord"))
        counts = counts.groupBy("label").agg(F.sum("n").cast("long").alias("n"), F.coalesce(F.max("__ord"), F.lit(len(order))).alias("__ord"))
    else:
        counts = counts.withColumn("__ord", F.lit(0))
    w = Window.partitionBy()  # a table with one row per class
    out = counts.select(
        "label", "n", "__ord",
        (F.col("n") * 100.0 / F.sum("n").over(w)).alias("pct"),
        (F.col("n") == F.min(F.when(F.col("n") > 0, F.col("n"))).over(w)).alias("is_minority"))
    return out.orderBy("__ord", "label").drop("__ord")


def _pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def correlation(df: DataFrame, cols: Sequence[str], full: bool = True,
                pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """P10: col_a, col_b, r (Pearson, pairwise-complete; NULL for a constant column).

    All pairs (or those of ``pairs``) come from one ``agg``.  ``full`` adds the mirrored pairs and the
    diagonal (r = 1 where defined), like a correlation matrix.
    """
    pairs = list(pairs) if pairs is not None else _pairs(cols)
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y)
        aggs += [F.covar_samp(xs, ys).alias(f"cv{i}"), F.stddev_samp(xs).alias(f"sx{i}"),
                 F.stddev_samp(ys).alias(f"sy{i}")]
    if full:
        aggs += [F.stddev_samp(F.col(c).cast("double")).alias(f"sd_{c}") for c in cols]
    row = df.agg(*aggs)
    structs = []
    for i, (a, b) in enumerate(pairs):
        r = F.try_divide(F.col(f"cv{i}"), F.nullif(F.col(f"sx{i}") * F.col(f"sy{i}"), F.lit(0.0)))
        structs.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), r.alias("r")))
        if full:
            structs.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), r.alias("r")))
    if full:
        for c in cols:
            structs.append(F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"),
                                    F.when(F.col(f"sd_{c}") > 0, F.lit(1.0)).alias("r")))
    return row.select(F.inline(F.array(*structs)))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str, k: int | None = None,
                     signed: bool = False) -> DataFrame:
    """Column, r, rnk -- features ranked by |r| with the target (or by r)."""
    c = correlation(df, [target, *cols], full=False, pairs=[(target, c) for c in cols])
    key = F.col("r") if signed else F.abs(F.col("r"))
    w = Window.orderBy(key.desc_nulls_last(), F.col("col_b"))  # one row per feature
    out = c.select(F.col("col_b").alias("column"), "r", F.row_number().over(w).alias("rnk"))
    return out.where(F.col("rnk") <= k) if k else out


def high_corr_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.9) -> DataFrame:
    """Upper-triangle pairs (schema order) with |r| >= threshold."""
    return correlation(df, cols, full=False).where(F.abs(F.col("r")) >= threshold)


def pair_corr(df: DataFrame, a: str, b: str) -> DataFrame:
    """A single coefficient."""
    return correlation(df, [a, b], full=False).select("r")


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed.

    Columns: by (when given), bin (0-based), lo, hi, n.  Only non-empty bins.
    """
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))  # one row
    width = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    b = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("__lo")) / width), F.lit(bins - 1))).cast("int")
    keys = [F.col(by).alias("by")] if by else []
    d = attach_row(df.where(x.isNotNull()), rng).select(*keys, b.alias("bin"), "__lo", "__hi")
    g = d.groupBy(*(["by"] if by else []), "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"))
    w = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    return g.select(*(["by"] if by else []), "bin", (F.col("__lo") + F.col("bin") * w).alias("lo"),
                    (F.col("__lo") + (F.col("bin") + 1) * w).alias("hi"), "n")


def box_stats(df: DataFrame, col: str, by: str, exact: bool = True, k: float = 1.5) -> DataFrame:
    """By, q1, med, q3, lo_whisker, hi_whisker, n_out per group (Tukey)."""
    q = quantile_table(df, [col], [0.25, 0.5, 0.75], by=[by], exact=exact).select(
        F.col(by).alias("__by"), F.col("q0").alias("q1"), F.col("q1").alias("med"), F.col("q2").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - k * iqr, F.col("q3") + k * iqr
    x = F.col(col).cast("double")
    # q has one row per group; the join key splits nothing but AQE broadcasts it when small
    j = df.select(F.col(by).alias("__by"), x.alias("__x")).where(F.col("__x").isNotNull()).join(q, "__by")
    inside = (F.col("__x") >= lo_f) & (F.col("__x") <= hi_f)
    return j.groupBy("__by").agg(
        F.first("q1").alias("q1"), F.first("med").alias("med"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("__x"))).alias("lo_whisker"),
        F.max(F.when(inside, F.col("__x"))).alias("hi_whisker"),
        F.sum(F.when(inside, 0).otherwise(1)).cast("long").alias("n_out"),
    ).withColumnRenamed("__by", "by")


def scatter_sample(df: DataFrame, key: str, x: str, y: str, fraction: float, seed: int = 42) -> DataFrame:
    """Non-null (x, y) pairs kept by a deterministic md5 hash of the key."""
    from ..functions.columns import hash_unit
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).where(
        hash_unit(key, seed) < fraction).select(key, x, y)


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First n rows by key (a top-n: the limit is the feature)."""
    return df.orderBy(key).limit(n)


def coverage(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Column, n (non-null), pct of rows."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__rows")] + [F.count(F.col(c)).alias(f"n__{c}") for c in cols]
    row = df.agg(*aggs)
    long = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n__{c}").alias("n"), F.col("__rows").alias("__rows"))
        for c in cols])))
    return long.select("column", "n", (F.col("n") * 100.0 / F.col("__rows")).alias("pct"))
