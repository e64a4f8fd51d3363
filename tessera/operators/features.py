"""Feature engineering (F1-F20): windows, encodings, scalers.

Fitted state (category lists, means, ranges) is a one-row DataFrame or a
bounded driver list; data rows never leave the executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import log1p_safe
from .order import attach_row, global_index, previous_row

MAX_CATEGORIES = 200


# ---------------------------------------------------------------- F1-F3
def pct_change(df: DataFrame, col: str, by: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """``<col>_ret`` = x / previous x - 1 within each ``by`` entity.

    The predecessor is found by :func:`previous_row`, which spreads a huge entity
    over range partitions, so it is not one task.  With
    ``by=[]`` the whole table is one sequence (the reference's no-id mode).
    A zero previous value gives NULL.
    """
    j = previous_row(df, by, [*order, key], [col], prefix="__prev_")
    ret = F.try_divide(F.col(col), F.nullif(F.col(f"__prev_{col}"), F.lit(0.0))) - 1
    return j.withColumn(f"{col}_ret", ret).drop(f"__prev_{col}")


def log_return(df: DataFrame, col: str) -> DataFrame:
    """``<col>_logret`` = log1p(<col>_ret), NULL (first row, x <= -1) -> 0."""
    return df.withColumn(f"{col}_logret", F.coalesce(log1p_safe(F.col(f"{col}_ret")), F.lit(0.0)))


def log1p_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<col>_log`` = log1p(col)."""
    return df.select("*", *[log1p_safe(F.col(c)).alias(f"{c}_log") for c in cols])


# ---------------------------------------------------------------- F4-F8
def categories(df: DataFrame, col: str, max_categories: int = MAX_CATEGORIES) -> list:
    """Sorted distinct non-null values; refuses more than ``max_categories``.

    Only up to ``max_categories + 1`` distinct values are ever brought to
    the driver (the distinct is computed on the executors).
    """
    vals = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct()
            .orderBy(col).limit(max_categories + 1).collect()]
    if len(vals) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories; use one_hot_sparse or label_encode")
    return vals


def _dummy_name(col: str, v) -> str:
    return f"{col}_{v}"


def one_hot(df: DataFrame, col: str, drop_first: bool = True, cats: Sequence | None = None,
            max_categories: int = MAX_CATEGORIES, keep: bool = False) -> DataFrame:
    """0/1 dummy columns ``<col>_<value>`` in sorted category order.

    ``drop_first`` drops the first category (F4).  With ``cats`` given (fitted
    on train), unseen values are all zeros (F5, ignore-unknown).  NULL gives
    all zeros.  The source column is dropped unless ``keep``.
    """
    cats = list(cats) if cats is not None else categories(df, col, max_categories)
    use = cats[1:] if drop_first else cats
    dummies = [F.when(F.col(col) == F.lit(v), 1).otherwise(0).alias(_dummy_name(col, v)) for v in use]
    out = df.select("*", *dummies)
    return out if keep else out.drop(col)


def label_encode(df: DataFrame, col: str) -> DataFrame:
    """``<col>_encoded`` = 0-based rank of the value among sorted distinct values.

    Distinct values are numbered with the skew-safe global index (no
    single-partition window even at high cardinality) and joined back; AQE
    turns the join into a broadcast when the dictionary is small.
    """
    dictionary = global_index(df.select(col).where(F.col(col).isNotNull()).distinct(), [col],
                              f"{col}_encoded")
    return df.join(dictionary, col, "left")


def ordinal_encode(df: DataFrame, col: str, order: Sequence, name: str | None = None) -> DataFrame:
    """fixed value -> index map (a literal map; unknown -> NULL)."""
    m = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(i))])
    return df.withColumn(name or f"{col}_code", m[F.col(col)])


def ordinal_decode(c, order: Sequence):
    """F7 inverse: index -> value."""
    return F.element_at(F.array(*[F.lit(v) for v in order]), c.cast("int") + 1)


def binary_encode(df: DataFrame, col: str) -> DataFrame:
    """F8: ``<col>_binary`` binary digits of the integer value, NULL kept."""
    return df.withColumn(f"{col}_binary", F.bin(F.col(col).cast("bigint")))


# ---------------------------------------------------------------- F9-F11 scalers
def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "standard") -> DataFrame:
    """F9/F10 fit: one row with mean/std (ddof 0) or min/max per column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        if kind == "standard":
            aggs += [F.avg(x).alias(f"{c}__a"), F.stddev_pop(x).alias(f"{c}__b")]
        elif kind == "minmax":
            aggs += [F.min(x).alias(f"{c}__a"), F.max(x).alias(f"{c}__b")]
        else:
            raise ValueError(kind)
    return df.agg(*aggs)


def apply_scaler(df: DataFrame, fit: DataFrame, cols: Sequence[str], kind: str = "standard",
                 replace: bool = False) -> DataFrame:
    """F9/F10 apply: ``<col>_std`` = (x - mean) / std, ``<col>_mm`` = (x - min) / (max - min).

    A constant column maps to 0 (the reference library's convention, unlike
    Spark ML's 0.5 for MinMax).  ``fit`` is one row, attached as scalar subqueries.
    """
    j = attach_row(df, fit)
    outs = {}
    for c in cols:
        x, a, b = F.col(c).cast("double"), F.col(f"{c}__a"), F.col(f"{c}__b")
        if kind == "standard":
            outs[c] = (F.when(b == 0, F.lit(0.0)).otherwise((x - a) / b), f"{c}_std")
        else:
            outs[c] = (F.when(b == a, F.lit(0.0)).otherwise((x - a) / (b - a)), f"{c}_mm")
    if replace:
        sel = [outs[c][0].alias(c) if c in outs else F.col(c) for c in df.columns]
    else:
        sel = [F.col(c) for c in df.columns] + [e.alias(n) for e, n in outs.values()]
    return j.select(*sel)


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                   replace: bool = False) -> DataFrame:
    return apply_scaler(df, fit_scaler(fit_on if fit_on is not None else df, cols, "standard"), cols,
                        "standard", replace)


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                 replace: bool = False) -> DataFrame:
    return apply_scaler(df, fit_scaler(fit_on if fit_on is not None else df, cols, "minmax"), cols,
                        "minmax", replace)


def poly_interactions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """degree-2 interaction terms ``<a>_x_<b>`` (no squares, no bias)."""
    terms = [(F.col(a) * F.col(b)).alias(f"{a}_x_{b}") for i, a in enumerate(cols) for b in cols[i + 1:]]
    return df.select("*", *terms)


def one_hot_sparse(df: DataFrame, col: str, name: str | None = None):
    """F5 for any number of categories: (df with a sparse vector column, fitted pipeline).

    Categories take the vector's places in alphabetical order; NULL and values unseen at fit time get zeros.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    index = StringIndexer(inputCol=col, outputCol=f"__{col}_idx", stringOrderType="alphabetAsc", handleInvalid="keep")
    encode = OneHotEncoder(inputCol=f"__{col}_idx", outputCol=name or f"{col}_vec", dropLast=True)  # the last place is that of unknown values
    model = Pipeline(stages=[index, encode]).fit(df)
    return model.transform(df).drop(f"__{col}_idx"), model


# ---------------------------------------------------------------- F15-F20
def threshold_target(df: DataFrame, cols: Sequence[str], name: str = "target", exact: bool = True) -> DataFrame:
    """1 if every column is >= its own median (one-row fit, scalar subqueries)."""
    from .clean import _one_row_quantiles
    fit = _one_row_quantiles(df, cols, [0.5], exact)
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) >= F.col(f"{c}__q0"))
    return attach_row(df, fit).select(*df.columns, F.when(cond, 1).otherwise(0).alias(name))


#: Fixed values of the stress rule: least liquidity and least days of cash.
LEAST_LIQUIDITY, LEAST_CASH_DAYS = 1, 30


def stress_label(df: DataFrame, entity: str, period: str, flow: str, liquidity: str, cash_days: str,
                 name: str = "stress") -> DataFrame:
    """1 if the flow is negative in this and the previous period, or liquidity or cash days are under their least."""
    j = previous_row(df, [entity], [period], [flow], prefix="__prev_")
    two_neg = (F.col(flow) < 0) & (F.col(f"__prev_{flow}") < 0)
    flag = F.coalesce(two_neg, F.lit(False)) | F.coalesce(F.col(liquidity) < LEAST_LIQUIDITY, F.lit(False)) | \
        F.coalesce(F.col(cash_days) < LEAST_CASH_DAYS, F.lit(False))
    return j.withColumn(name, flag.cast("int")).drop(f"__prev_{flow}")


def cost_income_ratio(cost, income):
    """cost / income ratio (NULL on zero income)."""
    return F.try_divide(cost, F.nullif(income, F.lit(0)))


def concentration(df: DataFrame, entity: str, share_col: str, name: str = "hhi") -> DataFrame:
    """Herfindahl index per entity: sum((x / sum x)^2) = sum(x^2) / (sum x)^2.

    Written as a plain aggregate (partial aggregation splits a hot entity).
    """
    x = F.col(share_col).cast("double")
    return df.groupBy(entity).agg(
        F.try_divide(F.sum(x * x), F.pow(F.sum(x), 2)).alias(name))


def pca_project(df: DataFrame, key: str, cols: Sequence[str], k: int = 2) -> tuple[DataFrame, DataFrame]:
    """(key, pc1..pck) of the standardised columns, and (component, explained_variance).

    Spark ML's PCA does not centre at transform time, so the input is
    standardised first.  Each component's sign is fixed so its largest
    absolute loading is positive, making the output reproducible.
    """
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    z = standard_scale(df.select(key, *cols), cols, replace=True)
    vec = VectorAssembler(inputCols=list(cols), outputCol="__v", handleInvalid="error").transform(z)  # impute first; no row is left out
    model = PCA(k=k, inputCol="__v", outputCol="__pc").fit(vec)
    pcs = model.pc.toArray()  # (d, k) loadings: bounded by the column count
    signs = [1.0 if pcs[abs(pcs[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    arr = vector_to_array(F.col("__pc"))
    proj = model.transform(vec).select(key, *[(arr[j] * signs[j]).alias(f"pc{j + 1}") for j in range(k)])
    spark = df.sparkSession
    ev = spark.createDataFrame([(f"pc{j + 1}", float(v)) for j, v in enumerate(model.explainedVariance)],
                               "component string, explained_variance double")
    return proj, ev


def feature_groups(spark, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """The (group, column) catalogue as a DataFrame."""
    return spark.createDataFrame([(g, c) for g, cs in groups.items() for c in cs], "grp string, column string")


def shape_features(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """F16: for each (a, b): ``<a>_per_<b>`` = a / b (NULL on 0) and ``<a>_by_<b>`` = a * b."""
    out = []
    for a, b in pairs:
        out += [F.try_divide(F.col(a).cast("double"), F.nullif(F.col(b).cast("double"), F.lit(0.0))).alias(f"{a}_per_{b}"),
                (F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{a}_by_{b}")]
    return df.select("*", *out)


def category_flag(df: DataFrame, col: str, positive: Sequence, name: str | None = None) -> DataFrame:
    """1 when the category is one of ``positive``, 0 otherwise (NULL stays NULL)."""
    c = F.col(col)
    return df.withColumn(name or f"{col}_flag", F.when(c.isNull(), F.lit(None)).when(c.isin(*positive), 1).otherwise(0))
