"""Exact and approximate quantiles over many columns.

The exact path selects.  A mergeable sketch (``percentile_approx``) brackets each
requested order statistic, per group and column; a second scan counts what lies
below each bracket and a third keeps only the values inside, some four
thousandths of the rows per quantile, counted by value.  The two order
statistics are picked among those and interpolated linearly -- the ``linear``
rule of numpy/pandas and DuckDB's ``quantile_cont``.  The data are never sorted
or shuffled, a value that a third of all rows share is one row after counting,
and every rank is checked against the counts: where a bracket missed, all
values are counted and ranked by running sums instead.

``exact=False`` uses the sketch's own answer (one partial-aggregation pass).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order import _null_safe_join, running_sums

ACCURACY = 2000          # the sketch misses a rank by at most one in so many rows
SMALL = 8 * ACCURACY     # groups of so few rows are kept whole: their brackets' margins would be under a few ranks
WINDOW_ROWS = 1 << 20    # distinct values inside brackets that one window task may rank


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), name: str = "column",
            value: str = "value") -> DataFrame:
    """Long form (keep..., column, value) with values cast to double."""
    pairs = F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("double").alias("v")) for c in cols])
    return df.select(*keep, F.inline(pairs)).withColumnRenamed("n", name).withColumnRenamed("v", value)


def quantile_table(df: DataFrame, cols: Sequence[str], qs: Sequence[float], by: Sequence[str] = (),
                   exact: bool = True, prefix: str = "q") -> DataFrame:
    """One row per (by..., column) with a column ``{prefix}{i}`` per quantile ``qs[i]``.

    NULLs are ignored; a group with no values gets NULL quantiles (absent row).
    """
    by = list(by)
    long = unpivot(df, cols, by).where(F.col("value").isNotNull())
    names = [f"{prefix}{i}" for i in range(len(qs))]
    if not exact:
        agg = long.groupBy(*by, "column").agg(
            F.percentile_approx("value", list(map(float, qs)), 10000).alias("__q"))
        return agg.select(*by, "column", *[F.col("__q")[i].alias(n) for i, n in enumerate(names)])
    # the columns asked for are kept, in memory or spilled, while three scans read them: what they derive from may be dear
    src = df.select(*[F.col(b).alias(f"__g{i}") for i, b in enumerate(by)], *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])
    src = src.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = _selected(src, cols, qs, by, names)
    finally:
        src.unpersist()
    return _counted(long, qs, by, names) if found is None else found


def _selected(src: DataFrame, cols: Sequence[str], qs: Sequence[float], by: list[str], names: list[str]) -> DataFrame | None:
    """The quantiles of ``src`` (__g0.., __x0..) by brackets; None if a bracket missed its rank (or a value is NaN, which has no place in one)."""
    margin = 2.0 / ACCURACY
    ends = [max(0.0, q - margin) for q in qs] + [min(1.0, q + margin) for q in qs]
    group = [f"__g{i}" for i in range(len(by))]
    aggs = []
    for i in range(len(cols)):
        aggs += [F.count(f"__x{i}").alias(f"__n{i}"), F.percentile_approx(f"__x{i}", ends, ACCURACY).alias(f"__e{i}")]
    fit = src.groupBy(*group).agg(*aggs)
    if by:
        data = _null_safe_join(src, cut_lineage(fit), group)  # one row per group; read back from a table, its size decides how it is joined
        n, end = [F.col(f"__n{i}") for i in range(len(cols))], [[F.col(f"__e{i}")[k] for k in range(len(ends))] for i in range(len(cols))]
    else:
        row = fit.first()
        data = src
        n, end = [F.lit(row[f"__n{i}"]) for i in range(len(cols))], [[F.lit(v).cast("double") for v in row[f"__e{i}"] or [None] * len(ends)] for i in range(len(cols))]
    pairs = [(i, k) for i in range(len(cols)) for k in range(len(qs))]
    lo = {(i, k): F.when(n[i] > SMALL, end[i][k]).otherwise(F.lit(float("-inf"))) for i, k in pairs}
    hi = {(i, k): F.when(n[i] > SMALL, end[i][len(qs) + k]).otherwise(F.lit(float("inf"))) for i, k in pairs}
    x = {i: F.col(f"__x{i}") for i in range(len(cols))}
    below = data.groupBy(*group).agg(*[F.count_if(x[i] < lo[i, k]).alias(f"__b{i}_{k}") for i, k in pairs], *[F.count(x[i]).alias(f"__n{i}") for i in x])
    if not by:  # a row per column and quantile
        below = src.sparkSession.createDataFrame([below.first()], below.schema)
    below = below.select(*group, F.inline(F.array(*[F.struct(F.lit(i).alias("c"), F.lit(k).alias("k"), F.col(f"__b{i}_{k}").alias("below"), F.col(f"__n{i}").alias("n")) for i, k in pairs])))
    inside = {(i, k): x[i].between(lo[i, k], hi[i, k]) for i, k in pairs}
    some = F.lit(False)
    for cond in inside.values():
        some = some | F.coalesce(cond, F.lit(False))
    kept = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(i).alias("c"), F.lit(k).alias("k"), x[i].alias("value"))) for (i, k), cond in inside.items()]))
    keys = [*group, "c", "k"]
    values = cut_lineage(data.where(some).select(*group, F.inline(kept)).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("__c")))
    if values.count() <= WINDOW_ROWS:
        cum = values.withColumn("__end__c", F.sum("__c").over(Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    else:
        cum = running_sums(values, keys, ["value"], ["__c"], prefix="__end")
    at = F.element_at(F.array(*[F.lit(float(q)) for q in qs]), F.col("k") + 1) * (F.col("n") - 1)
    ranked = _null_safe_join(cum, below.where("n > 0"), keys).withColumn("at", at)
    to, begin = F.col("below") + F.col("__end__c"), F.col("below") + F.col("__end__c") - F.col("__c")

    def value(rank):
        return F.max(F.when((rank >= begin) & (rank < to), F.col("value")))

    one = ranked.groupBy(*keys).agg(value(F.floor("at")).alias("lo"), value(F.ceil("at")).alias("hi"), F.first(F.col("at") - F.floor("at")).alias("f"))
    # a pair without any value inside its bracket is a miss as well
    one = _null_safe_join(below.where("n > 0").select(*[F.col(c).alias(f"__k{j}") for j, c in enumerate(keys)]),
                          one.withColumnsRenamed({c: f"__k{j}" for j, c in enumerate(keys)}), [f"__k{j}" for j in range(len(keys))], "left")
    one = one.withColumnsRenamed({f"__k{j}": c for j, c in enumerate(keys)})
    if by:
        one = cut_lineage(one)
        missed = not one.where("lo is null or hi is null").isEmpty()
    else:
        rows = one.collect()
        one, missed = src.sparkSession.createDataFrame(rows, one.schema), any(r["lo"] is None or r["hi"] is None for r in rows)
    if missed:
        return None
    quantile = F.col("lo") + F.col("f") * (F.col("hi") - F.col("lo"))
    column = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("c") + 1).alias("column")
    out = one.groupBy(*group, "c").agg(*[F.max(F.when(F.col("k") == k, quantile)).alias(name) for k, name in enumerate(names)])
    return out.select(*[F.col(g).alias(b) for g, b in zip(group, by, strict=True)], column, *names)


def _counted(long: DataFrame, qs: Sequence[float], by: list[str], names: list[str]) -> DataFrame:
    """The quantiles by counting every value: running sums over the counted values give each value's span of ranks."""
    keys = [*by, "column"]
    counts = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("__c"))
    cum = running_sums(counts, keys, ["value"], ["__c"], prefix="__end")
    # the group's size is its last running sum; a value spans the ranks [__end - __c, __end)
    sizes = cum.groupBy(*keys).agg(F.max("__end__c").alias("__n"))
    kept = _null_safe_join(cum, sizes, keys).withColumn("__from", F.col("__end__c") - F.col("__c"))

    def at(rank):
        return (rank >= F.col("__from")) & (rank < F.col("__end__c"))

    pos = [F.lit(float(q)) * (F.col("__n") - 1) for q in qs]
    some = F.lit(False)
    for p in pos:
        some = some | at(F.floor(p)) | at(F.ceil(p))
    aggs = []
    for i, p in enumerate(pos):
        aggs.append(F.max(F.when(at(F.floor(p)), F.col("value"))).alias(f"__lo{i}"))
        aggs.append(F.max(F.when(at(F.ceil(p)), F.col("value"))).alias(f"__hi{i}"))
        aggs.append(F.first(p - F.floor(p)).alias(f"__f{i}"))
    kept = kept.where(some)
    g = kept.groupBy(*by, "column").agg(*aggs)
    out = [F.col(f"__lo{i}") + F.col(f"__f{i}") * (F.col(f"__hi{i}") - F.col(f"__lo{i}")) for i in range(len(qs))]
    return g.select(*by, "column", *[o.alias(n) for o, n in zip(out, names)])


def quantile_row(df: DataFrame, cols: Sequence[str], q: float, exact: bool = True) -> DataFrame:
    """One-row DataFrame: column name -> its ``q`` quantile (for broadcast fits)."""
    t = quantile_table(df, cols, [q], exact=exact)
    return t.groupBy().pivot("column", list(cols)).agg(F.first("q0"))


def median_row(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    return quantile_row(df, cols, 0.5, exact)
