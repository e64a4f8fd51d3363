"""Skew-safe ordering primitives.

A window ``partitionBy(g).orderBy(o)`` puts every row of one group into a
single task; if one group holds a third of the data that task holds a third of
the data.  The helpers below compute the same row numbers without that
bottleneck:

1. range-partition on the full sort key (group, order..., tie-breaker), so a
   hot group is spread over many range partitions by its order columns;
2. number rows inside each partition (``monotonically_increasing_id`` keeps the
   in-partition position in its low 33 bits);
3. aggregate a small table with one row per (partition, group) -- at most
   #groups + #partitions rows -- and turn it into per-partition offsets with a
   window over that small table;
4. add the offset back with a join keyed on (partition, group), a key that
   splits hot groups, so it does not skew either.

The order columns must define a total order (end them with the row key).
Range boundaries are sampled per execution, so the positioned table is cut
with a reliable checkpoint (the shared ``spark.checkpoint.dir``) before its two
uses read it; pass only the narrow columns you need.  When the caller has a
deterministic, order-preserving bucket column (e.g. a uniform hash for
splits), ``bucket=`` skips the checkpoint: rows are numbered by a window over
(group, bucket), which splits a hot group into many tasks as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

WINDOW_ROWS = 1 << 20  # rows of a group that one window task takes
_PID = "__pid"
_LOCAL = "__local"


def attach_row(df: DataFrame, row: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Append the columns of the one-row table ``row`` to every row of ``df``.

    Each column becomes a scalar subquery: Spark evaluates ``row`` once, fails
    the query if it yields more than one row (the size bound is enforced, not
    assumed), and inlines the value -- no join, no broadcast of a table.
    Subqueries over the same plan are merged into one by the optimizer.
    An empty ``row`` attaches NULLs.
    """
    names = list(cols) if cols is not None else row.columns
    return df.select("*", *[row.select(c).scalar().alias(c) for c in names])


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _positioned(df: DataFrame, sort_cols: Sequence, num_partitions: int | None) -> DataFrame:
    # Without an explicit count the range exchange starts from the session's
    # partition count (spark.sql.adaptive.coalescePartitions.initialPartitionNum,
    # else spark.sql.shuffle.partitions) and AQE merges adjacent small ranges,
    # which keeps them in order; spark_partition_id() then numbers the merged
    # ranges.  Size it for the cluster there, not from a plan estimate (the
    # optimizer's estimate of a join is the product of its inputs).
    sort = _cols(sort_cols)
    ranged = df.repartitionByRange(num_partitions, *sort) if num_partitions else df.repartitionByRange(*sort)
    positioned = (
        ranged
        .sortWithinPartitions(*sort)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_LOCAL, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
    )
    return cut_lineage(positioned)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    cond = None
    r = right
    renamed = []
    for k in keys:
        rk = f"__r_{k}"
        r = r.withColumnRenamed(k, rk)
        renamed.append(rk)
        c = left[k].eqNullSafe(r[rk])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*renamed)


def global_index(df: DataFrame, order_cols: Sequence, name: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row in the global order."""
    d = _positioned(df, order_cols, num_partitions)
    counts = d.groupBy(_PID).agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition: size bounded by the partition count
    offsets = counts.select(_PID, F.coalesce(F.sum("__cnt").over(w), F.lit(0)).alias("__off"))
    return (
        d.join(F.broadcast(offsets), _PID)
        .withColumn(name, F.col("__off") + F.col(_LOCAL))
        .drop(_PID, _LOCAL, "__off")
    )


def rank_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, name: str = "rn",
                size_name: str | None = None, num_partitions: int | None = None,
                bucket: Column | None = None) -> DataFrame:
    """Add ``name``: 0-based row number inside each group in ``order_cols`` order.

    Equivalent to ``row_number() over (partition by group order by order) - 1``
    but without funnelling a hot group into one task.  ``size_name`` also adds
    the group size.
    """
    group_cols = list(group_cols)
    if bucket is not None:
        return _rank_bucketed(df, group_cols, order_cols, name, size_name, bucket)
    if not group_cols:
        out = global_index(df, order_cols, name, num_partitions)
        if size_name:
            out = attach_row(out, df.agg(F.count(F.lit(1)).alias(size_name)))
        return out
    d = _positioned(df, [*group_cols, *order_cols], num_partitions)
    g = d.groupBy(_PID, *group_cols).agg(
        F.min(_LOCAL).alias("__first"), F.count(F.lit(1)).alias("__cnt"))
    wg = Window.partitionBy(*group_cols).orderBy(_PID)
    g = g.withColumn(
        "__before",
        F.coalesce(F.sum("__cnt").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    keep = [_PID, *group_cols, "__first", "__before"]
    if size_name:
        g = g.withColumn(size_name, F.sum("__cnt").over(Window.partitionBy(*group_cols)))
        keep.append(size_name)
    g = g.select(*keep)
    out = _null_safe_join(d, g, [_PID, *group_cols])
    return (
        out.withColumn(name, F.col("__before") + F.col(_LOCAL) - F.col("__first"))
        .drop(_PID, _LOCAL, "__first", "__before")
    )


def previous_row(df: DataFrame, by: Sequence[str], order_cols: Sequence[str], value_cols: Sequence[str],
                 prefix: str = "prev_", window_rows: int | None = None) -> DataFrame:
    """Attach ``prefix+col`` = the value of the preceding row of the same ``by`` group.

    Same result as ``lag(col).over(partitionBy(by).orderBy(order))`` (order must
    be total).  Groups of up to ``window_rows`` rows (``spark.tessera.windowRows``)
    take just that window: one exchange of the table.  A count that combines before
    its shuffle finds the larger ones, of which there are at most rows / window_rows;
    theirs, and the one sequence of ``by=[]``, are spread over range partitions
    (:func:`_previous_in_ranges`).
    """
    by = list(by)
    if not by:
        return _previous_in_ranges(df, by, order_cols, value_cols, prefix)
    limit = window_rows or int(df.sparkSession.conf.get("spark.tessera.windowRows", str(WINDOW_ROWS)))
    large = cut_lineage(df.groupBy(*by).agg(F.count(F.lit(1)).alias("__c")).where(F.col("__c") > limit).select(*[F.col(c).alias(f"__l_{c}") for c in by]))
    w = Window.partitionBy(*by).orderBy(*_cols(order_cols))

    def lagged(rows):
        return rows.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in value_cols])

    if large.isEmpty():
        return lagged(df)
    hot = F.lit(True)
    for c in by:
        hot = hot & F.col(c).eqNullSafe(F.col(f"__l_{c}"))
    small = lagged(df.join(large, hot, "left_anti"))
    return small.unionByName(_previous_in_ranges(df.join(large, hot, "left_semi"), by, order_cols, value_cols, prefix))


def _previous_in_ranges(df: DataFrame, by: list[str], order_cols: Sequence[str], value_cols: Sequence[str], prefix: str) -> DataFrame:
    """``previous_row`` by range partitions: a window over each, and its first row patched from the range before.

    The range-partitioned rows are written, so both uses see the same ranges; the patch has one row per range.
    """
    d = _positioned(df, [*by, *order_cols], None)
    w = Window.partitionBy(_PID).orderBy(_LOCAL)
    carried = [*by, *value_cols]
    ends = d.groupBy(_PID).agg(*[F.max_by(c, _LOCAL).alias(f"__e{i}") for i, c in enumerate(carried)])
    before = Window.orderBy(_PID)  # a row per range
    patch = ends.select(F.lead(_PID).over(before).alias(_PID), *[f"__e{i}" for i in range(len(carried))]).where(F.col(_PID).isNotNull()).withColumn("__patched", F.lit(True))
    j = d.select("*", *[F.lag(c).over(w).alias(f"__b{i}") for i, c in enumerate(carried)]).join(F.broadcast(patch), _PID, "left")
    first = F.col(_LOCAL) == 0

    def earlier(i):
        return F.when(first, F.col(f"__e{i}")).otherwise(F.col(f"__b{i}"))

    same = ~first | F.col("__patched").isNotNull()
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(earlier(i))
    return j.select(*df.columns, *[F.when(same, earlier(len(by) + i)).alias(prefix + c) for i, c in enumerate(value_cols)])


def top1_by(df: DataFrame, group_cols: Sequence[str], value_col: str, count_col: str = "n",
            name: str = "mode") -> DataFrame:
    """Most frequent ``value_col`` per group, ties to the smallest value.

    A count per (group, value) is pre-aggregated map-side, then the winner is
    a plain ``min(struct(-n, value))`` -- a combinable aggregate, so a hot
    group is reduced in partial aggregates, never buffered in one task.
    """
    counts = df.where(F.col(value_col).isNotNull()).groupBy(*group_cols, value_col).agg(
        F.count(F.lit(1)).alias(count_col))
    best = counts.groupBy(*group_cols).agg(
        F.min(F.struct((-F.col(count_col)).alias("k"), F.col(value_col).alias("v"))).alias("__b"))
    return best.select(*group_cols, F.col("__b.v").alias(name), (-F.col("__b.k")).alias(count_col))


def _rank_bucketed(df: DataFrame, group_cols: list[str], order_cols: Sequence, name: str,
                   size_name: str | None, bucket: Column) -> DataFrame:
    """Row numbers from a window over (group, bucket) plus bucket offsets.

    ``bucket`` must be deterministic and non-decreasing in ``order_cols``.
    """
    d = df.withColumn("__b", bucket)
    w = Window.partitionBy(*group_cols, "__b").orderBy(*_cols(order_cols))
    d = d.withColumn(_LOCAL, F.row_number().over(w) - 1)
    g = d.groupBy(*group_cols, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    wg = Window.partitionBy(*group_cols).orderBy("__b") if group_cols else Window.orderBy("__b")
    g = g.withColumn(
        "__before",
        F.coalesce(F.sum("__cnt").over(wg.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    keep = [*group_cols, "__b", "__before"]
    if size_name:
        wa = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
        g = g.withColumn(size_name, F.sum("__cnt").over(wa))
        keep.append(size_name)
    out = _null_safe_join(d, g.select(*keep), [*group_cols, "__b"])
    return out.withColumn(name, F.col("__before") + F.col(_LOCAL)).drop("__b", _LOCAL, "__before")


def uniform_bucket(u: Column, num_buckets: int) -> Column:
    """Order-preserving bucket of a value uniform on [0, 1)."""
    return F.least(F.floor(u * num_buckets), F.lit(num_buckets - 1)).cast("int")


def running_sums(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence, value_cols: Sequence[str],
                 prefix: str = "cum_", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` within each group in ``order_cols`` order.

    Same as ``sum(v) over (partition by g order by o rows unbounded preceding)``
    but a hot group (or no group at all) is spread over range partitions: each
    partition sums locally, and a small (partition, group) table supplies the
    totals of all earlier partitions.
    """
    group_cols = list(group_cols)
    d = _positioned(df, [*group_cols, *order_cols], num_partitions)
    g = d.groupBy(_PID, *group_cols).agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols])
    wg = (Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()).orderBy(_PID) \
        .rowsBetween(Window.unboundedPreceding, -1)
    g = g.select(_PID, *group_cols, *[F.coalesce(F.sum(f"__t_{v}").over(wg), F.lit(0)).alias(f"__o_{v}")
                                      for v in value_cols])
    wl = Window.partitionBy(_PID, *group_cols).orderBy(_LOCAL).rowsBetween(Window.unboundedPreceding, 0)
    local = d.select("*", *[F.sum(v).over(wl).alias(f"__l_{v}") for v in value_cols])
    out = _null_safe_join(local, g, [_PID, *group_cols])
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"__l_{v}") + F.col(f"__o_{v}")).alias(prefix + v) for v in value_cols])
