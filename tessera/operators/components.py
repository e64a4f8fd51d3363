"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One star round on (u, v), v < u.  Minima are combined before the shuffle; only joins, no lists."""
    if small:  # every u hands its smaller neighbours and itself to the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    else:  # every u hands its larger neighbours to the smallest node it knows
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u > v").distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """No node has two smaller neighbours, and none has a smaller and a larger one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("low"), F.lit(0).alias("high")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("low"), F.lit(1).alias("high")))
    per = ends.groupBy("node").agg(F.sum("low").alias("low"), F.max("high").alias("high"))
    return per.where("low + high > 1 and low > 0").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; component is the smallest node reachable.

    Links may repeat, run in either direction or join a node with itself; nulls link nothing.  Each round
    is cut to the shared folder; the rounds end when every component is a star about its smallest node.
    """
    edges = cut_lineage(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while not _is_star_forest(edges):
        edges = cut_lineage(_star(_star(edges, small=False), small=True))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
