"""Nearest neighbours in many columns: random projection trees with exact distances and a measured recall.

A tree's leaf is the sides a point lies on of random hyperplanes through the columns' medians.  Points
are sorted by leaf and then along one more direction, and consecutive blocks of a fixed size are compared
as a whole, so no leaf is too large whatever the data hold.  Each tree adds its blocks' best pairs; recall is
measured on a sample of points against all, and trees are added until it reaches what was asked for.  Where
hyperplanes part what is near (many columns without structure), all points can be compared in tiles instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_partitions
from .blocks import matrix, square_distances

BLOCK = 256      # consecutive points compared with each other
BITS = 30        # hyperplanes of a tree
AUDIT = 256      # points that recall is measured on
TREES, MOST_TREES = 8, 64
TILE = 1 << 15   # points on each side of a tile, at most


def _planes(seed: int, dims: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(BITS + 1, dims))


def _leaves(seeds: list[int], middle: list[float]):
    """Each point under its leaf in every tree, and its place along one more direction."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("x"))
            if not len(x):
                continue
            for seed in seeds:
                side = (x - np.array(middle)) @ _planes(seed, x.shape[1]).T
                leaf = ((side[:, :BITS] > 0) * (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), seed, np.int64)), pa.array(leaf), pa.array(side[:, BITS]), b.column("id"), b.column("x")],
                                                 names=["tree", "leaf", "place", "id", "x"])
    return run


def _best(ids: np.ndarray, x: np.ndarray, k: int):
    """The k nearest of each row among the others: few by the product formula, those exactly."""
    d = square_distances(x, x)
    np.fill_diagonal(d, np.inf)
    most = min(len(x) - 1, k + 4)
    who = np.repeat(np.arange(len(x)), most)
    other = np.argpartition(d, most - 1, axis=1)[:, :most].ravel()
    exact = np.sqrt(((x[who] - x[other]) ** 2).sum(axis=1))
    order = np.lexsort((ids[other], exact, who))
    kept = order[np.arange(len(order)) % most < k]
    return ids[who[kept]], ids[other[kept]], exact[kept]


def _pairs(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, tree = 0, None
        for b in batches:
            trees = b.column("tree").to_numpy()
            while b.num_rows:
                if trees[0] != tree:  # a block is of one tree
                    if rows > 1:
                        yield compared(held)
                    held, rows, tree = [], 0, trees[0]
                part = b.slice(0, min(BLOCK - rows, int((trees == tree).sum())))  # sorted by tree
                b, trees = b.slice(part.num_rows), trees[part.num_rows:]
                held.append(part)
                rows += part.num_rows
                if rows == BLOCK:
                    yield compared(held)
                    held, rows = [], 0
        if rows > 1:
            yield compared(held)

    def compared(held):
        t = pa.Table.from_batches(held)
        a, b, d = _best(t.column("id").to_numpy(), matrix(t.column("x")), k)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(d)], names=["a", "b", "dist"])
    return run


def _asked(ids: list[int], x: bytes, dims: int, k: int):
    """The k nearest of each sampled point among a task's points."""
    q, name = np.frombuffer(x, np.float64).reshape(-1, dims), np.array(ids, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y, other = matrix(b.column("x")), b.column("id").to_numpy()
            for s in range(0, len(y), 4096):
                d = square_distances(q, y[s: s + 4096])
                d[name[:, None] == other[None, s: s + 4096]] = np.inf
                most = min(d.shape[1], k + 4)
                at = np.argpartition(d, most - 1, axis=1)[:, :most]
                who, at = np.repeat(np.arange(len(q)), most), at.ravel()
                ok = np.isfinite(d[who, at])
                who, at = who[ok], at[ok]
                yield pa.RecordBatch.from_arrays([pa.array(name[who]), pa.array(other[s + at]), pa.array(np.sqrt(((q[who] - y[s + at]) ** 2).sum(axis=1)))], names=["a", "b", "dist"])
    return run


def _nearest_of(ix: np.ndarray, x: np.ndarray, iy: np.ndarray, y: np.ndarray, k: int):
    """(place in x, id, distance) of the k nearest rows of y, others than itself, of each row of x: exact, equal ones by id."""
    whos, ids, dists = [], [], []
    scale = (y * y).sum(axis=1).max(initial=0)
    for s in range(0, len(x), 512):
        q, name = x[s: s + 512], ix[s: s + 512]
        slack = 1e-12 * (scale + (q * q).sum(axis=1)) * (8 + x.shape[1])  # what the product formula may be off by
        bound = np.full(len(q), np.inf)
        who, other, far = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for t in range(0, len(y), 4096):
            d = square_distances(q, y[t: t + 4096])
            d[name[:, None] == iy[None, t: t + 4096]] = np.inf
            limit = bound
            if k < d.shape[1]:
                limit = np.minimum(limit, np.partition(d, k - 1, axis=1)[:, k - 1]) if not len(who) else limit
            a, b = np.nonzero((d <= (limit + 2 * slack)[:, None]) & np.isfinite(d))
            b += t
            who, other = np.concatenate([who, a]), np.concatenate([other, b])
            far = np.concatenate([far, np.sqrt(((q[a] - y[b]) ** 2).sum(axis=1))])
            order = np.lexsort((iy[other], far, who))
            who, other, far = who[order], other[order], far[order]
            kept = np.arange(len(who)) - np.searchsorted(who, who) < k
            who, other, far = who[kept], other[kept], far[kept]
            held = np.bincount(who, minlength=len(q))
            full = held == k
            bound[full] = far[np.cumsum(held)[full] - 1] ** 2
        whos.append(who + s)
        ids.append(iy[other])
        dists.append(far)
    return np.concatenate(whos), np.concatenate(ids), np.concatenate(dists)


def _tile(k: int):
    def run(group: pa.Table) -> pa.Table:
        side, ids, x = group["side"].to_numpy(), group["id"].to_numpy(), matrix(group["x"])
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        asks = [(one, one)] if group["i"][0].as_py() == group["j"][0].as_py() else [(one, two), (two, one)]
        parts = []
        for p, b in asks:
            if len(p) and len(b):
                who, other, d = _nearest_of(ids[p], x[p], ids[b], x[b], k)
                parts.append(pa.table({"a": ids[p][who], "b": other, "dist": d}))
        return pa.concat_tables(parts) if parts else pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "dist": pa.array([], pa.float64())})
    return run


def _all_pairs(pts: DataFrame, n: int, k: int) -> DataFrame:
    """The k nearest of each point among all, in tiles of at most about ``TILE`` points by as many; each tile serves both its sides.

    The work is quadratic; a task holds two blocks of points, and puts out k rows for each of them.
    """
    parts = shuffle_partitions(pts.sparkSession)
    blocks = max(-(-n // TILE), min(-(-n // 2048), math.isqrt(4 * parts) + 1))
    own = pts.select("id", "x", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("g"))
    tiles = own.select("id", "x", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("h"))
    tiles = tiles.select("id", "x", F.least("g", "h").alias("i"), F.greatest("g", "h").alias("j"), F.when(F.col("g") <= F.col("h"), 0).otherwise(1).alias("side"))
    spread = tiles.repartition(min(4096, max(parts, blocks * (blocks + 1) // 2)), "i", "j")
    return _shortest(spread.groupBy("i", "j").applyInArrow(_tile(k), "a long, b long, dist double"), k)


def _out_of_reach(seen: float, recall: float, rounds: int, most: int) -> bool:
    """Whether ``most`` rounds would stay below ``recall`` by far if each found the same share of what is left as those so far."""
    return seen < 1 and recall < 1 and (seen <= 0 or rounds * math.log(1 - recall) / math.log(1 - seen) > 1.5 * most)


def _shortest(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest of each point, equal distances by the smaller neighbour."""
    one = pairs.groupBy("a", "b").agg(F.min("dist").alias("dist"))
    near = Window.partitionBy("a").orderBy("dist", "b")
    return one.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k)


def knn_projected(points: DataFrame, key: str, k: int, x: str = "x", recall: float = 0.9, trees: int = TREES, seed: int = 1,
                  or_all: bool = False) -> tuple[DataFrame, float]:
    """Approximate k nearest neighbours: (key, nbr, rank, dist), and the recall measured.

    For points of many columns, where a box or cell tells little; :func:`.distance.knn` is exact in few.  ``key`` is a
    unique integer; neighbours of a point are other rows.  Distances are exact.  Recall is the share of the true k
    nearest (or others as near as the k-th) found for ``AUDIT`` points taken by hash, compared with all points.
    ``trees`` at a time are added, up to ``MOST_TREES``; if recall stays below ``recall`` then, it raises.  With
    ``or_all`` it does not: where they do not, or are far from it, all points are compared (recall 1).
    """
    pts = cut_lineage(points.select(F.col(key).cast("long").alias("id"), F.col(x).cast("array<double>").alias("x")))
    first = pts.first()
    kind = points.schema[key].dataType
    if first is None:
        return points.sparkSession.createDataFrame([], f"`{key}` {kind.simpleString()}, nbr {kind.simpleString()}, rank int, dist double"), 1.0
    dims = len(first["x"])
    middle = list(pts.agg(*[F.percentile_approx(F.col("x")[j], 0.5, 1000) for j in range(dims)]).first())
    asked = pts.orderBy(F.xxhash64("id"), "id").limit(AUDIT).collect()
    queries = np.array([r["x"] for r in asked], np.float64).tobytes()
    truth = pts.mapInArrow(_asked([r["id"] for r in asked], queries, dims, k), "a long, b long, dist double")
    truth = cut_lineage(_shortest(truth, k).groupBy("a").agg(F.max("dist").alias("far"), F.count(F.lit(1)).alias("n")))
    # ranges of many blocks each, so that few points stand alone at a range's edge
    n = pts.count()
    rows = n * trees
    parts = max(1, min(rows // (8 * BLOCK), max(shuffle_partitions(points.sparkSession), rows * dims * 8 >> 27)))
    found, done = None, 0
    while True:
        seeds = [seed * 1_000_003 + t for t in range(done, done + trees)]
        sorted_points = pts.mapInArrow(_leaves(seeds, middle), "tree long, leaf long, place double, id long, x array<double>")
        sorted_points = sorted_points.repartitionByRange(parts, "tree", "leaf", "place", "id").sortWithinPartitions("tree", "leaf", "place", "id")
        new = sorted_points.mapInArrow(_pairs(k), "a long, b long, dist double").where("a <> b")
        found = cut_lineage(_shortest(new if found is None else new.unionByName(found.drop("rank")), k))
        hit = truth.join(found.where(F.col("rank") <= k), "a", "left").groupBy("a").agg(
            F.first("n").alias("n"), F.sum(F.when(F.col("dist") <= F.col("far") * (1 + 1e-12), 1).otherwise(0)).alias("hit"))
        total = hit.agg(F.sum("n"), F.sum(F.least("n", "hit"))).first()
        seen, done = (total[1] / total[0] if total[0] else 1.0), done + trees
        if seen >= recall:
            break
        if or_all and (done >= MOST_TREES or _out_of_reach(seen, recall, done // trees, MOST_TREES // trees)):
            found, seen = cut_lineage(_all_pairs(pts, n, k)), 1.0
            break
        if done >= MOST_TREES:
            raise RuntimeError(f"{done} trees found {seen:.3f} of the nearest neighbours, less than {recall}")
    return found.select(F.col("a").cast(kind).alias(key), F.col("b").cast(kind).alias("nbr"), "rank", "dist"), seen
