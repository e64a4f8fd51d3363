"""Clustering (K1-K20) on ``(key, x array<double>)`` point tables.

* centroid methods (k-means, fuzzy c-means, nearest centre) keep the centres as
  bounded literals; each iteration is a fresh plan over the cached points, so
  lineage never grows;
* DBSCAN works on grid cells whose diagonal is eps: a dense cell's points are
  core and connected without being paired, sparse points ask for their nearest
  locations (:mod:`.distance`), and cells are linked by halving their boxes;
* subtractive potentials are added up by cells (:mod:`.gauss`), of few or thinly spread points in tiles of all pairs;
* Ward works on weighted k-means micro-clusters (a bounded set), then maps
  the merge back with a join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_partitions
from .components import components
from .blocks import matrix, square_distances
from .distance import _cell, _offsets, dist, nearest_lists, sq_dist
from .gauss import gauss_sums
from .lloyd import SAMPLE, first_centres, lloyd, sample_points
from .order import attach_row, global_index


# ---------------------------------------------------------------- centres
def centres_frame(spark, centres: Sequence[Sequence[float]]) -> DataFrame:
    return spark.createDataFrame([(i, [float(v) for v in c]) for i, c in enumerate(centres)],
                                 "cluster int, centre array<double>")


def _centre_array(centres: Sequence[Sequence[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])


def assign_nearest(points: DataFrame, key: str, centres: Sequence[Sequence[float]], x: str = "x",
                   name: str = "cluster") -> DataFrame:
    """(key, cluster) = index of the nearest centre (ties -> lowest index).

    Centres are literals (k x d numbers), so this is a narrow projection.
    """
    return points.select(key, _nearest_index(F.col(x), centres).alias(name))


def _nearest_index(x: Column, centres: Sequence[Sequence[float]]) -> Column:
    d = F.transform(_centre_array(centres), lambda c: sq_dist(x, c))
    best = F.array_min(F.transform(F.arrays_zip(d.alias("d"), F.sequence(F.lit(0), F.lit(len(centres) - 1)).alias("i")),
                                   lambda s: F.struct(s["d"].alias("d"), s["i"].alias("i"))))
    return best["i"].cast("int")


def centroids(points: DataFrame, labels: DataFrame, key: str, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """K5: (cluster, n, centre) mean vector per cluster (noise -1 excluded)."""
    j = points.join(labels, key).where(F.col(cluster) >= 0)
    dims = len(points.select(x).first()[0])
    return j.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                  F.array(*[F.avg(F.col(x)[i]) for i in range(dims)]).alias("centre"))


def inertia(points: DataFrame, labels: DataFrame, centres: DataFrame, key: str, x: str = "x",
            cluster: str = "cluster") -> DataFrame:
    """K2: sum of squared distances of each point to its own centre."""
    j = points.join(labels, key).join(centres.select(cluster, "centre"), cluster)  # its size decides how it is joined
    return j.agg(F.sum(sq_dist(F.col(x), F.col("centre"))).alias("inertia"))


def cluster_sizes(labels: DataFrame, cluster: str = "cluster") -> DataFrame:
    """K4: (cluster, n); -1 is noise."""
    return labels.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def _ordered_centres(centres) -> list[list[float]]:
    """Canonical order (lexicographic) so ids do not depend on the solver's seed."""
    return sorted([list(map(float, c)) for c in centres])


def kmeans(points: DataFrame, key: str, k: int, n_init: int = 15, seed: int = 42, x: str = "x",
           max_iter: int = 300, tol: float = 1e-4) -> tuple[DataFrame, list[list[float]], float]:
    """K1: best of ``n_init`` runs of Lloyd's algorithm (lowest inertia), all of them in the same scans.

    Returns (labels(key, cluster), centres sorted lexicographically, inertia).
    """
    centres, cost = _best_runs(points, key, [k], n_init, seed, x, max_iter, tol)[k]
    return assign_nearest(points, key, centres, x), centres, cost


def _best_runs(points: DataFrame, key: str, ks: Sequence[int], n_init: int, seed: int, x: str, max_iter: int = 300,
               tol: float = 1e-4) -> dict[int, tuple[list[list[float]], float]]:
    """(centres, inertia) of the best run for each k; one scan a round serves every run of every k."""
    sample = sample_points(points, key, x, max(SAMPLE, 4 * max(ks)))
    if not len(sample):
        raise ValueError("no points to cluster")
    plan = [(k, seed + i) for k in ks for i in range(1 if k == 1 else n_init)]
    runs = lloyd(points, [first_centres(sample, k, s) for k, s in plan], x, max_iter, tol)
    best: dict[int, tuple[list[list[float]], float]] = {}
    for (k, _), (centres, cost, _) in zip(plan, runs):
        if k not in best or cost < best[k][1]:
            best[k] = (_ordered_centres(centres.tolist()), cost)
    return best


def elbow_sweep(points: DataFrame, key: str, ks: Sequence[int], seed: int = 42, x: str = "x",
                n_init: int = 15) -> DataFrame:
    """K3: (k, inertia, silhouette) for each k (silhouette NULL for k = 1).  All runs of all k share their scans."""
    rows, points = [], cut_lineage(points.select(key, x))  # what they derive from is read once
    for k, (centres, cost) in sorted(_best_runs(points, key, ks, n_init, seed, x).items()):
        sil = _mean_silhouette(points.where(F.col(key).isNotNull()).select(x, _nearest_index(F.col(x), centres).alias("cluster")), x, "cluster").first()["silhouette"] if k > 1 else None
        rows.append((int(k), float(cost), None if sil is None else float(sil)))
    return points.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


# ---------------------------------------------------------------- fuzzy c-means
def memberships(x: Column, centres: Sequence[Sequence[float]], m: float) -> Column:
    """u_j = 1 / sum_k (d_j / d_k)^(2/(m-1)), computed on ratios to the row minimum.

    With m near 1 the exponent is large, so distances are divided by the
    smallest one first (no overflow); a zero distance gets membership 1.
    """
    p = 2.0 / (m - 1.0)

    def inverse(d, dmin):
        return F.transform(d, lambda v: F.when(dmin == 0, F.when(v == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
                           .otherwise(F.pow(dmin / v, F.lit(p))))
    inv = _once(F.transform(_centre_array(centres), lambda c: F.sqrt(sq_dist(x, c))), lambda d: _once(F.array_min(d), lambda dmin: inverse(d, dmin)))
    return _once(inv, lambda v: _once(F.aggregate(v, F.lit(0.0), lambda a, b: a + b), lambda tot: F.transform(v, lambda one: one / tot)))


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once: inside a lambda a plain column is worked out for every element."""
    return F.transform(F.array(value), then)[0]


def fuzzy_cmeans(points: DataFrame, key: str, c: int, m: float = 1.3, tol: float = 1e-5,
                 max_iter: int = 1000, seed: int = 42, x: str = "x",
                 init: Sequence[Sequence[float]] | None = None, rounds: int | None = None) -> tuple[DataFrame, list[list[float]], int]:
    """K6: soft memberships.  Returns ((key, u, cluster, max_u), centres, iterations).

    Starts from k-means centres (or ``init``), then alternates membership
    (row-local array expression) and weighted centre update (one aggregate)
    until no centre moves more than ``tol``; raises when ``max_iter`` rounds do not suffice.  ``rounds`` runs
    just so many instead.
    """
    pts = points.select(key, x).cache()
    centres = list(init) if init is not None else kmeans(pts, key, c, 1, seed, x)[1]
    dims = len(centres[0])
    it = 0
    for it in range(1, (max_iter if rounds is None else rounds) + 1):
        u = memberships(F.col(x), centres, m)
        w = pts.select(x, F.transform(u, lambda v: F.pow(v, F.lit(m))).alias("__w"))
        aggs = []
        for j in range(c):
            aggs.append(F.sum(F.col("__w")[j]).alias(f"s{j}"))
            aggs += [F.sum(F.col("__w")[j] * F.col(x)[i]).alias(f"c{j}_{i}") for i in range(dims)]
        r = w.agg(*aggs).first()
        new = [[(r[f"c{j}_{i}"] / r[f"s{j}"]) if r[f"s{j}"] else centres[j][i] for i in range(dims)]
               for j in range(c)]
        shift = max(math.dist(a, b) for a, b in zip(centres, new))
        centres = new
        if shift < tol and rounds is None:
            break
    else:
        if rounds is None:
            raise RuntimeError(f"fuzzy c-means moved by {shift:.3g} in round {max_iter}; raise max_iter or tol")
    centres = _ordered_centres(centres) if rounds is None else centres
    u = memberships(F.col(x), centres, m)
    out = pts.select(key, u.alias("u")).select(key, "u", *hard_from_soft(F.col("u")))
    return out, centres, it


def hard_from_soft(u: Column) -> list[Column]:
    """K8: cluster = argmax (0-based), max_u = largest membership."""
    mx = F.array_max(u)
    return [(F.array_position(u, mx) - 1).cast("int").alias("cluster"), mx.alias("max_u")]


def fpc(soft: DataFrame, u: str = "u") -> DataFrame:
    """K7: fuzzy partition coefficient = mean over rows of sum_j u_ij^2."""
    return soft.agg(F.avg(F.aggregate(F.col(u), F.lit(0.0), lambda a, v: a + v * v)).alias("fpc"))


# ---------------------------------------------------------------- subtractive
TILE = 1 << 14    # locations on each side of a tile of potentials
TILES = 16        # cuts of the locations, if no side grows beyond ``SIDE_MOST``: each location is sent to as many tiles
SIDE_MOST = 1 << 20
FEW = 1 << 16     # locations up to which all pairs are less work than cells


def _tile_sums(alpha: float):
    def run(group: pa.Table) -> pa.Table:
        side, ids = group["side"].to_numpy(), group["id"].combine_chunks()
        x, w = matrix(group["x"]), group["w"].to_numpy().astype(np.float64)
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = group["i"][0].as_py() == group["j"][0].as_py()
        p, other = np.zeros(len(x)), one if same else two
        for s in range(0, len(one), 256):
            at = one[s: s + 256]
            for t in range(0, len(other), TILE):
                to = other[t: t + TILE]
                near = np.exp(-alpha * square_distances(x[at], x[to]))
                p[at] += near @ w[to]
                if not same:
                    p[to] += w[at] @ near
        return pa.table({"id": ids, "p": p})
    return run


def _tile_potentials(loc: DataFrame, count: int, key: str, alpha: float, x: str) -> DataFrame:
    """The potentials by all pairs: a location is sent to ``TILES`` tiles, or as many as their sides need to stay in memory."""
    n = max(min(-(-count // TILE), TILES), -(-count // SIDE_MOST)) or 1
    own = loc.select(F.col(key).alias("id"), F.col(x).alias("x"), F.col("__w").alias("w"), F.pmod(F.xxhash64(x), F.lit(n)).alias("g"))
    tiles = own.select("id", "x", "w", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("h"))
    tiles = tiles.select("id", "x", "w", F.least("g", "h").alias("i"), F.greatest("g", "h").alias("j"), F.when(F.col("g") <= F.col("h"), 0).otherwise(1).alias("side"))
    kind = loc.schema[key].dataType.simpleString()
    sums = tiles.repartition(min(4096, max(shuffle_partitions(loc.sparkSession), n * (n + 1) // 2)), "i", "j").groupBy("i", "j").applyInArrow(_tile_sums(alpha), f"id {kind}, p double")
    return sums.groupBy(F.col("id").alias(key)).agg(F.sum("p").alias("__p"))


def _potentials(loc: DataFrame, key: str, alpha: float, x: str) -> DataFrame:
    """(key, __p): the sum over all locations of weight times exp(-alpha d^2)."""
    count = loc.count()
    sums = gauss_sums(loc, key, "__w", alpha, x) if count > FEW else None
    return _tile_potentials(loc, count, key, alpha, x) if sums is None else sums


def subtractive(points: DataFrame, key: str, ra: float, accept: float = 0.5, reject: float = 0.15,
                max_centres: int = 10, x: str = "x") -> tuple[DataFrame, list[list[float]]]:
    """K9: Chiu's subtractive clustering; returns (labels(key, cluster), centres).

    A location's potential is the sum over points of exp(-alpha d^2), alpha = 4/ra^2.  The point of highest
    potential (ties to the smallest key) becomes a centre and takes its potential times exp(-beta d^2),
    rb = 1.5 ra, from all others, as long as it stands above ``accept`` times the first centre's.  Points in
    the grey zone down to ``reject`` are passed over; since potentials only fall, none that follows them can
    reach the accept level again, so the first such point ends the search, whatever ``reject`` is.

    Identical points are one weighted location.  Potentials are full sums over all locations: of more than ``FEW``
    by cells, to rounding and in linear time (:mod:`.gauss`), else, or where the cells hold too few points for
    that, over all pairs in tiles; a tile serves both its sides, and no pair becomes a row.
    """
    alpha, beta = 4.0 / ra ** 2, 4.0 / (1.5 * ra) ** 2
    loc = cut_lineage(points.groupBy(x).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("__w")))
    state = cut_lineage(loc.join(_potentials(loc, key, alpha, x), key))
    centres: list[list[float]] = []
    left, level = F.col("__p"), 0.0
    while len(centres) < max_centres:
        ranked = state.select(key, x, left.alias("__left"))
        top = ranked.agg(F.max(F.struct("__left", (-F.col(key)).alias("__nk"), F.col(x))).alias("t")).first()["t"]
        if top is None or top["__left"] <= level:
            break
        if not centres:
            level = accept * top["__left"]
        centres.append(list(top[x]))
        spot = F.array(*[F.lit(float(v)) for v in top[x]])
        left = F.greatest(left - F.lit(float(top["__left"])) * F.exp(-beta * sq_dist(F.col(x), spot)), F.lit(0.0))
    return assign_nearest(points, key, centres, x), centres


# ---------------------------------------------------------------- DBSCAN
def _boxes(pts: DataFrame, key: str, x: str, side: float, by: Sequence[str], d: int) -> DataFrame:
    """(by..., idx, lo, hi, rep): per grid cell of ``side`` the box of its points and one of them."""
    dims = range(d)
    return pts.withColumn("idx", _cell(F.col(x), side, d)).groupBy(*by, "idx").agg(
        F.array(*[F.min(F.col(x)[i]) for i in dims]).alias("lo"), F.array(*[F.max(F.col(x)[i]) for i in dims]).alias("hi"),
        F.min(F.struct(key, x))[x].alias("rep"))


def _gap(lo1: Column, hi1: Column, lo2: Column, hi2: Column, farthest: bool) -> Column:
    """Least or greatest distance between points of two boxes."""
    def side(a, b):  # a: first box, b: second, of one axis
        if farthest:
            return F.greatest(F.abs(a["hi"] - b["lo"]), F.abs(b["hi"] - a["lo"]))
        return F.greatest(a["lo"] - b["hi"], b["lo"] - a["hi"], F.lit(0.0))
    one, two = F.arrays_zip(lo1.alias("lo"), hi1.alias("hi")), F.arrays_zip(lo2.alias("lo"), hi2.alias("hi"))
    return F.sqrt(F.aggregate(F.zip_with(one, two, side), F.lit(0.0), lambda s, t: s + t * t))


def _linked_cells(core: DataFrame, key: str, eps: float, side: float, x: str, dims: int) -> DataFrame:
    """(a, b) of core cells (``__node``): links with the same components as all pairs that hold points within eps of each other.

    Pairs of cells are judged by their boxes: linked if the farthest corners, or one point of each, are within
    eps; apart if the nearest sides are not.  What is open is halved along every axis, and a pair of cells
    leaves as soon as any of its parts are linked; parts of one point are always decided.  Pairs that whole cells'
    links join already, if over others, are not halved: only borders between components are.  Points are never
    paired: the rows follow the number of cells and the stretch of border that lies about eps apart.
    """
    half = [o for o in _offsets(dims, math.ceil(math.sqrt(dims))) if o > [0] * dims]
    offs = F.array(*[F.array(*[F.lit(v) for v in o]) for o in half])
    cells = cut_lineage(_boxes(core, key, x, side, ["__node"], dims))
    other = cells.select(F.col("__node").alias("b"), F.col("idx").alias("ib"), *[F.col(c).alias(f"{c}b") for c in ("lo", "hi", "rep")])
    pairs = cells.select(F.col("__node").alias("a"), F.col("idx").alias("ia"), "lo", "hi", "rep", F.explode(F.transform(
        offs, lambda o: F.zip_with(F.col("idx"), o, lambda u, v: u + v))).alias("ib")).join(other, "ib")
    links, depth = None, 0
    while True:
        near, far = (_gap(F.col("lo"), F.col("hi"), F.col("lob"), F.col("hib"), f) for f in (False, True))
        judged = pairs.select("a", "b", "ia", "ib", (near <= eps).alias("may"), ((far <= eps) | (dist(F.col("rep"), F.col("repb")) <= eps)).alias("sure")).where("may")
        judged = cut_lineage(judged.withColumn("decided", F.max("sure").over(Window.partitionBy("a", "b"))))
        found = judged.where("sure").select("a", "b")
        links = found if links is None else links.unionByName(found)
        left = judged.where("not decided").select("a", "b", "ia", "ib")
        if depth == 0 and not left.isEmpty():
            comp = cut_lineage(components(found))
            links = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
            ends = [comp.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in ("a", "b")]
            joined = F.coalesce("of_a", "a") == F.coalesce("of_b", "b")
            left = cut_lineage(left.join(ends[0], "a", "left").join(ends[1], "b", "left").where(~joined).select("a", "b", "ia", "ib"))
        if left.isEmpty():
            return links
        depth += 1
        named = left.select(F.explode(F.array("a", "b")).alias("__node")).distinct()
        parts = cut_lineage(_boxes(core.join(named, "__node", "left_semi"), key, x, side / 2 ** depth, ["__node"], dims).withColumn(
            "up", F.transform("idx", lambda v: F.shiftright(v, 1))))
        one = parts.select(F.col("__node").alias("a"), F.col("up").alias("ia"), F.col("idx").alias("na"), "lo", "hi", "rep")
        two = parts.select(F.col("__node").alias("b"), F.col("up").alias("ib"), F.col("idx").alias("nb"), *[F.col(c).alias(f"{c}b") for c in ("lo", "hi", "rep")])
        pairs = left.join(one, ["a", "ia"]).join(two, ["b", "ib"]).drop("ia", "ib").withColumnsRenamed({"na": "ia", "nb": "ib"})


def dbscan(points: DataFrame, key: str, eps: float, min_samples: int, x: str = "x") -> DataFrame:
    """(key, cluster, kind) with kind in core / border / noise and cluster -1 for noise.

    1. Identical points are collapsed into weighted locations (a combinable
       aggregate), so a hot spot of copies is one row; every copy shares the
       location's degree, kind and cluster, so the result is unchanged.
    2. Grid of side eps/sqrt(d) (cell diagonal = eps): a cell holding at least
       ``min_samples`` points makes all its points core.  A location in a
       sparse cell is core if its nearest locations (:mod:`.distance`) reach
       weight ``min_samples`` within eps.
    3. All core points of one cell are within eps of each other, so clusters
       are the connected components of the *core-cell* graph (an edge when two
       cells hold core points within eps, see :func:`_linked_cells`).
       Clusters are numbered 0.. by their smallest core key; a border point
       joins the lowest-numbered cluster among its core neighbours, which are
       all among its nearest locations.
    No pairs of points are formed but those of sparse points with their
    nearest.  Meant for few dimensions (project first, e.g.
    :func:`features.pca_project`).
    """
    first = points.select(F.size(x).alias("d")).first()
    if first is None:
        kind = points.schema[key].dataType.simpleString()
        return points.sparkSession.createDataFrame([], f"`{key}` {kind}, cluster int, kind string")
    dims = first["d"]
    side = eps / math.sqrt(dims)
    loc = points.groupBy(x).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("__w"))
    pts = loc.select(key, x, "__w", _cell(F.col(x), side, dims).alias("__cell"))
    cells = pts.groupBy("__cell").agg(F.sum("__w").alias("__cn"))
    pts = cut_lineage(pts.join(cells, "__cell").withColumn("__dense", F.col("__cn") >= min_samples))
    total = pts.agg(F.sum("__w")).first()[0]
    sparse = pts.where(~F.col("__dense"))
    # a location offers itself as often as it has points, up to what is asked for
    need = min(min_samples, total)
    build = pts.select(F.col(key).alias("__lid"), x, F.explode(F.array_repeat(F.lit(0), F.least("__w", F.lit(need)).cast("int"))))
    near = cut_lineage(nearest_lists(sparse.select(key, x), key, build, "__lid", need, x))
    core_sparse = near.where((F.size("near") >= min_samples) & (F.col("near")[need - 1]["dist"] <= eps)).select(key)
    near = near.select(key, F.explode("near").alias("__n")).select(key, F.col("__n.id").alias("__nlid"), F.col("__n.dist").alias("dist"))
    core = pts.where(F.col("__dense")).unionByName(pts.join(core_sparse, key, "left_semi"))
    # node of a core location = its cell, named by the smallest core key in the cell
    node = core.groupBy("__cell").agg(F.min(key).alias("__node"))
    core = cut_lineage(core.join(node, "__cell").select(key, x, "__node"))
    nodes = core.select(F.col("__node").alias("node")).distinct()
    comp = components(_linked_cells(core, key, eps, side, x, dims)) if not core.isEmpty() else nodes.withColumn("component", F.col("node"))
    comp = cut_lineage(nodes.join(comp, "node", "left").select("node", F.coalesce("component", "node").alias("comp")))
    # number clusters 0.. by their smallest core key (component label = min node = min core key)
    ids = global_index(comp.select("comp").distinct(), ["comp"], "cluster")
    node_cluster = comp.join(ids, "comp").select(F.col("node").alias("__node"), F.col("cluster").cast("int").alias("cluster"))
    core_lab = cut_lineage(core.select(key, "__node").join(node_cluster, "__node").select(key, "cluster"))
    border = (near.where(F.col("dist") <= eps).join(core_lab, key, "left_anti")
              .join(core_lab.select(F.col(key).alias("__nlid"), F.col("cluster").alias("__c")), "__nlid")
              .groupBy(key).agg(F.min("__c").alias("cluster")))
    labelled = (core_lab.withColumn("kind", F.lit("core"))
                .unionByName(border.withColumn("kind", F.lit("border"))))
    loc_lab = pts.select(key, x).join(labelled, key, "left").select(
        x, F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("kind", F.lit("noise")).alias("kind"))
    # back to every original point (equi-join on the location; AQE splits a hot location)
    return points.select(key, x).join(loc_lab, x).select(key, F.col("cluster").cast("int").alias("cluster"), "kind")


# ---------------------------------------------------------------- Ward (two-level)
def ward_merges(centres: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float]]:
    """(a, b, cost) of Ward's merges of weighted points by nearest-neighbour chains, cheapest first, in O(m^2).

    The cost w_a w_b / (w_a + w_b) |c_a - c_b|^2 is reducible: two clusters that are each other's nearest stay so
    whatever others merge, so a chain of nearest neighbours ends in a pair that may merge at once.  A cluster
    is named by its smallest point; costs after a merge follow Lance and Williams.
    """
    m = len(centres)
    w = weights.astype(np.float64).copy()
    cost = w[:, None] * w[None, :] / (w[:, None] + w[None, :]) * ((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(cost, np.inf)
    alive, chain, merges = np.ones(m, bool), [], []
    while len(merges) < m - 1:
        if not chain:
            chain.append(int(alive.argmax()))
        at = chain[-1]
        best = int(cost[at].argmin())
        if len(chain) > 1 and cost[at, chain[-2]] <= cost[at, best]:
            best = chain[-2]
        if len(chain) < 2 or best != chain[-2]:
            chain.append(best)
            continue
        chain = chain[:-2]
        a, b = min(at, best), max(at, best)
        paid = cost[a, b]
        merges.append((a, b, float(paid)))
        others = alive.copy()
        others[[a, b]] = False
        new = ((w[a] + w) * cost[a] + (w[b] + w) * cost[b] - w * paid) / (w[a] + w[b] + w)
        cost[a, others], cost[others, a] = new[others], new[others]
        w[a] += w[b]
        alive[b] = False
        cost[b, :] = cost[:, b] = np.inf
    return sorted(merges, key=lambda c: c[2])


def ward(points: DataFrame, key: str, k: int, micro: int = 200, seed: int = 42, x: str = "x") -> DataFrame:
    """Ward clustering of k-means micro-clusters; (key, cluster).

    Level 1: k-means to ``micro`` weighted centroids (a bounded set).  Level 2: Ward's merges of the centroids
    down to k groups (:func:`ward_merges`).  Level 3: map back with a join on the micro-cluster id.  Cluster ids
    are ordered by the smallest member key.
    """
    n = points.count()
    labels, centres, _ = kmeans(points, key, min(micro, n), 1, seed, x)
    sizes = {r["cluster"]: r["n"] for r in cluster_sizes(labels).collect()}  # <= micro rows
    used = sorted(sizes)
    group = list(range(len(used)))
    for a, b, _ in ward_merges(np.array([centres[i] for i in used]), np.array([sizes[i] for i in used], np.float64))[: max(0, len(used) - k)]:
        group = [group[a] if g == group[b] else g for g in group]
    spark = points.sparkSession
    mp = spark.createDataFrame([(i, g) for i, g in zip(used, group)], "cluster int, __g int")  # <= micro rows
    j = labels.join(F.broadcast(mp), "cluster")
    first = j.groupBy("__g").agg(F.min(key).alias("__first"))
    order = first.select("__g", F.row_number().over(Window.orderBy("__first")).alias("__id"))  # k rows
    return j.join(F.broadcast(order), "__g").select(key, (F.col("__id") - 1).cast("int").alias("cluster"))


# ---------------------------------------------------------------- validation metrics
def silhouette(points: DataFrame, labels: DataFrame, key: str, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, computed exactly in linear time.

    For point i in cluster A: a = sum_{j in A} |x_i - x_j|^2 / (n_A - 1) and
    b = min over B != A of mean_{j in B} |x_i - x_j|^2, both from per-cluster
    sums (n, sum x, sum |x|^2) -- no pairs.  Noise (-1) is excluded; a
    singleton cluster scores 0; fewer than two clusters gives NULL.
    """
    return _mean_silhouette(points.join(labels, key).where(F.col(cluster) >= 0).select(x, cluster), x, cluster)


def _mean_silhouette(j: DataFrame, x: str, cluster: str) -> DataFrame:
    """The silhouette of points that stand beside their cluster."""
    first = j.select(F.size(x).alias("d")).first()
    dims = first["d"] if first else 0
    norm = F.aggregate(F.col(x), F.lit(0.0), lambda a, v: a + v * v)
    stats = j.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                   F.array(*[F.sum(F.col(x)[i]) for i in range(dims)]).alias("s"),
                                   F.sum(norm).alias("q"))
    st = stats.collect()  # one row per cluster: bounded by the number of clusters
    if len(st) < 2:
        return j.sparkSession.createDataFrame([(None,)], "silhouette double")
    arr = F.array(*[F.struct(F.lit(r[cluster]).alias("c"), F.lit(float(r["n"])).alias("n"),
                             F.array(*[F.lit(float(v)) for v in r["s"]]).alias("s"), F.lit(float(r["q"])).alias("q"))
                    for r in st])
    xi = F.col(x)
    nx = norm

    def msd(s):  # mean squared distance from x_i to all members of cluster s
        dot = F.aggregate(F.zip_with(xi, s["s"], lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        return (s["n"] * nx - 2 * dot + s["q"]) / s["n"]

    own = F.filter(arr, lambda s: s["c"] == F.col(cluster))[0]
    a = F.when(own["n"] > 1, msd(own) * own["n"] / (own["n"] - 1))
    b = F.array_min(F.transform(F.filter(arr, lambda s: s["c"] != F.col(cluster)), msd))
    s_i = F.when(own["n"] <= 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(b - a, F.nullif(F.greatest(a, b), F.lit(0.0))), F.lit(0.0)))
    return j.agg(F.avg(s_i).alias("silhouette"))


def _sample_distances(x: bytes, dims: int):
    """Per sampled point and cluster of a task's points: how many there are and the sum of their distances."""
    q = np.frombuffer(x, np.float64).reshape(-1, dims)

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            y, c = matrix(b.column("x")), b.column("c").to_numpy()
            for k in np.unique(c).tolist():
                for s in range(0, int((c == k).sum()), 2048):
                    part = y[c == k][s: s + 2048]
                    d = np.sqrt(((q[:, None, :] - part[None, :, :]) ** 2).sum(axis=2)) if dims * len(part) * len(q) < 1 << 24 else \
                        np.stack([np.sqrt(((part - one) ** 2).sum(axis=1)) for one in q])
                    t = total.setdefault(k, np.zeros((len(q), 2)))
                    t[:, 0] += len(part)
                    t[:, 1] += d.sum(axis=1)
        cols = [(i, k, float(n), float(v)) for k, t in total.items() for i, (n, v) in enumerate(t)]
        cols = list(zip(*cols)) or [[]] * 4
        kinds = (pa.int32(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["i", "c", "n", "total"])
    return run


def silhouette_sample(points: DataFrame, labels: DataFrame, key: str, m: int = 2000, seed: int = 42, x: str = "x", cluster: str = "cluster") -> DataFrame:
    """K15 with Euclidean distance: (silhouette, n) over at most ``m`` points by hash, each against all points.

    a is the mean distance to the others of the point's cluster, b the least mean distance to another cluster.
    Noise (-1) is excluded; a point alone in its cluster scores 0; fewer than two clusters give NULL.  What
    tasks put out is a row per sampled point and cluster.
    """
    from ..functions.columns import hash_unit
    j = cut_lineage(points.join(labels, key).where(F.col(cluster) >= 0).select(F.col(key).alias("k"), F.col(x).alias("x"), F.col(cluster).cast("long").alias("c")))
    asked = j.orderBy(hash_unit("k", seed), "k").limit(m).collect()
    schema = "silhouette double, n bigint"
    if not asked:
        return points.sparkSession.createDataFrame([(None, 0)], schema)
    q = np.array([r["x"] for r in asked], np.float64)
    per = j.select("x", "c").mapInArrow(_sample_distances(q.tobytes(), q.shape[1]), "i int, c long, n double, total double")
    per = per.groupBy("i", "c").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    own = points.sparkSession.createDataFrame([(i, r["c"]) for i, r in enumerate(asked)], "i int, own long")  # a row per sampled point
    mine = F.col("c") == F.col("own")
    s = per.join(own, "i").groupBy("i").agg(
        F.max(F.when(mine, F.col("n"))).alias("n"), F.max(F.when(mine & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("total") / F.col("n"))).alias("b"))
    value = F.when(F.col("b").isNull(), F.lit(None)).when(F.col("n") <= 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.nullif(F.greatest("a", "b"), F.lit(0.0))), F.lit(0.0)))
    return s.agg(F.avg(value).alias("silhouette"), F.count(F.lit(1)).alias("n"))


def _contingency(a: DataFrame, b: DataFrame, key: str, ca: str, cb: str) -> DataFrame:
    return a.select(key, F.col(ca).alias("__a")).join(b.select(key, F.col(cb).alias("__b")), key) \
        .groupBy("__a", "__b").agg(F.count(F.lit(1)).cast("double").alias("nij"))


def adjusted_rand(a: DataFrame, b: DataFrame, key: str, ca: str = "cluster", cb: str = "label") -> DataFrame:
    """ARI from the contingency table (Hubert & Arabie)."""
    return _rand_index(_contingency(a, b, key, ca, cb))


def _rand_index(t: DataFrame) -> DataFrame:
    comb = lambda c: c * (c - 1) / 2.0
    sij = t.agg(F.sum(comb(F.col("nij"))).alias("sij"), F.sum("nij").alias("n"))
    sa = t.groupBy("__a").agg(F.sum("nij").alias("ai")).agg(F.sum(comb(F.col("ai"))).alias("sa"))
    sb = t.groupBy("__b").agg(F.sum("nij").alias("bj")).agg(F.sum(comb(F.col("bj"))).alias("sb"))
    r = attach_row(attach_row(sij, sa), sb)  # three one-row tables
    exp = F.col("sa") * F.col("sb") / comb(F.col("n"))
    mx = (F.col("sa") + F.col("sb")) / 2
    return r.select(F.when(mx == exp, F.lit(1.0)).otherwise((F.col("sij") - exp) / (mx - exp)).alias("ari"))


def normalised_mutual_info(a: DataFrame, b: DataFrame, key: str, ca: str = "cluster",
                           cb: str = "label") -> DataFrame:
    """NMI with the arithmetic-mean normaliser, natural log."""
    return _mutual_info(_contingency(a, b, key, ca, cb))


def _mutual_info(t: DataFrame) -> DataFrame:
    ta = t.groupBy("__a").agg(F.sum("nij").alias("ai"))
    tb = t.groupBy("__b").agg(F.sum("nij").alias("bj"))
    total = t.agg(F.sum("nij").alias("n"))
    cells = attach_row(t.join(ta, "__a").join(tb, "__b"), total)
    mi = cells.agg(F.sum(F.col("nij") / F.col("n") * F.log(F.col("n") * F.col("nij") / (F.col("ai") * F.col("bj")))).alias("mi"))
    ha, hb = (attach_row(side, total).agg((-F.sum(F.col(c) / F.col("n") * F.log(F.col(c) / F.col("n")))).alias(name))
              for side, c, name in ((ta, "ai", "ha"), (tb, "bj", "hb")))
    r = attach_row(attach_row(mi, ha), hb)  # one-row tables
    den = (F.col("ha") + F.col("hb")) / 2
    return r.select(F.when(den == 0, F.lit(1.0)).otherwise(F.greatest(F.col("mi"), F.lit(0.0)) / den).alias("nmi"))


def _worst_neighbours(group: pa.Table) -> pa.Table:
    """Per cluster of block i: the largest (S_i + S_j) / |c_i - c_j| over the clusters of block j."""
    side, ids, s, c = group["side"].to_numpy(), group["id"].to_numpy(), group["s"].to_numpy(), matrix(group["centre"])
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    d = np.sqrt(((c[left][:, None, :] - c[right][None, :, :]) ** 2).sum(axis=2))
    ratio = np.where(ids[left][:, None] == ids[right][None, :], -np.inf, (s[left][:, None] + s[right][None, :]) / np.where(d > 0, d, np.nan))
    ratio = np.where(np.isnan(ratio), np.inf, ratio)  # two clusters at one place
    return pa.table({"id": ids[left], "r": ratio.max(axis=1, initial=-np.inf)})


def davies_bouldin(points: DataFrame, labels: DataFrame, key: str, x: str = "x", cluster: str = "cluster", block: int = 512) -> DataFrame:
    """Mean over clusters of max_j (S_i + S_j) / |c_i - c_j| (Euclidean, noise excluded); NULL under two clusters.

    Clusters are compared in blocks of some ``block`` by as many, so none goes to the driver, however many there are.
    """
    cen = cut_lineage(centroids(points, labels, key, x, cluster))  # read back, its size decides how it is joined
    j = points.join(labels, key).where(F.col(cluster) >= 0).join(cen, cluster)
    scat = j.groupBy(cluster).agg(F.avg(dist(F.col(x), F.col("centre"))).alias("s"))
    per = cut_lineage(scat.join(cen, cluster).select(F.col(cluster).cast("long").alias("id"), "s", "centre"))
    n = per.count()
    if n < 2:
        return points.sparkSession.createDataFrame([(None,)], "davies_bouldin double")
    blocks = -(-n // block)
    own, every = F.pmod(F.xxhash64("id"), F.lit(blocks)), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    one = per.select("id", "s", "centre", own.alias("i"), every.alias("j"), F.lit(0).alias("side"))
    two = per.select("id", "s", "centre", every.alias("i"), own.alias("j"), F.lit(1).alias("side"))
    worst = one.unionByName(two).groupBy("i", "j").applyInArrow(_worst_neighbours, "id long, r double")
    return worst.groupBy("id").agg(F.max("r").alias("r")).agg(F.avg("r").alias("davies_bouldin"))


def compare_clusterings(labels: Mapping[str, DataFrame], truth: DataFrame, points: DataFrame, key: str,
                        x: str = "x", truth_col: str = "label") -> DataFrame:
    """Method, n_clusters, ari, nmi, silhouette (noise excluded; NULL under two clusters).

    Each measure is worked out on its own and its one value read back: in one plan the measures' scalar subqueries
    lie in one another, and the threads that Spark runs subqueries on end up waiting for each other.
    """
    rows, truth, points = [], cut_lineage(truth.select(key, truth_col)), cut_lineage(points.select(key, x))
    for name, lab in labels.items():
        lab = cut_lineage(lab.select(key, "cluster"))  # the measures read it
        table = cut_lineage(_contingency(lab, truth, key, "cluster", truth_col))  # two measures read it
        placed = cut_lineage(points.join(lab, key).where(F.col("cluster") >= 0).select(x, "cluster"))
        measures = (lab.where(F.col("cluster") >= 0).agg(F.countDistinct("cluster")), _rand_index(table), _mutual_info(table),
                    _mean_silhouette(placed, x, "cluster"))
        rows.append((name, *[m.first()[0] for m in measures]))  # one-row tables
    return points.sparkSession.createDataFrame(rows, "method string, n_clusters int, ari double, nmi double, silhouette double")


def label_table(labels: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Key + one cluster column per method (outer join on the key)."""
    out = None
    for name, lab in labels.items():
        t = lab.select(key, F.col("cluster").alias(name))
        out = t if out is None else out.join(t, key, "full")
    return out
