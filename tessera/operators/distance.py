"""Distance core: vectors as ``array<double>``, grid-blocked epsilon joins, kNN.

Epsilon joins find candidate pairs by an equi-join on grid cells: each point is
compared with the points of the cells that can hold a neighbour, so their cost
follows the number of points within a few epsilons.  Nearest neighbours come
from blocks of about as many points each, wherever those lie, so the pairs
formed per point do not depend on how the data is spread.  Both are meant
for few dimensions: a box tells little in many.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_partitions
from .blocks import matrix


def sq_dist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two equal-length arrays (native higher-order functions)."""
    return F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda acc, t: acc + t)


def dist(a: Column, b: Column) -> Column:
    return F.sqrt(sq_dist(a, b))


def _cell(x: Column, side: float, dims: int) -> Column:
    return F.array(*[F.floor(x[i] / F.lit(side)).cast("long") for i in range(dims)])


def _offsets(dims: int, reach: int) -> list[list[int]]:
    return [list(t) for t in itertools.product(range(-reach, reach + 1), repeat=dims)]


def eps_pairs(points: DataFrame, key: str, eps: float, x: str = "x", include_self: bool = True,
              cell_side: float | None = None) -> DataFrame:
    """All ordered pairs (key, nbr, dist) with dist <= eps.

    Blocking: cells of side ``cell_side`` (default eps); a neighbour of a point
    lies in a cell at most ceil(eps / side) steps away per axis.  The build
    side is keyed by its own cell, the probe side is exploded to the reachable
    cells.  Meant for low-dimensional (projected or few-feature) inputs.
    """
    dims = len(points.select(x).first()[0])
    side = cell_side or eps
    reach = max(1, math.ceil(eps / side))
    offs = F.array(*[F.array(*[F.lit(o) for o in off]) for off in _offsets(dims, reach)])
    build = points.select(F.col(key).alias("nbr"), F.col(x).alias("__y"), _cell(F.col(x), side, dims).alias("__c"))
    probe = points.select(key, x, _cell(F.col(x), side, dims).alias("__home")).select(
        key, x, F.explode(F.transform(offs, lambda o: F.zip_with(F.col("__home"), o, lambda a, b: a + b))).alias("__c"))
    j = probe.join(build, "__c").select(key, "nbr", dist(F.col(x), F.col("__y")).alias("dist"))
    j = j.where(F.col("dist") <= F.lit(eps))
    if not include_self:
        j = j.where(F.col(key) != F.col("nbr"))
    return j


def _no_neighbours(points: DataFrame, key: str) -> DataFrame:
    """The empty result, with the key's own type."""
    kind = points.schema[key].dataType.simpleString()
    return points.sparkSession.createDataFrame([], f"`{key}` {kind}, nbr {kind}, rank int, dist double")


def knn_lists(points: DataFrame, key: str, k: int, x: str = "x", include_self: bool = True) -> DataFrame:
    """Exact k nearest neighbours within one table, a row per point: (key, near array of (dist, id)).

    Neighbours are ordered by (distance, neighbour key); with ``include_self``
    the point itself is among them at distance 0 (the reference convention for
    k-distance curves).  Identical points are collapsed first, so a hot spot
    of m copies asks once and offers k (+1) candidates instead of m^2 pairs:

    1. locations = distinct vectors with weight (a combinable aggregate);
    2. every location asks for the nearest k (+1) of the points, of which a
       location offers its first k (+1) keys (:func:`nearest_lists`);
    3. each point takes its location's list, without itself when
       ``include_self`` is false.
    """
    n = points.count()
    kk = min(k, n if include_self else n - 1)
    if kk <= 0:
        kind = points.schema[key].dataType.simpleString()
        return points.sparkSession.createDataFrame([], f"`{key}` {kind}, near array<struct<dist: double, id: {kind}>>")
    need = kk + (0 if include_self else 1)
    loc, members, first = _locations(points, key, x, need)
    near = nearest_lists(loc.select("__lid", x), "__lid", first.select(F.col(key).alias("nbr"), x), "nbr", need, x)
    listed = F.col("near") if include_self else F.filter("near", lambda t: t["id"] != F.col(key))
    return members.join(near, "__lid").select(key, F.slice(listed, 1, kk).alias("near"))


def _ranked(lists: DataFrame, key: str) -> DataFrame:
    """(key, nbr, rank 1.., dist): a row per entry of ``near``."""
    rows = lists.select(key, F.posexplode("near").alias("__at", "__n"))
    return rows.select(key, F.col("__n.id").alias("nbr"), (F.col("__at") + 1).cast("int").alias("rank"), F.col("__n.dist").alias("dist"))


def knn(points: DataFrame, key: str, k: int, x: str = "x", include_self: bool = True) -> DataFrame:
    """Exact k nearest neighbours within one table: (key, nbr, rank 1..k, dist), a row per entry of :func:`knn_lists`."""
    return _ranked(knn_lists(points, key, k, x, include_self), key)


BLOCK = 4096      # rows that a block of the search holds, about
DRAWN = 32        # sampled rows per block from which the blocks' borders are drawn
BLOCKS = 1 << 13  # most blocks; of more rows, each block holds more
LEAF = 32         # rows of a leaf inside a block (twice the neighbours asked for, if that is more)
TOGETHER = 64     # probes searched at once, at most
ABOUT = 8         # cells about them that bound their neighbours' distances


def _borders(sample: np.ndarray, size: int) -> list[tuple]:
    """A tree of halvings of the sample until ``size`` rows are left: (axis, value, left, right), or (-1, 0, block, 0).

    A cell is cut across its widest axis at the place nearest its median that parts two values.
    """
    nodes: list[tuple] = []
    blocks = 0
    todo = [(sample, None, 0)]
    while todo:
        part, parent, side = todo.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent] = (*nodes[parent][:2 + side], at, *nodes[parent][3 + side:])
        axis = int(np.ptp(part, axis=0).argmax()) if len(part) > size else 0
        values = np.unique(part[:, axis]) if len(part) > size else part[:0, 0]
        if len(values) < 2:
            nodes.append((-1, 0.0, blocks, 0))
            blocks += 1
            continue
        value = values[max(1, int(np.searchsorted(values, np.median(part[:, axis]))))]
        nodes.append((axis, float(value), 0, 0))
        todo += [(part[part[:, axis] < value], at, 0), (part[part[:, axis] >= value], at, 1)]
    return nodes


def _blocks_within(x: np.ndarray, r: np.ndarray, nodes: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """(row, block) of all blocks that the box of half-width r about each row of x touches; r = 0 names the row's own."""
    axis, value = np.array([n[0] for n in nodes]), np.array([n[1] for n in nodes])
    left, right = np.array([n[2] for n in nodes]), np.array([n[3] for n in nodes])
    row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    rows, found = [], []
    while len(row):
        end = axis[node] < 0
        rows.append(row[end])
        found.append(left[node[end]])
        row, node = row[~end], node[~end]
        place, reach = x[row, axis[node]], r[row]
        low, high = place - reach < value[node], place + reach >= value[node]
        row, node = np.concatenate([row[low], row[high]]), np.concatenate([left[node[low]], right[node[high]]])
    return np.concatenate(rows or [row]), np.concatenate(found or [row])


def _small_cells(y: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows of y in cells of at most ``size``, halved across the widest axis."""
    cells, todo = [], [np.arange(len(y))]
    while todo:
        at = todo.pop()
        if len(at) <= size:
            cells.append(at)
            continue
        part = y[at]
        order = np.argpartition(part[:, int(np.ptp(part, axis=0).argmax())], len(at) // 2)
        todo += [at[order[: len(at) // 2]], at[order[len(at) // 2:]]]
    return cells


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, added up axis by axis as :func:`dist` does."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        total += d * d
    return np.sqrt(total)


def _box_gaps(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least distance of every row of x to every box."""
    total = np.zeros((len(x), len(lo)))
    for j in range(x.shape[1]):
        d = np.maximum(np.maximum(lo[None, :, j] - x[:, j, None], x[:, j, None] - hi[None, :, j]), 0)
        total += d * d
    return np.sqrt(total)


def _search(x: np.ndarray, r: np.ndarray | None, y: np.ndarray, place: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance): the ``need`` nearest rows of y within r (any, if None), ordered by distance and ``place``.

    Rows of y lie in small cells, and rows of x that lie nearest to the same cell are searched together: the cells
    about them bound how far their neighbours can be, and only cells within that bound are compared.  What is
    held at once is a few rows of x against y, and of each row no more than its neighbours (and equal ones) go on.
    """
    cells = _small_cells(y, max(LEAF, 2 * need))
    size = np.array([len(c) for c in cells])
    inner = np.concatenate(cells)
    z, starts = y[inner], np.cumsum(size) - size
    gap = _box_gaps(x, np.minimum.reduceat(z, starts, axis=0), np.maximum.reduceat(z, starts, axis=0))
    own = gap.argmin(axis=1)
    by = np.argsort(own, kind="stable")
    most = max(1, min(TOGETHER, (1 << 22) // len(z)))
    rows, others, dists = [], [], []
    for same in np.split(by, np.flatnonzero(np.diff(own[by])) + 1):
        for s in range(0, len(same), most):
            who = same[s: s + most]
            to = gap[who]
            if r is not None:
                bound = r[who]
            else:
                bound, about = np.full(len(who), np.inf), np.zeros(len(cells), bool)
                about[np.argsort(to.min(axis=0), kind="stable")[:ABOUT]] = True
                at = np.flatnonzero(np.repeat(about, size))
                if need <= len(at) < len(z):
                    bound = np.partition(_distances(x[who], z[at]), need - 1, axis=1)[:, need - 1]
            at = np.flatnonzero(np.repeat((to <= bound[:, None]).any(axis=0), size))
            d = _distances(x[who], z[at])
            if need < len(at):
                bound = np.minimum(bound, np.partition(d, need - 1, axis=1)[:, need - 1])
            a, b = np.nonzero(d <= bound[:, None])
            rows.append(who[a])
            others.append(inner[at[b]])
            dists.append(d[a, b])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row, other, d = np.concatenate(rows), np.concatenate(others), np.concatenate(dists)
    order = np.lexsort((place[other], d, row))
    row, other, d = row[order], other[order], d[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < need
    return row[kept], other[kept], d[kept]


def _to_blocks(nodes: list[tuple]):
    """Rows under the block they lie in; a row without a place in space (null or NaN in x) is in none."""
    def run(batches):
        for b in batches:
            x = b.column("x")
            flat = x.flatten()
            if flat.null_count or x.null_count:
                b = b.filter(pa.array([v is not None and None not in v for v in x.to_pylist()]))
            xs = matrix(b.column("x"))
            real = ~np.isnan(xs).any(axis=1) if len(xs) else np.zeros(0, bool)
            if not real.all():
                b, xs = b.filter(pa.array(real)), xs[real]
            if b.num_rows:
                row, block = _blocks_within(xs, np.zeros(len(xs)), nodes)
                out = np.zeros(len(xs), np.int32)
                out[row] = block
                yield pa.RecordBatch.from_arrays([pa.array(out), *b.columns], names=["block", *b.schema.names])
    return run


def _lists(count: int, row, d, ids, kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(d), ids], names=["dist", "id"]))


def _searched(need: int, nodes: list[tuple], boxes: dict | None):
    """One block: its probes' nearest of its rows; with ``boxes`` (block: lo, hi, n) also the other blocks each probe has to ask."""
    def run(group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        build, probe = group.filter(pa.array(side == 0)), group.filter(pa.array(side == 1))
        if boxes is not None:
            names = np.array(sorted(boxes))
            lo, hi = (np.array([boxes[n][i] for n in names.tolist()]) for i in (0, 1))
            size = np.array([boxes[n][2] for n in names.tolist()])
        ids, kind = build["id"].combine_chunks(), build.schema.field("id").type
        place = np.empty(len(ids), np.int64)
        place[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        y, parts = matrix(build["x"]), []
        for s in range(0, probe.num_rows, BLOCK):
            some = probe.slice(s, BLOCK)
            x = matrix(some["x"])
            r = None if boxes is not None else some["r"].to_numpy()
            row, other, d = _search(x, r, y, place, need) if len(y) else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            cols = {"pkey": some["pkey"].combine_chunks(), "near": _lists(len(x), row, d, ids.take(pa.array(other)), kind)}
            if boxes is not None:
                held = np.bincount(row, minlength=len(x))
                last = np.cumsum(held) - 1
                r = np.where(held >= need, d[np.maximum(last, 0)] if len(d) else np.inf, np.inf)
                for i in np.flatnonzero(np.isinf(r)):  # few rows here: within the farthest corners of blocks that hold enough
                    far = np.sqrt((np.maximum(np.abs(x[i] - lo), np.abs(x[i] - hi)) ** 2).sum(axis=1))
                    order = np.argsort(far)
                    enough = np.flatnonzero(np.cumsum(size[order]) >= need)
                    r[i] = far[order[enough[0]]] * (1 + 1e-12) if len(enough) else np.inf
                row, block = _blocks_within(x, r * (1 + 1e-12), nodes)
                at = np.searchsorted(names, block)
                known = (at < len(names)) & (names[np.minimum(at, len(names) - 1)] == block)
                row, block, at = row[known], block[known], at[known]
                gap = np.sqrt((np.maximum(np.maximum(lo[at] - x[row], x[row] - hi[at]), 0) ** 2).sum(axis=1))
                ask = (gap <= r[row] * (1 + 1e-12)) & (block != group["block"][0].as_py())
                row, block = row[ask], block[ask]
                order = np.argsort(row, kind="stable")
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(x)))]).astype(np.int32)
                cols |= {"x": some["x"].combine_chunks(), "r": pa.array(r), "ask": pa.ListArray.from_arrays(pa.array(ends), pa.array(block[order].astype(np.int32)))}
            parts.append(pa.table(cols))
        if parts:
            return pa.concat_tables(parts)
        empty = {"pkey": probe["pkey"], "near": pa.array([], pa.list_(pa.struct([("dist", pa.float64()), ("id", kind)])))}
        if boxes is not None:
            empty |= {"x": probe["x"], "r": pa.array([], pa.float64()), "ask": pa.array([], pa.list_(pa.int32()))}
        return pa.table(empty)
    return run


def nearest_lists(probe: DataFrame, pkey: str, build: DataFrame, id: str, need: int, x: str) -> DataFrame:
    """(pkey, near: the ``need`` nearest build rows as an array of (dist, id) in this order); ``pkey`` is unique.

    Space is cut into blocks of about ``BLOCK`` build rows by a tree drawn from a sample that grows with the
    number of blocks and no further (``BLOCKS``).  Each probe searches its own block, which bounds how far its
    neighbours can be, and then the blocks within that bound, mostly none or one.  Both searches are one
    shuffle of the rows by block; the lists of probes that asked several blocks are merged (cut the result to
    read it more than once).  Rows whose x holds a null or NaN are nobody's neighbours and have none.
    """
    rows = cut_lineage(build.select(F.col(id).alias("id"), F.col(x).alias("x")))
    n = rows.count()
    spark = rows.sparkSession
    kind, pkind = rows.schema["id"].dataType.simpleString(), probe.schema[pkey].dataType.simpleString()
    nodes: list[tuple] = [(-1, 0.0, 0, 0)]
    if n > 2 * BLOCK:
        share = min(1.0, DRAWN * min(BLOCKS, n / BLOCK) / n)
        drawn = rows.where(F.pmod(F.xxhash64("x", "id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("x")
        drawn = [r["x"] for r in drawn.collect()]  # at most about DRAWN * BLOCKS rows
        drawn = np.array([v for v in drawn if v is not None and None not in v], np.float64)
        drawn = drawn[~np.isnan(drawn).any(axis=1)] if len(drawn) else drawn
        if len(drawn):
            nodes = _borders(drawn, DRAWN)
    first = probe.select(F.size(x).alias("d")).first()
    dims = first["d"] if first else 0
    held = rows.mapInArrow(_to_blocks(nodes), f"block int, id {kind}, x array<double>")
    box = held.groupBy("block").agg(F.array(*[F.min(F.col("x")[j]) for j in range(dims)]).alias("lo"), F.array(*[F.max(F.col("x")[j]) for j in range(dims)]).alias("hi"),
                                    F.count(F.lit(1)).alias("n"))
    boxes = {r["block"]: (r["lo"], r["hi"], r["n"]) for r in box.collect()} if len(nodes) > 1 else {0: ([-np.inf] * dims, [np.inf] * dims, n)}
    asked = probe.select(F.col(pkey).alias("pkey"), F.col(x).alias("x")).mapInArrow(_to_blocks(nodes), f"block int, pkey {pkind}, x array<double>")
    held = held.select("block", F.lit(0).alias("side"), "id", F.lit(None).cast(pkind).alias("pkey"), "x", F.lit(None).cast("double").alias("r"))
    none = F.lit(None).cast(kind).alias("id")
    home = held.unionByName(asked.select("block", F.lit(1).alias("side"), none, "pkey", "x", F.lit(None).cast("double").alias("r")))
    listed = f"near array<struct<dist: double, id: {kind}>>"
    parts = max(1, min(len(boxes), 4 * shuffle_partitions(spark)))  # blocks are dear to search and few bytes: not left to what merges small partitions
    state = cut_lineage(home.repartition(parts, "block").groupBy("block").applyInArrow(_searched(need, nodes, boxes), f"pkey {pkind}, {listed}, x array<double>, r double, ask array<int>"))
    if len(boxes) == 1:
        return state.select(F.col("pkey").alias(pkey), "near")
    more = state.where(F.size("ask") > 0)
    away = held.unionByName(more.select(F.explode("ask").alias("block"), F.lit(1).alias("side"), none, "pkey", "x", "r"))
    away = away.repartition(parts, "block").groupBy("block").applyInArrow(_searched(need, nodes, None), f"pkey {pkind}, {listed}")
    merged = more.select("pkey", "near").unionByName(away).groupBy("pkey").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, need).alias("near"))
    return state.where(F.size("ask") == 0).select("pkey", "near").unionByName(merged).withColumnRenamed("pkey", pkey)


def _locations(points: DataFrame, key: str, x: str, need: int):
    """(loc: __lid, x, __w), (members: key, __lid) and the first ``need`` keys of each location (key, x)."""
    from .order import rank_within
    loc = cut_lineage(points.groupBy(x).agg(F.min(key).alias("__lid"), F.count(F.lit(1)).alias("__w")))
    members = cut_lineage(points.select(key, x).join(loc, x).select(key, "__lid", x, "__w"))
    first = members.where(F.col("__w") <= need).select(key, x)
    crowded = members.where(F.col("__w") > need).select(key, "__lid")
    if not crowded.isEmpty():  # ranked on narrow rows, places joined to what is left
        crowded = rank_within(crowded, ["__lid"], [key], "__mr").where(F.col("__mr") < need)
        first = first.unionByName(crowded.join(loc.select("__lid", x), "__lid").select(key, x))
    return loc, members.select(key, "__lid"), first


def knn_between(probe: DataFrame, build: DataFrame, key: str, k: int, x: str = "x", include_self: bool = True) -> DataFrame:
    """Exact k nearest ``build`` points of every ``probe`` point: (key, nbr, rank, dist).

    The build side is collapsed into distinct locations, of which each offers its first k (+1) keys (a hot
    spot of copies is few candidates).  Ties are broken by neighbour key.  ``include_self=False``
    drops a build point whose key equals the probe key.
    """
    n_build = build.count()
    if n_build == 0 or k <= 0:
        return _no_neighbours(probe, key)
    need = min(k, n_build) + (0 if include_self else 1)
    need = min(need, n_build)
    _, _, first = _locations(build, key, x, need)
    near = nearest_lists(probe, key, first.select(F.col(key).alias("nbr"), x), "nbr", need, x)
    listed = F.col("near") if include_self else F.filter("near", lambda t: t["id"] != F.col(key))
    return _ranked(near.select(key, F.slice(listed, 1, k).alias("near")), key)


def kdist(knn_df: DataFrame, key: str, k: int) -> DataFrame:
    """K11 curve: (key, kdist) = distance to the k-th neighbour."""
    return knn_df.where(F.col("rank") == k).select(key, F.col("dist").alias("kdist"))
