"""Sums of Gaussians about many weighted points in few columns, in linear time and without pairs.

Space is cut into cells of ``SIDE`` (in units in which the Gaussian is exp(-d^2)).  Inside two cells the Gaussian is
a polynomial of both places to rounding: ``NODES`` Chebyshev nodes per axis leave 2 (SIDE/4)^NODES / (NODES/2)!, some
3e-16.  So a cell's points act as weights of its grid of nodes, the grids act on one another axis by axis (the
Gaussian is a product over axes), and a point reads its value off its own cell's grid.  Cells more than ``REACH``
apart on an axis hold points at least REACH * SIDE apart, whose Gaussian is below 2e-28.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_partitions
from .blocks import matrix

SIDE = 2.0         # of a cell
NODES = 24         # of a cell along each axis
REACH = 4          # cells along an axis that act on one another
STRETCH = 32       # cells of a line that one task takes at once, and those within reach of them
GROUP = 1 << 18    # points of a cell that one task takes at once, about
CELLS = 1 << 14    # most cells: the driver holds their places
ROOM = 1 << 27     # numbers in all grids of a step, if that is more than ``PER_POINT`` for every point
PER_POINT = 16
FAR = 2.0 ** 20    # a coordinate beyond which cells are not numbered

_PLACES = np.cos((2 * np.arange(NODES) + 1) * math.pi / (2 * NODES))
_AT_PLACES = np.polynomial.chebyshev.chebvander(_PLACES, NODES - 1)


def _bases(y: np.ndarray, cell: np.ndarray) -> list[np.ndarray]:
    """Per axis the rows' values of the polynomials that are 1 at one node of the cell and 0 at the others."""
    u = np.clip(2 * y / SIDE - 2 * cell - 1, -1, 1)
    return [(2 * np.polynomial.chebyshev.chebvander(u[:, j], NODES - 1) @ _AT_PLACES.T - 1) / NODES for j in range(u.shape[1])]


def _parts(y: np.ndarray, cell: np.ndarray):
    """(rows, values of the first axis, products of the other axes) a few rows at a time."""
    most = max(16, (1 << 20) // NODES ** (y.shape[1] - 1))
    for s in range(0, len(y), most):
        first, *others = _bases(y[s: s + most], cell)
        rest = np.ones((len(first), 1))
        for b in others:
            rest = (rest[:, :, None] * b[:, None, :]).reshape(len(first), -1)
        yield slice(s, s + most), first, rest


def _rows_of(grids: np.ndarray) -> pa.Array:
    ends = np.arange(len(grids) + 1, dtype=np.int32) * grids.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(grids.reshape(-1)))


def _weights(scale: float):
    """One cell's points as weights of its nodes."""
    def run(group: pa.Table) -> pa.Table:
        cell = np.array(group["cell"][0].as_py())
        y, w = matrix(group["x"]) * scale, group["w"].to_numpy().astype(np.float64)
        grid = np.zeros((NODES, NODES ** (y.shape[1] - 1)))
        for at, first, rest in _parts(y, cell):
            grid += (w[at, None] * first).T @ rest
        return pa.table({"cell": pa.array([cell.tolist()], pa.list_(pa.int64())), "grid": _rows_of(grid.reshape(1, -1))})
    return run


def _along(axis: int, dims: int, wanted: set[tuple]):
    """What the grids of one line of cells add up to along the axis, in the cells of one stretch that points can read it from."""
    acts = {o: np.exp(-(SIDE * o + SIDE / 2 * (_PLACES[:, None] - _PLACES[None, :])) ** 2) for o in range(-REACH, REACH + 1)}
    shape = (NODES ** axis, NODES, NODES ** (dims - axis - 1))

    def run(group: pa.Table) -> pa.Table:
        cells = matrix(group["cell"]).astype(np.int64)
        grids, line, stretch = matrix(group["grid"]), cells[0].tolist(), group["stretch"][0].as_py()
        held: dict[int, np.ndarray] = {}
        for c, grid in zip(cells[:, axis].tolist(), grids):
            held[c] = held[c] + grid if c in held else grid
        ends = sorted(t for t in {c + o for c in held for o in acts} if t // STRETCH == stretch and (*line[:axis], t) in wanted)
        out = np.zeros((len(ends), NODES ** dims))
        for i, t in enumerate(ends):
            for o, act in acts.items():
                if t - o in held:
                    out[i] += np.matmul(act, held[t - o].reshape(shape)).reshape(-1)
        return pa.table({"cell": pa.array([[*line[:axis], t, *line[axis + 1:]] for t in ends], pa.list_(pa.int64())), "grid": _rows_of(out)})
    return run


def _read(scale: float):
    """The values of one cell's points, read off its grid."""
    def run(group: pa.Table, local: pa.Table) -> pa.Table:
        if not group.num_rows:
            return pa.table({"id": group["id"], "p": pa.array([], pa.float64())})
        y, cell = matrix(group["x"]) * scale, np.array(group["cell"][0].as_py())
        grid, p = matrix(local["grid"]).reshape(NODES, -1), np.zeros(len(y))
        for at, first, rest in _parts(y, cell):
            p[at] = ((rest @ grid.T) * first).sum(axis=1)
        return pa.table({"id": group["id"], "p": p})
    return run


def _steps(cells: set[tuple], dims: int) -> list[tuple[set[tuple], int, int]]:
    """Per axis: the starts of wanted cells, the stretches of lines that come in and the grids that go out."""
    steps, here = [], cells
    for j in range(dims):
        wanted = {c[: j + 1] for c in cells}
        lines = len({(*c[:j], (c[j] + o) // STRETCH, *c[j + 1:]) for c in here for o in (-REACH, REACH)})
        here = {(*c[:j], c[j] + o, *c[j + 1:]) for c in here for o in range(-REACH, REACH + 1) if (*c[:j], c[j] + o) in wanted}
        steps.append((wanted, lines, len(here)))
    return steps


def gauss_sums(points: DataFrame, key: str, weight: str, alpha: float, x: str = "x") -> DataFrame | None:
    """(key, __p): the sum over all points of weight times exp(-alpha d^2).

    None where this takes more than pairs do or cannot be laid out: the grids of the cells would hold more than
    ``ROOM`` numbers and ``PER_POINT`` for each point (few points in many cells, many axes), or x is not of one
    length and finite.
    """
    spark, scale = points.sparkSession, math.sqrt(alpha)
    odd = F.col(x).isNull() | F.exists(F.col(x), lambda v: v.isNull())
    seen = points.agg(F.count(F.lit(1)).alias("n"), F.min(F.size(x)).alias("least"), F.max(F.size(x)).alias("most"), F.max(odd).alias("odd"),
                      F.max(F.array_max(F.transform(F.col(x), lambda v: F.abs(v)))).alias("far")).first()
    dims = seen["most"]
    if not seen["n"] or seen["odd"] or seen["least"] != dims or dims < 1 or not seen["far"] * scale < FAR:  # NaN is not below
        return None
    room = max(ROOM, PER_POINT * seen["n"]) // NODES ** dims
    own = points.select(F.col(key).alias("id"), F.col(x).alias("x"), F.col(weight).alias("w"),
                        F.array(*[F.floor(F.col(x)[j] * F.lit(scale / SIDE)).cast("long") for j in range(dims)]).alias("cell"))
    sizes = own.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    counted = sizes.limit(min(CELLS, room) + 1).collect()
    if len(counted) > min(CELLS, room):
        return None
    steps = _steps({tuple(r["cell"]) for r in counted}, dims)
    if max(out for _, _, out in steps) > room:
        return None
    shares = spark.createDataFrame([(r["cell"], -(-r["n"] // GROUP)) for r in counted], "cell array<long>, shares long")  # <= CELLS rows
    most = 4 * shuffle_partitions(spark)
    dealt = own.join(F.broadcast(shares), "cell").withColumn("share", F.pmod(F.xxhash64("x"), F.col("shares"))).drop("shares")
    parts = min(most, sum(-(-r["n"] // GROUP) for r in counted))
    dealt = cut_lineage(dealt.repartition(parts, "cell", "share"))  # read twice: for the weights and for the values
    grids = dealt.repartition(parts, "cell", "share").groupBy("cell", "share").applyInArrow(_weights(scale), "cell array<long>, grid array<double>")
    for j, (wanted, lines, _) in enumerate(steps):
        reached = F.array_distinct(F.array(*[F.floor((F.col("cell")[j] + o) / STRETCH) for o in (-REACH, REACH)]))
        grids = grids.select("cell", "grid", F.array(*[F.col("cell")[i] for i in range(dims) if i != j]).cast("array<long>").alias("line"), F.explode(reached).alias("stretch"))
        grids = grids.repartition(min(most, lines), "line", "stretch").groupBy("line", "stretch").applyInArrow(_along(j, dims, wanted), "cell array<long>, grid array<double>")
    grids = cut_lineage(grids)
    local = grids.join(F.broadcast(shares), "cell").select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), "grid")
    kind = points.schema[key].dataType.simpleString()
    sums = dealt.repartition(parts, "cell", "share").groupBy("cell", "share").cogroup(local.repartition(parts, "cell", "share").groupBy("cell", "share")).applyInArrow(
        _read(scale), f"id {kind}, p double")
    return sums.groupBy(F.col("id").alias(key)).agg(F.sum("p").alias("__p"))
