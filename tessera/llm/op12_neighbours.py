"""Nearest neighbours by a block matrix join.

Queries and candidates are cut into blocks.  A tile multiplies the int8 forms of a block of each; what
rounding to int8 took from two vectors bounds how far the product may be off, so only pairs whose upper
bound reaches the query's k-th lower bound survive.  Survivors are computed again from the original
vectors in double precision and enter a heap per query; the heaps of a query's tiles are merged.  Tiles
come in rounds, each with GROWTH times the candidates so far; what a query has found by then is the
threshold of its next tiles, so a round puts out some GROWTH * k rows a query however many tiles it has.

Equal vectors are one vector in the tiles: of a group of copies only the k + 1 smallest ids can stand
among anyone's k nearest, so neither a hot vector nor its pairs are multiplied more than once.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import arrow_map

QUERY_VALUES = 1 << 21     # numbers in the distinct queries of a tile, about; their vectors are all that a task holds
CANDIDATE_BLOCK = 1 << 13  # distinct candidates of a tile, at least; they pass by in rows of CHUNK
LEAST_BLOCKS = 64          # blocks of candidates, where there are enough candidates, however few queries
GROWTH = 8
CHUNK = 4096
PART = 1024                # queries multiplied at once with CHUNK candidates
EXACT_DIMS = 1024          # so many products of int8 values add up without rounding in single precision
SLACK = 1e-5               # single precision changes an estimate by less


def _vectors(col, kind: str, dims: int) -> np.ndarray:
    """Rows of packed vectors in double precision, shorter ones with zeros at their end."""
    raw = col.to_pylist()
    width = np.dtype(kind).itemsize
    out = np.zeros((len(raw), dims))
    full = [k for k, r in enumerate(raw) if len(r) == dims * width]
    if full:
        out[full] = np.frombuffer(b"".join(raw[k] for k in full), kind).reshape(-1, dims)
    if len(full) < len(raw):
        for k, r in enumerate(raw):
            out[k, : len(r) // width] = np.frombuffer(r, kind)
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two, so that neither squares nor products overflow or vanish; cosines stay as they are."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=1e-300))
    return np.ldexp(x, -exponent[:, None])


def summed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum of products of each row, from the first dimension to the last."""
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out += x[:, d] * y[:, d]
    return out


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with the same row of ``y`` (both ``scaled``); exactly 1 for equal rows."""
    return summed(x, y) / np.sqrt(summed(x, x) * summed(y, y))


class Int8:
    """Unit vectors as ``scale * codes`` and the length of what that leaves out."""

    def __init__(self, x: np.ndarray) -> None:
        unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        self.scale = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / self.scale[:, None])
        self.codes = codes.astype(np.int8)
        rounded = codes * self.scale[:, None]
        self.lost = np.sqrt(((unit - rounded) ** 2).sum(axis=1))
        self.length = np.sqrt((rounded * rounded).sum(axis=1))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer product of int8 tiles.  Single precision adds ``EXACT_DIMS`` such products without rounding."""
    out = np.zeros((len(a), len(b)), np.float32)
    for d in range(0, a.shape[1], EXACT_DIMS):
        part = a[:, d: d + EXACT_DIMS].astype(np.float32) @ b[:, d: d + EXACT_DIMS].astype(np.float32).T
        out = part if a.shape[1] <= EXACT_DIMS else out.astype(np.float64) + part
    return out


def bounds(q: Int8, rows: slice, c: Int8) -> tuple[np.ndarray, np.ndarray]:
    """(estimate of each cosine, how far it may be off): |q c - q' c'| <= |q - q'| |c| + |q'| |c - c'|."""
    estimate = product(q.codes[rows], c.codes) * (q.scale[rows, None] * c.scale[None, :]).astype(np.float32)
    off = q.lost[rows, None] + q.length[rows, None] * c.lost[None, :] + SLACK
    return estimate, off.astype(np.float32)


def _tile_batches(batches, kind: str, dims: int, k: int):
    """(query class, candidate class, id, score) of the ``k`` best candidates of each query of each tile.

    Rows come by tile, a tile's queries first, with the score that others have shown them.  Heaps order by score,
    then by the smaller id.
    """
    tile, queries, keys, known, q, x, heaps, floor = None, [], [], [], None, None, [], None

    def best():
        out = [(keys[i], name, None if none else -low, score) for i, heap in enumerate(heaps) for score, none, low, name in heap]
        cols = list(zip(*out, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.int64(), pa.float64()), strict=True)],
                                          names=["query", "class", "vec_id", "score"])

    for b in batches:
        if not b.num_rows:
            continue
        place = np.stack([b.column(c).to_numpy() for c in ("i", "j", "side")])
        edge = np.concatenate([[0], np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1, [b.num_rows]]).tolist()
        for a, z in zip(edge[:-1], edge[1:], strict=True):
            now, side = tuple(place[:2, a].tolist()), place[2, a]
            if now != tile:
                if heaps:
                    yield best()
                tile, queries, keys, known, q, heaps = now, [], [], [], None, []
            part = b.slice(a, z - a)
            if side == 0:
                queries.append(scaled(_vectors(part.column("v"), kind, dims)))
                keys += part.column("class").to_pylist()
                known += part.column("floor").to_pylist()
                continue
            if q is None and queries:
                x = np.concatenate(queries)
                q, heaps, floor = Int8(x), [[] for _ in keys], np.array(known) - SLACK
            for s in range(0, part.num_rows if queries else 0, CHUNK):
                some = part.slice(s, CHUNK)
                y = scaled(_vectors(some.column("v"), kind, dims))
                c, ids, names = Int8(y), some.column("vec_id").to_pylist(), some.column("class").to_pylist()
                for r in range(0, len(keys), PART):
                    rows = slice(r, r + PART)
                    estimate, off = bounds(q, rows, c)
                    least = floor[rows]
                    if len(ids) >= k and least.min() < -1.5:  # no full heap yet
                        least = np.maximum(least, np.partition(estimate - off, len(ids) - k, axis=1)[:, len(ids) - k])
                    who, which = np.nonzero(estimate + off >= least[:, None].astype(np.float32))
                    who += r
                    score = cosines(x[who], y[which])
                    for i, m, value in zip(who.tolist(), which.tolist(), score.tolist(), strict=True):
                        if value < known[i]:
                            continue
                        heap, no_id = heaps[i], ids[m] is None
                        entry = (value, -1 if no_id else 0, 0 if no_id else -ids[m], names[m])
                        if len(heap) < k:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
                        if len(heap) == k:
                            floor[i] = max(floor[i], heap[0][0] - SLACK)
    if heaps:
        yield best()


def nearest(rows: DataFrame, asked: str = "vec_id % 50 = 0", k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows nearest to each row that ``asked`` holds for, by cosine.

    ``rows`` (vec_id, embedding); other columns are left out.  Candidates are all rows but the query's own.  Vectors
    that are null, empty, zero or hold null or non-finite parts take no part.  A shorter vector is compared as if it
    ended in zeros.  Equal scores go to the smaller vec_id, a null vec_id last.  Rows are told apart by themselves, not
    by their vec_id: a repeated row is a candidate of its copy and, if asked for, a query of its own.
    """
    ok = ("embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
          "and exists(embedding, x -> x != 0)")
    double = rows.schema["embedding"].dataType.simpleString() != "array<float>"
    kind = "<f8" if double else "<f4"
    valid = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>" if double else "array<float>").alias("embedding")).where(ok)
    # numbered as they are written, so later jobs that run again see the same numbers
    valid = cut_lineage(arrow_map(valid, _pack_batches, "vec_id long, v binary, class binary", kind=kind).withColumn("row", F.monotonically_increasing_id()))
    dims = (valid.agg(F.max(F.octet_length("v"))).first()[0] or np.dtype(kind).itemsize) // np.dtype(kind).itemsize
    order = [F.asc_nulls_last("vec_id"), "row"]
    member = valid.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy(*order))).where(F.col("n") <= k + 1)
    member = cut_lineage(member.select("class", "vec_id", "row", "n", F.when(F.col("n") == 1, F.col("v")).alias("v")))
    classes = member.where("n = 1").select("class", "vec_id", "v")
    queries = valid.where(asked)
    query_classes = cut_lineage(queries.groupBy("class").agg(F.any_value("v").alias("v")))
    found = _tiles(query_classes, classes, kind, dims, k + 1).select("query", "class", "score")
    # the rows of the classes found: k + 1 classes of k + 1 rows each, packed, at most
    listed = found.join(member.select("class", "vec_id", "row"), "class").groupBy("query").agg(F.collect_list(F.struct("score", "vec_id", "row")).alias("list"))
    each = queries.select(F.col("class").alias("query"), F.col("vec_id").alias("query_id"), F.col("row").alias("own")).join(listed, "query")
    first = F.array_sort(F.filter("list", lambda c: c["row"] != F.col("own")), _before)
    out = each.select("query_id", F.posexplode(F.slice(first, 1, k)).alias("at", "c"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("c.vec_id").alias("vec_id"), F.col("c.score").alias("score"))


def _before(a, b):
    """Order of candidates: larger score, then smaller vec_id, null last, then the row that comes first."""
    return (F.when(a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1))
            .when(a["vec_id"].isNull() & b["vec_id"].isNotNull(), 1).when(b["vec_id"].isNull() & a["vec_id"].isNotNull(), -1)
            .when(a["vec_id"] < b["vec_id"], -1).when(a["vec_id"] > b["vec_id"], 1)
            .when(a["row"] < b["row"], -1).when(a["row"] > b["row"], 1).otherwise(0))


def _pack_batches(batches, kind: str):
    """Vectors as bytes, and a digest that tells different ones apart."""
    import hashlib
    for b in batches:
        col = b.column("embedding")
        flat, size = np.ascontiguousarray(col.flatten().to_numpy(zero_copy_only=False), kind) + np.dtype(kind).type(0), col.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(size)]).tolist()
        v = [flat[a:z].tobytes() for a, z in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(v, pa.binary()), pa.array([hashlib.sha256(x).digest() for x in v], pa.binary())], names=["vec_id", "v", "class"])


def _tiles(queries: DataFrame, classes: DataFrame, kind: str, dims: int, k: int) -> DataFrame:
    """(query, class, vec_id, score): the ``k`` best classes of each query.

    The grid's sides come from the two tables' sizes alone.  Each query goes to every column of its row of tiles
    and each candidate to every row of its column; there are no more columns than let both cost the same.
    """
    asked, offered = queries.count(), classes.count()
    high = max(1, -(-asked * dims // QUERY_VALUES))
    wide = max(1, min(-(-offered // CANDIDATE_BLOCK), max(LEAST_BLOCKS, high * offered // max(asked, 1))))
    schema = "query binary, class binary, vec_id long, score double"
    row, column = (F.pmod(F.xxhash64("class", F.lit(seed)), F.lit(n)).cast("int") for seed, n in ((1, high), (2, wide)))
    near = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "class")
    found = queries.sparkSession.createDataFrame([], schema)
    done, to = 0, 1
    while done < wide:
        floor = found.groupBy("query").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).select(F.col("query").alias("class"), "floor")
        ask = queries.join(floor, "class", "left").select(row.alias("i"), F.explode(F.sequence(F.lit(done), F.lit(to - 1))).alias("j"), F.lit(0).alias("side"),
                                                          "class", F.lit(None).cast("long").alias("vec_id"), "v", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
        offer = classes.select(F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("i"), column.alias("j"), F.lit(1).alias("side"), "class", "vec_id", "v",
                               F.lit(None).cast("double").alias("floor")).where(f"j >= {done} and j < {to}")
        tiles = ask.unionByName(offer).repartition(high * (to - done), "i", "j").sortWithinPartitions("i", "j", "side")
        new = found.unionByName(arrow_map(tiles, _tile_batches, schema, kind=kind, dims=dims, k=k))
        found = cut_lineage(new.withColumn("n", F.row_number().over(near)).where(F.col("n") <= k).drop("n"))
        done, to = to, min(wide, to * GROWTH)
    return found
