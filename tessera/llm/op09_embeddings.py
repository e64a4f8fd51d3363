"""Near-duplicate embeddings by NN-descent.

Each vector keeps a list of its nearest vectors so far.  Rounds join lists on their common
member: whoever stands together in some vector's list (or has that vector in its own) is
compared, and the better ones replace the worse.  Pairs compared once are not compared again.
Lists start from neighbours in sorted orders of random hyperplane signatures.  Where lists end
up full of links, their groups are enlarged to the whole component and counted in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import arrow_map
from ..operators.components import components

NEIGHBOURS = 10
ORDERS = 8         # random orders that the first lists come from
NEXT = 4           # followers in an order that a vector is compared with
ROUNDS = 6         # rounds at most, per attempt
SETTLED = 0.005    # share of list places that a last round may still change
BLOCK = 1024       # vectors of a block in the enlarged comparison
ASKED = 2048       # audited vectors of a tile
OFFERED = 1 << 15  # vectors of a tile, about
LEAST_RECALL = 0.9  # below it there is no result
SLACK = 0.005      # half precision changes a cosine by less
PAIRS = "a long, b long, sim float"


def unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; scaled by their largest part first, so nothing overflows."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _matrix(col, kind, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), kind).reshape(-1, dims) if len(col) else np.zeros((0, dims), kind)


def _pack_batches(batches, dims: int):
    """Valid vectors as unit vectors in half precision; lengths under ``dims`` end in zeros."""
    for b in batches:
        col = b.column("embedding")
        values = np.zeros((b.num_rows, dims))
        for r, v in enumerate(col):
            x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
            values[r, : len(x)] = x
        half = unit(values).astype(np.float16) if b.num_rows else values
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([x.tobytes() for x in half], pa.binary())], names=["id", "q"])


def _order_batches(batches, dims: int, orders: int, seed: int):
    """Each vector under its signature in every random order."""
    planes = np.random.default_rng(seed).normal(size=(orders * 63, dims)).astype(np.float32)
    bits = np.int64(1) << np.arange(62, -1, -1, dtype=np.int64)
    for b in batches:
        x = _matrix(b.column("q"), np.float16, dims).astype(np.float32)
        sign = (x @ planes.T > 0).reshape(len(x), orders, 63)
        key = (sign * bits).sum(axis=2).ravel()
        row = np.repeat(np.arange(len(x)), orders)
        yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(orders, dtype=np.int32), len(x))), pa.array(key),
                                          b.column("id").take(pa.array(row)), b.column("q").take(pa.array(row))], names=["o", "key", "id", "q"])


def _pairs(a, b, sim):
    """Record batch of pairs in both directions."""
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, b])), pa.array(np.concatenate([b, a])),
                                       pa.array(np.concatenate([sim, sim]).astype(np.float32))], names=["a", "b", "sim"])


def _follow_batches(batches, dims: int, n: int):
    """Compare each vector with the next ones of the same order; batches overlap by what is still open."""
    o, ids, x = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, dims), np.float32)
    for b in batches:
        old = len(ids)
        o = np.concatenate([o, b.column("o").to_numpy()])
        ids = np.concatenate([ids, b.column("id").to_numpy()])
        x = np.concatenate([x, _matrix(b.column("q"), np.float16, dims).astype(np.float32)])
        for k in range(1, n + 1):
            a = np.arange(max(0, old - k), max(0, len(ids) - k))
            a = a[(o[a] == o[a + k]) & (ids[a] != ids[a + k])]
            if len(a):
                yield _pairs(ids[a], ids[a + k], np.einsum("nd,nd->n", x[a], x[a + k]))
        o, ids, x = o[-n:], ids[-n:], x[-n:]


def _local_batches(batches, dims: int, k: int):
    """Members of one list against each other, new ones against all; each one's ``k`` best are proposed."""
    for b in batches:
        col = b.column("members")
        flat, ends = col.flatten(), np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])
        ids, fresh = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("v", "fresh"))
        x = _matrix(flat.field("q"), np.float16, dims).astype(np.float32)
        out = ([], [], [])
        for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            sim = x[s:e] @ x[s:e].T
            sim[~(fresh[s:e, None] | fresh[None, s:e]) | (ids[s:e, None] == ids[None, s:e])] = -2
            best = np.argpartition(-sim, min(k, e - s - 1), axis=1)[:, :k]
            who = np.repeat(np.arange(e - s), best.shape[1])
            best = best.ravel()
            ok = sim[who, best] > -2
            out[0].append(ids[s:e][who[ok]])
            out[1].append(ids[s:e][best[ok]])
            out[2].append(sim[who[ok], best[ok]])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["a", "b", "sim"])


def _shorten(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each vector; a pair met again is not new.  (a, b, sim, fresh)"""
    best = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    near = Window.partitionBy("a").orderBy(F.desc("sim"), F.xxhash64("a", "b"), "b")
    return best.withColumn("r", F.row_number().over(near)).where(F.col("r") <= k).drop("r")


def descend(vectors: DataFrame, dims: int, k: int = NEIGHBOURS, seed: int = 1, start: DataFrame | None = None) -> DataFrame:
    """Neighbour lists (a, b, sim, fresh) of ``vectors`` (id, q)."""
    n = vectors.count()
    ordered = arrow_map(vectors, _order_batches, "o int, key long, id long, q binary", dims=dims, orders=ORDERS, seed=seed)
    ordered = ordered.repartitionByRange("o", "key", "id").sortWithinPartitions("o", "key", "id")
    first = arrow_map(ordered, _follow_batches, PAIRS, dims=dims, n=NEXT).withColumn("fresh", F.lit(True))
    lists = cut_lineage(_shorten(first if start is None else first.unionByName(start), k))
    for _ in range(ROUNDS):
        # both ends of an entry stand in each other's circle; a circle holds at most k entries from either side
        back = lists.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a", "b"), "a"))).where(F.col("r") <= k)
        circle = (lists.select(F.col("a").alias("w"), F.col("b").alias("v"), "fresh")
                  .unionByName(back.select(F.col("b").alias("w"), F.col("a").alias("v"), "fresh"))
                  .groupBy("w", "v").agg(F.max("fresh").alias("fresh")))
        circle = circle.join(vectors.withColumnRenamed("id", "v"), "v")
        met = circle.groupBy("w").agg(F.collect_list(F.struct("v", "fresh", "q")).alias("members")).where("exists(members, m -> m.fresh)")
        found = arrow_map(met, _local_batches, PAIRS, dims=dims, k=k // 2).withColumn("fresh", F.lit(True))
        lists = cut_lineage(_shorten(lists.withColumn("fresh", F.lit(False)).unionByName(found), k))
        if lists.where("fresh").count() <= SETTLED * k * n:
            break
    return lists


def _verify_batches(batches, dims: int, threshold: float):
    for b in batches:
        x, y = unit(_matrix(b.column("va"), np.float64, dims)), unit(_matrix(b.column("vb"), np.float64, dims))
        ok = pa.array(np.einsum("nd,nd->n", x, y) >= threshold) if b.num_rows else pa.array([], pa.bool_())
        yield b.select(["a", "b"]).filter(ok)


def _raw_batches(batches, dims: int):
    """Vectors in double precision, as they are."""
    for b in batches:
        out = []
        for v in b.column("embedding"):
            x = np.zeros(dims)
            got = v.values.to_numpy(zero_copy_only=False)
            x[: len(got)] = got
            out.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("weight"), b.column("audited"), pa.array(out, pa.binary())], names=["id", "weight", "audited", "v"])


def _block_group(dims: int, threshold: float):
    def count(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, weight, side = (group[c].to_numpy() for c in ("id", "weight", "side"))
        x = unit(_matrix(group["v"], np.float64, dims))
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
        near = (x[left] @ x[right].T >= threshold) & (ids[left][:, None] != ids[right][None, :])
        parts = [(ids[left], near @ weight[right])] + ([(ids[right], near.T @ weight[left])] if i != j else [])
        return pa.table({"id": np.concatenate([p[0] for p in parts]), "n": np.concatenate([p[1] for p in parts]).astype(np.int64)})
    return count


def _audit_batches(batches, dims: int, threshold: float):
    """Links of each audited vector in its tile; a tile's audited vectors come first, the others pass by."""
    tile, ids, parts, q, found = None, [], [], None, None

    def counted():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(found)], names=["id", "n"])

    for b in batches:
        if not b.num_rows:
            continue
        place = np.stack([b.column(c).to_numpy() for c in ("i", "j", "side")])
        edge = np.concatenate([[0], np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1, [b.num_rows]]).tolist()
        for a, z in zip(edge[:-1], edge[1:], strict=True):
            now = tuple(place[:2, a].tolist())
            if now != tile:
                if found is not None:
                    yield counted()
                tile, ids, parts, q, found = now, [], [], None, None
            part = b.slice(a, z - a)
            if place[2, a] == 0:
                ids.append(part.column("id").to_numpy())
                parts.append(unit(_matrix(part.column("v"), np.float64, dims)))
                continue
            if not parts:
                continue
            if found is None:
                q, found = np.concatenate(parts), np.zeros(sum(map(len, ids)), np.int64)
                mine = np.concatenate(ids)
            for s in range(0, part.num_rows, BLOCK):
                some = part.slice(s, BLOCK)
                near = (q @ unit(_matrix(some.column("v"), np.float64, dims)).T >= threshold) & (mine[:, None] != some.column("id").to_numpy()[None, :])
                found += near @ some.column("weight").to_numpy()
    if found is not None:
        yield counted()


def _truth(exact: DataFrame, dims: int, threshold: float) -> DataFrame:
    """(id, truth): links of all vectors to be audited, by comparing them with all vectors in tiles."""
    total, asked = exact.agg(F.count(F.lit(1)), F.count_if("audited")).first()
    high, wide = max(1, -(-asked // ASKED)), max(1, -(-total // OFFERED))
    row, column = (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)).cast("int") for k, n in ((1, high), (2, wide)))
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (high, wide)]
    ask = exact.where("audited").select(row.alias("i"), every[1].alias("j"), F.lit(0).alias("side"), "id", "weight", "v")
    offer = exact.select(every[0].alias("i"), column.alias("j"), F.lit(1).alias("side"), "id", "weight", "v")
    tiles = ask.unionByName(offer).repartition(high * wide, "i", "j").sortWithinPartitions("i", "j", "side")
    return arrow_map(tiles, _audit_batches, "id long, n long", dims=dims, threshold=threshold).groupBy("id").agg(F.sum("n").alias("truth"))


def near_duplicates(rows: DataFrame, threshold: float = 0.95, k: int = NEIGHBOURS, attempts: int = 6, recall: float = 0.97) -> DataFrame:
    """vec_id, n_links, component_id, kept, audit_recall per row of ``rows`` (vec_id, embedding).

    Null, empty or zero vectors and such with null or non-finite parts have no links and are their own
    component.  A shorter vector is compared as if it ended in zeros.  Equal vectors are one node that counts
    as often as it stands; rows of one vec_id are one node.  A null vec_id has no links, a null component and
    is kept.

    Links are confirmed in double precision.  Recall is measured on all vectors with an id divisible by 50, against
    all; below ``recall`` another seed's orders join the lists and the rounds go on.  If it is under
    ``LEAST_RECALL`` after ``attempts`` of them, an error is raised.
    """
    spark = rows.sparkSession
    ok = ("vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
          "and exists(embedding, x -> x != 0)")
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.select("vec_id", "embedding", F.coalesce(F.expr(ok), F.lit(False)).alias("valid"))
    valid = rows.where("valid").select("vec_id", F.expr("transform(embedding, x -> x + 0.0D)").alias("embedding"))
    classes = cut_lineage(valid.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"), F.bool_or(F.col("vec_id") % 50 == 0).alias("audited")))
    dims = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    exact = cut_lineage(arrow_map(classes, _raw_batches, "id long, weight long, audited boolean, v binary", dims=dims))
    vectors = cut_lineage(arrow_map(classes.select("id", "embedding"), _pack_batches, "id long, q binary", dims=dims))
    truth = _truth(exact, dims, threshold)
    truth = cut_lineage(truth.where("truth > 0"))
    lists, seen = None, 1.0
    for attempt in range(attempts):
        lists = descend(vectors, dims, k, seed=attempt + 1, start=lists)
        counts, grouped = _count(lists, exact, dims, threshold, k)
        hit = truth.join(counts, "id", "left").agg(F.sum("truth"), F.sum(F.least("truth", F.coalesce("n", F.lit(0))))).first()
        seen = hit[1] / hit[0] if hit[0] else 1.0
        if seen >= recall:
            break
    if seen < LEAST_RECALL:
        raise RuntimeError(f"{attempts} attempts found {seen:.3f} of the links of the audited vectors, less than {LEAST_RECALL}")
    node = classes.select("embedding", F.col("id"), "weight")
    node = node.join(counts, "id", "left").join(grouped.withColumnRenamed("node", "id"), "id", "left").select(
        "embedding", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.select("vec_id", F.when(F.col("valid"), F.expr("transform(embedding, x -> x + 0.0D)")).alias("embedding")).join(node, "embedding", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"), F.lit(float(seen)).alias("audit_recall"))


def _count(lists: DataFrame, exact: DataFrame, dims: int, threshold: float, k: int) -> tuple[DataFrame, DataFrame]:
    """Links per node (id, n) and components (node, component) from the lists."""
    close = lists.where(F.col("sim") >= threshold - SLACK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = (close.join(exact.select(F.col("id").alias("a"), F.col("v").alias("va")), "a")
            .join(exact.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b"))
    links = cut_lineage(arrow_map(both, _verify_batches, "a long, b long", dims=dims, threshold=threshold))
    grouped = cut_lineage(components(links))
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    listed = ends.join(exact.select(F.col("id").alias("b"), "weight"), "b").groupBy("a").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("c"))
    # a list full of links may have missed some: its component is compared as a whole, in blocks
    full = listed.where(F.col("c") >= k).select(F.col("a").alias("node")).join(grouped, "node").select("component").distinct()
    member = cut_lineage(grouped.join(full, "component", "left_semi"))
    size = member.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sided = member.join(size, "component").select("component", "blocks", F.col("node").alias("id"), F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("side"))
    sided = sided.join(exact, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sided = sided.select("component", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "id", "weight", "v", "side")
    blocked = sided.groupBy("component", "i", "j").applyInArrow(_by_name("_block_group", dims=dims, threshold=threshold), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rest = listed.select(F.col("a").alias("id"), "n").join(member.select(F.col("node").alias("id")), "id", "left_anti")
    return cut_lineage(rest.unionByName(blocked)), grouped


def _by_name(factory: str, **args):
    from .common import ROOT
    module, root = __name__, ROOT

    def run(group):
        import importlib
        import sys
        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), factory)(**args)(group)

    return run
