"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, memory-mapped by the workers.

Level k holds all k-grams of the training texts as a sorted array of 64-bit keys, cut into
shards by the keys' leading bits.  A word's key is its hash; a longer gram's key is a
bijective mix of (index of its first k-1 words in level k-1, index of its last word in level
1), so grams never collide and a key leads back to both parts.  Every array is one file per
shard in the shared folder, written under another name and then renamed, so a task that runs
again leaves the same file.

Map tasks count what they read before the shuffle and send arrays, not rows; nothing but
shard sizes and counts of counts reaches the driver.  Counts are kept in the narrowest type and
probabilities are worked out when texts are scored, so a gram of the top level takes some 9 bytes.
"""

from __future__ import annotations

import gc
import os
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffle_partitions
from . import textvec as tv
from .common import arrow_map, fold, plain_path

U64 = tv.U64
BEGIN, END = tv.mix(np.array([1, 2], U64))
HOLD = 1 << 21  # distinct grams a map task keeps before it sends them on
PARTS = 2  # runs over the texts for a level above 2; each shuffles that part of the shards
NONE = np.int64(-1)
CHUNK_BYTES = 1 << 21  # text bytes whose grams are looked up together: the more, the more of a lookup is in order
HASH_BYTES = 1 << 17  # text bytes, in whole rows, whose words are hashed together: numbers made per byte stay near the processor


def unmix(x: np.ndarray) -> np.ndarray:
    """Inverse of ``textvec.mix``."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(31)) ^ (x >> U64(62))
        x = x * U64(pow(0x94D049BB133111EB, -1, 1 << 64))
        x = x ^ (x >> U64(27)) ^ (x >> U64(54))
        x = x * U64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
        x = x ^ (x >> U64(30)) ^ (x >> U64(60))
        return x - U64(0x9E3779B97F4A7C15)


def gram_key(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    return tv.mix(prefix.astype(U64) << U64(32) | word.astype(U64))


class Store:
    """Folder of a model; every array is mapped when first used."""

    def __init__(self, path: str, bits: int, sizes: dict[int, list[int]]) -> None:
        self.path, self.bits, self.sizes, self.maps = path, bits, sizes, {}
        for n in sizes.values():
            if sum(n) >= 1 << 32:
                raise ValueError("a level of over 2^32 grams needs wider indices")
        self.first = {k: np.concatenate([[0], np.cumsum(n)]).astype(np.int64) for k, n in sizes.items()}

    def __getstate__(self):
        return {**self.__dict__, "maps": {}}

    def name(self, level: int, what: str, shard: int) -> str:
        return f"{self.path}/{level}-{what}-{shard:05d}.npy"

    def write(self, level: int, what: str, shard: int, values: np.ndarray) -> None:
        part = f"{self.path}/.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            np.save(f, values)
        os.replace(part, self.name(level, what, shard))

    def array(self, level: int, what: str, shard: int) -> np.ndarray:
        at = (level, what, shard)
        if at not in self.maps:
            name = self.name(*at)
            if what == "used" and not os.path.exists(name):  # the top level; grams without a left neighbour begin a text
                name = self.name(level, "count", shard)
            self.maps[at] = np.asarray(np.load(name, mmap_mode="r"))  # mapped still, as a plain array
        return self.maps[at]

    def keys(self, level: int, index: np.ndarray) -> np.ndarray:
        """Keys of a level at ascending indices."""
        edge = np.searchsorted(index, self.first[level])
        some = np.flatnonzero(np.diff(edge)).tolist()
        return np.concatenate([np.empty(0, U64), *[self.array(level, "key", s)[index[edge[s]: edge[s + 1]] - self.first[level][s]] for s in some]])

    def suffix(self, level: int, keys: np.ndarray) -> np.ndarray:
        """Index in the level below of each gram without its first word."""
        pair = unmix(keys)
        word = pair & U64(0xFFFFFFFF)
        if level == 2:
            return word.astype(np.int64)
        one, _, back = tv.distinct((pair >> U64(32)).astype(np.int64))
        keys, _, back = tv.distinct(gram_key(self.suffix(level - 1, self.keys(level - 1, one))[back], word))
        return self.find(level - 1, keys)[back]

    def shard(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> U64(64 - self.bits)).astype(np.int64)

    def find(self, level: int, keys: np.ndarray) -> np.ndarray:
        """Index of each key of an ascending array in the level, -1 where it has none."""
        out = np.full(len(keys), NONE)
        edge = np.searchsorted(self.shard(keys), np.arange((1 << self.bits) + 1))
        for s in np.flatnonzero(np.diff(edge)).tolist():
            a, z = edge[s], edge[s + 1]
            if self.sizes[level][s]:
                have = self.array(level, "key", s)
                at = np.minimum(np.searchsorted(have, keys[a:z]), len(have) - 1)
                out[a:z] = np.where(have[at] == keys[a:z], at + self.first[level][s], NONE)
        return out

    def take(self, level: int, what: str, index: np.ndarray, missing: float) -> np.ndarray:
        """Values at ascending indices; -1 gives ``missing``."""
        out = np.full(len(index), missing)
        edge = np.searchsorted(index, self.first[level])
        for s in np.flatnonzero(np.diff(edge)).tolist():
            out[edge[s]: edge[s + 1]] = self.array(level, what, s)[index[edge[s]: edge[s + 1]] - self.first[level][s]]
        return out

    def known(self, level: int, what: str, index: np.ndarray, missing: float) -> np.ndarray:
        """``take`` with -1 anywhere among the ascending indices."""
        out, ok = np.full(len(index), missing), index >= 0
        out[ok] = self.take(level, what, index[ok], missing)
        return out


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of begin mark, words and end mark of every row."""
    cut = np.searchsorted(off, np.arange(0, off[-1], HASH_BYTES), "right") - 1
    cut = np.unique(np.concatenate([[0], cut, [len(off) - 1]])).tolist()
    some = [tv.words(data[off[a]: off[z]], off[a: z + 1] - off[a], tv.NONSPACE) for a, z in zip(cut[:-1], cut[1:], strict=True)] or [tv.words(data, off, tv.NONSPACE)]
    size = np.concatenate([w.per_row for w in some]) + 2
    begin = np.cumsum(size) - size
    h, word = np.empty(int(size.sum()), U64), np.ones(int(size.sum()), bool)
    word[begin] = word[begin + size - 1] = False
    h[word], h[begin], h[begin + size - 1] = np.concatenate([w.hash for w in some]), BEGIN, END
    return h, np.repeat(np.arange(len(size)), size)


def grams(store: Store, h: np.ndarray, row: np.ndarray, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level 1..levels: the indices of the distinct grams (-1: unknown, and once more at the end), and which of
    them ends at each token; the last where no gram of the row does."""
    one, _, place = tv.distinct(h)
    out = [(np.append(store.find(1, one), NONE), place)]
    for k in range(2, levels + 1):
        last, word = (one[place] for one, place in (out[-1], out[0]))
        ok = np.flatnonzero((last[:-1] >= 0) & (word[1:] >= 0) & (row[1:] == row[:-1])) + 1
        keys, _, back = tv.distinct(gram_key(last[ok - 1], word[ok]))
        place = np.full(len(h), len(keys))
        place[ok] = back
        out.append((np.append(store.find(k, keys), NONE), place))
    return out


def narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the narrowest type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Byte planes, of the steps if the values rise: high bytes are mostly zero and the shuffle compresses them away."""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def unpacked(data, kind: type, rising: bool = False) -> np.ndarray:
    values = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)
    return np.cumsum(values, dtype=kind) if rising else values


def _send(bits: int, keys: np.ndarray, cols: list[np.ndarray]):
    """A row per shard: the shard's keys and further columns as bytes."""
    edge = np.searchsorted((keys >> U64(64 - bits)).astype(np.int64), np.arange((1 << bits) + 1))
    some = np.flatnonzero(np.diff(edge)).tolist()
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[
            pa.array([packed(c[edge[s]: edge[s + 1]], not k) for s in some], pa.binary()) for k, c in enumerate((keys, *cols))]],
            names=["shard", "key", *[f"c{k}" for k in range(len(cols))]])


def _count_batches(batches, store: Store, level: int, part: int, parts: int):
    """Counts of the level's grams in every ``parts``-th shard."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def merged():
        keys = np.concatenate([x[0] for x in held])
        order = np.argsort(keys, kind="stable")  # runs in order already
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(np.concatenate([x[1] for x in held])[order], first).astype(np.uint32)

    for b in tv.chunks(batches, "text", CHUNK_BYTES):
        h, row = tokens(*tv.text_buffers(b.column("text")))
        if level == 1:
            held.append(tv.counted(h))
        else:
            found = grams(store, h, row, level - 1)
            last, word = (one[place] for one, place in (found[-1], found[0]))
            ok = np.flatnonzero((last[:-1] >= 0) & (row[1:] == row[:-1])) + 1
            keys = gram_key(last[ok - 1], word[ok])
            held.append(tv.counted(keys if parts == 1 else keys[store.shard(keys) % parts == part]))
        size += len(held[-1][0])
        if size > 4 * HOLD:
            held = [merged()]
            size = len(held[0][0])
            if size > HOLD:
                yield from _send(store.bits, held[0][0], [held[0][1]])
                held, size = [], 0
    if held:
        keys, n = merged()
        yield from _send(store.bits, keys, [n])


def _shards(batches, kinds: list[type]):
    """Blobs of a task by shard, each column as a list of arrays."""
    found: dict[int, list[list[np.ndarray]]] = {}
    for b in batches:
        cols = [b.column(n) for n in b.schema.names[1:]]
        for r, s in enumerate(b.column("shard").to_pylist()):
            parts = found.setdefault(s, [[] for _ in cols])
            for k, (p, c, kind) in enumerate(zip(parts, cols, kinds, strict=True)):
                p.append(unpacked(c[r].as_buffer(), kind, not k))
    for s, parts in found.items():
        yield s, [np.concatenate(p) for p in parts]


def _gather_batches(batches, store: Store, level: int):
    """Write a level's shards: keys and counts."""
    for s, (keys, counts) in _shards(batches, [U64, np.uint32]):
        order = np.argsort(keys, kind="stable")  # runs in order already
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        store.write(level, "key", s, keys[first])
        store.write(level, "count", s, narrow(np.add.reduceat(counts[order].astype(np.int64), first)))
        yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "n": pa.array([len(first)], pa.int64())})


def _begin_index(store: Store) -> int:
    return int(store.find(1, np.array([BEGIN], U64))[0])


def _continue_batches(batches, store: Store, level: int):
    """Of each shard of a level: per gram of the level below, how many distinct grams end in it."""
    for b in batches:
        for s in b.column("shard").to_pylist():
            if store.sizes[level][s]:
                yield from _by_index(store, level - 1, *tv.counted(store.suffix(level, np.asarray(store.array(level, "key", s)))))


def _by_index(store: Store, level: int, index: np.ndarray, *cols: np.ndarray):
    """Send columns of ascending gram indices to the shards that hold them."""
    edge = np.searchsorted(index, store.first[level])
    some = np.flatnonzero(np.diff(edge)).tolist()
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[
            pa.array([packed(c[edge[s]: edge[s + 1]], not k) for s in some], pa.binary()) for k, c in enumerate((index.astype(np.uint32), *[x.astype(np.int64) for x in cols]))]],
            names=["shard", "key", *[f"c{k}" for k in range(len(cols))]])


def _continued_batches(batches, store: Store, level: int):
    """Write a level's numerators: distinct left neighbours, or the plain count of grams that begin a text."""
    for s, (index, n) in _shards(batches, [np.uint32, np.int64]):
        size = store.sizes[level][s]
        used = np.bincount(index.astype(np.int64) - store.first[level][s], weights=n, minlength=size).astype(np.int64)
        raw = np.asarray(store.array(level, "count", s))
        store.write(level, "used", s, narrow(np.where(used > 0, used, raw)))
        yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "n": pa.array([size], pa.int64())})


def _count_counts_batches(batches, store: Store, level: int):
    """Grams of a shard that were counted 1, 2, 3, 4 times and more often, and the sum of their counts."""
    begin = _begin_index(store) if level == 1 else -1
    for b in batches:
        for s in b.column("shard").to_pylist():
            if not store.sizes[level][s]:
                continue
            used = np.asarray(store.array(level, "used", s))
            if level == 1 and store.first[1][s] <= begin < store.first[1][s + 1]:
                used = np.delete(used, begin - store.first[1][s])  # never predicted
            n = [int((used == c).sum()) for c in (1, 2, 3, 4)] + [int((used >= 3).sum()), int(used.sum()), len(used)]
            yield pa.RecordBatch.from_pydict({f"n{k}": pa.array([x], pa.int64()) for k, x in enumerate(n)})


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; where counts of counts are too few for them, 0.5, 1 and 1.5."""
    if min(n1, n2, n3) > 0:
        y = n1 / (n1 + 2 * n2)
        d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < x <= k for k, x in enumerate(d, 1)):
            return d
    return 0.5, 1.0, 1.5


def _contexts_batches(batches, store: Store, level: int):
    """Of each shard: per context, the sum of its grams' counts and how many have 1, 2 and more."""
    for b in batches:
        for s in b.column("shard").to_pylist():
            if not store.sizes[level][s]:
                continue
            prefix = (unmix(np.asarray(store.array(level, "key", s))) >> U64(32)).astype(np.int64)
            used = np.asarray(store.array(level, "used", s))
            by, prefix = tv.in_order(prefix)
            used = used[by]
            first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
            cols = [np.add.reduceat(x.astype(np.int64), first) for x in (used, used == 1, used == 2, used >= 3)]
            yield from _by_index(store, level - 1, prefix[first], *cols)


def _context_batches(batches, store: Store, level: int, cut: tuple[float, ...]):
    """Write, per gram of ``level`` as a context: the sum of counts that follow, and the weight of the lower order."""
    for s, (index, *cols) in _shards(batches, [np.uint32, *[np.int64] * 4]):
        size = store.sizes[level][s]
        at = index.astype(np.int64) - store.first[level][s]
        total, *n = (np.bincount(at, weights=c, minlength=size) for c in cols)
        store.write(level, "total", s, narrow(total.astype(np.int64)))
        store.write(level, "gamma", s, np.where(total > 0, sum(d * x for d, x in zip(cut, n, strict=True)) / np.maximum(total, 1), 1.0).astype(np.float32))
        yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "n": pa.array([size], pa.int64())})


def _blank_batches(batches, store: Store, level: int):
    """Grams that are no context of anything: weight 1."""
    for b in batches:
        for s in b.column("shard").to_pylist():
            if store.sizes[level][s] and not os.path.exists(store.name(level, "gamma", s)):
                store.write(level, "gamma", s, np.ones(store.sizes[level][s], np.float32))
                store.write(level, "total", s, np.zeros(store.sizes[level][s], np.uint8))
            yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "n": pa.array([store.sizes[level][s]], pa.int64())})


def forget(spark) -> None:
    """Let Spark delete the shuffle files of ended jobs before the next one writes its own."""
    gc.collect()
    spark._jvm.System.gc()


def fit(texts: DataFrame, order: int) -> dict:
    """Count the texts (column ``text``) and write the model; returns the store and its few totals."""
    spark = texts.sparkSession
    path = f"{plain_path(ensure_checkpoint_dir(spark))}/tessera-lm-{uuid.uuid4().hex}"
    Path(path).mkdir(parents=True)
    bits = max(4, (shuffle_partitions(spark) - 1).bit_length())
    store = Store(path, bits, {})
    shards = 1 << bits

    def deal(df):
        return df.repartition(shards, "shard")

    def each(fn, schema="shard int, n long", **args):
        return arrow_map(spark.range(0, shards, 1, min(shards, shuffle_partitions(spark))).select(F.col("id").cast("int").alias("shard")), fn, schema, **args)

    def counted(k, part, parts):
        sent = deal(arrow_map(texts.select("text"), _count_batches, "shard int, key binary, c0 binary", store=store, level=k, part=part, parts=parts))
        return arrow_map(sent, _gather_batches, "shard int, n long", store=store, level=k).collect()  # a row per shard

    for k in range(1, order + 1):
        sizes, parts = [0] * shards, PARTS if k > 2 else 1
        for part in range(parts):
            for r in counted(k, part, parts):
                sizes[r["shard"]] = r["n"]
            forget(spark)
        store = Store(path, bits, {**store.sizes, k: sizes})
    cuts, totals = {}, {}
    for k in range(order, 0, -1):
        if k < order:
            deal(each(_continue_batches, "shard int, key binary, c0 binary", store=store, level=k + 1)).transform(
                lambda df, k=k: arrow_map(df, _continued_batches, "shard int, n long", store=store, level=k)).count()
            forget(spark)
        n = each(_count_counts_batches, ", ".join(f"n{i} long" for i in range(7)), store=store, level=k).groupBy().sum().first()
        n = [x or 0 for x in n]
        cuts[k], totals[k] = discounts(*n[:4]), n
    for k in range(order, 1, -1):
        deal(each(_contexts_batches, "shard int, key binary, c0 binary, c1 binary, c2 binary, c3 binary", store=store, level=k)).transform(
            lambda df, k=k: arrow_map(df, _context_batches, "shard int, n long", store=store, level=k - 1, cut=cuts[k])).count()
        forget(spark)
        each(_blank_batches, store=store, level=k - 1).count()
    plain = each(_plain_totals_batches, "n long, v long", store=store).groupBy().sum().first()
    n1, n2, _, _, n3, total, _ = totals[1]
    free = sum(d * x for d, x in zip(cuts[1], (n1, n2, n3), strict=True)) / total if total else 1.0
    return {"store": store, "order": order, "n": plain[0] or 0, "v": plain[1] or 0, "free": free, "cuts": cuts, "total": float(total)}


def _plain_totals_batches(batches, store: Store):
    begin = _begin_index(store)
    for b in batches:
        for s in b.column("shard").to_pylist():
            if store.sizes[1][s]:
                counts = np.asarray(store.array(1, "count", s))
                if store.first[1][s] <= begin < store.first[1][s + 1]:
                    counts = np.delete(counts, begin - store.first[1][s])
                yield pa.RecordBatch.from_pydict({"n": pa.array([int(counts.sum())], pa.int64()), "v": pa.array([len(counts)], pa.int64())})


def _score_batches(batches, model: dict):
    store, order = model["store"], model["order"]
    n_train, v = model["n"], model["v"]

    def less(k, index):
        used = store.known(k, "used", index, 0.0)
        return used - np.array([0.0, *model["cuts"][k]])[np.minimum(used, 3).astype(np.int64)]

    for b in tv.chunks(batches, "text", CHUNK_BYTES):
        h, row = tokens(*tv.text_buffers(b.column("text")))
        # everything is looked up once per distinct gram
        found = grams(store, h, row, order)
        said = np.concatenate([[False], row[1:] == row[:-1]])  # all but begin marks
        one, place = found[0]
        known = store.known(1, "count", one, 0.0)
        base, known = np.log10((known + 0.1) / (n_train + 0.1 * (v + 1)))[place], (known > 0)[place]
        p = (less(1, one) / max(model["total"], 1.0) + model["free"] / (v + 1))[place]
        for k in range(2, order + 1):
            context, before = found[k - 2]
            at = np.full(len(h), len(context) - 1)
            at[1:] = np.where(said[1:], before[:-1], len(context) - 1)
            total, gamma = np.maximum(store.known(k - 1, "total", context, 1.0), 1.0), store.known(k - 1, "gamma", context, 1.0)
            one, place = found[k - 1]
            p = less(k, one)[place] / total[at] + gamma[at] * p
        rows, at = b.num_rows, row[said]
        sums = [np.bincount(at, weights=x[said], minlength=rows) for x in (known, base, np.log10(p))]
        count = np.bincount(at, minlength=rows)
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), b.column("held_out"), pa.array(count, pa.int64()), pa.array(sums[0].astype(np.int64)),
            pa.array(np.full(rows, n_train), pa.int64()), pa.array(sums[1]), pa.array(sums[2]), pa.array(10 ** (-sums[2] / count))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])


def score(docs: DataFrame, order: int = 3, parts: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity per row of ``docs``.

    Learns from rows outside fold 0 of ``parts`` and scores all.  Null and empty texts are their end mark
    alone.  Words that training lacks share the weight that the lowest order gives to one unseen word.  With
    no training rows every token has probability 1.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (fold("doc_id", parts) == 0).alias("held_out"))
    model = fit(rows.where("not held_out"), order)
    return arrow_map(rows, _score_batches, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double",
                     model=model)
