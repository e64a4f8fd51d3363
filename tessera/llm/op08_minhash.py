"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds its distinct word shingles.  The sketch has one slot per bin: in
rounds 0..t-1 every element falls into a hashed bin, and an empty bin keeps the smallest
value it gets; in rounds t..2t-1 all elements go to one given bin, so every bin fills.
Slots of two sets agree with a probability equal to their Jaccard similarity, and their
share is as concentrated as with independent minima.  Bands of slots propose pairs; full
sets confirm them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import textvec as tv
from .common import arrow_map, groups
from ..operators.components import components

U64 = tv.U64
BANDS, ROWS = 25, 5
LEADERS = 64  # of a bucket in its first round after the hub's; each further round has as many times more
BLOCK = 512   # documents of a bucket that one task compares with as many leaders
ROUND_BITS = 52


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct n-word shingles per row, sorted; rows with 1..n-1 words have one of all words."""
    w = tv.words(data, off, tv.NONSPACE)
    whole = tv.within_row(w, n)
    row, h = w.row[: len(whole)][whole], tv.ngram_hash(w.hash, n)[whole]
    for k in range(1, n):
        short = np.flatnonzero(w.per_row == k)
        at = w.first[short]
        if len(short):
            row = np.concatenate([row, short])
            h = np.concatenate([h, tv.ngram_hash(w.hash[at[:, None] + np.arange(k)].ravel(), k)[::k]])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[new], h[new]


def sketch(row: np.ndarray, h: np.ndarray, n_rows: int, t: int) -> np.ndarray:
    """n_rows x t slots; rows without elements keep the largest value everywhere.

    A slot holds round and value in one number, the round on top, so later rounds never replace earlier ones.
    """
    top = U64(2**64 - 1)
    slots = np.full(n_rows * t, top, U64)
    low = U64((1 << ROUND_BITS) - 1)
    for r in range(2 * t):
        if not len(h):
            break
        x = tv.mix(h ^ tv.mix(np.array([r + 1], U64)))
        bins = (x >> U64(40)) % U64(t) if r < t else np.full(len(h), r - t, U64)
        value = (U64(r) << U64(ROUND_BITS)) | (tv.mix(x) & low)
        np.minimum.at(slots, row * t + bins.astype(np.int64), value)
        open_rows = (slots.reshape(n_rows, t) == top).any(axis=1)
        keep = open_rows[row]
        row, h = row[keep], h[keep]
    return slots.reshape(n_rows, t)


def _sketch_batches(batches, n: int, bands: int, rows: int):
    for b in tv.chunks(batches, "text"):
        data, off = tv.text_buffers(b.column("text"))
        row, h = shingle_sets(data, off, n)
        size = np.bincount(row, minlength=b.num_rows).astype(np.int64)
        slots = sketch(row, h, b.num_rows, bands * rows).reshape(b.num_rows, bands, rows)
        keys = np.zeros((b.num_rows, bands), U64)
        with np.errstate(over="ignore"):
            for k in range(rows):
                keys = tv.mix(keys ^ slots[:, :, k])
            keys = tv.mix(keys + np.arange(bands, dtype=U64))
            one, two = np.zeros(b.num_rows, U64), np.zeros(b.num_rows, U64)
            np.add.at(one, row, tv.mix(h))
            np.add.at(two, row, tv.mix(h ^ U64(0xA5A5A5A5A5A5A5A5)))
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array(size), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
            pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))],
            names=["doc_id", "n_shingles", "d1", "d2", "bands"])


def _set_batches(batches, n: int):
    for b in tv.chunks(batches, "text"):
        row, h = shingle_sets(*tv.text_buffers(b.column("text")), n)
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b.num_rows))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64)))],
                                         names=["doc_id", "shingles"])


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of ``docs`` (doc_id, text).

    Links: ``100 * |A and B| >= percent * |A or B|`` of the shingle sets.  Null, empty and blank texts have
    an empty set and no link.  Rows of one doc_id are one document; a null doc_id links with nothing, has a
    null component and is kept.  An empty table gives an empty result.

    Equal sets collapse to one representative before anything is compared.  In each band bucket all members
    are verified against the bucket's hub, and components are joined.  Buckets whose other members still stand
    in different components go on in rounds: members outside the bucket's largest component lead, and are
    compared with all members of other components, in blocks of bounded size that put out links only.  A bucket
    rests when no member is left to lead, so every pair of a bucket is compared or in one component.
    """
    docs = docs.select("doc_id", "text")
    base = cut_lineage(arrow_map(docs, _sketch_batches, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>",
                                 n=shingle, bands=bands, rows=rows))
    classes = cut_lineage(base.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2", "n_shingles")
                          .agg(F.min("doc_id").alias("rep")))
    entries = (base.where("n_shingles > 0").select("doc_id", "d1", "d2", "n_shingles", "bands")
               .join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "d1", "d2", "n_shingles"], "left_semi")
               .select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n")))
    shared = entries.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last")
    member = cut_lineage(entries.join(shared.select("key", "hub"), "key").distinct())
    grouped = _link_buckets(member, docs, shingle, percent)
    comp = F.coalesce("component", "rep")
    of_class = classes.join(grouped, classes.rep == grouped.node, "left").select("d1", "d2", "n_shingles", comp.alias("component_id"))
    out = base.drop("bands").join(of_class, ["d1", "d2", "n_shingles"], "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(own))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _link_buckets(member: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Components (node, component) of ``member`` (key, id, n, hub), first by hubs, then by rounds of leaders.

    Components stand for the links that made them: later links join components, not all links so far anew.
    """
    named = member.select(F.col("id").alias("doc_id")).distinct()
    sets = cut_lineage(arrow_map(docs.join(named, "doc_id", "left_semi"), _set_batches, "doc_id long, shingles array<long>", n=shingle).withColumnRenamed("doc_id", "id"))
    # first round: a bucket's hub against the others, once per hub whatever number of bands they share; the hub's set is in each block once
    hubs = member.where("id = hub").select("hub", F.col("n").alias("nh")).distinct()
    near = F.least("n", "nh") * 100 >= F.greatest("n", "nh") * percent  # smaller / larger bounds the similarity
    spoke = member.where("id != hub").select("hub", "id", "n").distinct().join(hubs, "hub").where(near)
    spoke = cut_lineage(spoke.select(F.col("hub").alias("key"), "id", F.col("id").alias("component")))
    parts = spoke.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    leads = parts.select("key", F.col("key").alias("id"), F.col("key").alias("component"), "parts")
    grouped = cut_lineage(components(_compare_blocks(spoke.join(parts, "key"), leads, sets, percent)))
    # buckets of other bands with the same members say nothing new
    other = member.where("id != hub")
    same = other.groupBy("key", "hub").agg(F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s"))
    other = other.select("key", "id").join(same.where("c > 1").groupBy("hub", "c", "s").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")
    other, led, leaders = cut_lineage(other), None, LEADERS
    while True:
        now = cut_lineage(other.join(grouped.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")))
        # the largest component of a bucket needs no leader: its pairs with others are made by the others
        per = now.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
        top = per.groupBy("key").agg(F.max(F.struct("c", "component")).alias("t"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("k")).where("k > 1")
        now = cut_lineage(now.join(top.select("key", F.col("t.component").alias("main"), F.ceil(F.col("c") / BLOCK).cast("int").alias("parts")), "key"))
        other = now.select("key", "id")  # a bucket of one component stays so
        todo = now.where("component != main")
        if led is not None:
            todo = todo.join(led, ["key", "id"], "left_anti")
        rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
        chosen = cut_lineage(todo.withColumn("rank", rank).where(F.col("rank") <= leaders).drop("main"))
        if chosen.isEmpty():
            return grouped
        led = chosen.select("key", "id") if led is None else led.unionByName(chosen.select("key", "id"))
        found = cut_lineage(_compare_blocks(now, chosen, sets, percent))
        if not found.isEmpty():
            so_far = grouped.select(F.col("node").alias("a"), F.col("component").alias("b"))
            grouped = cut_lineage(components(found.unionByName(so_far)))
        leaders *= LEADERS


def _compare_blocks(now: DataFrame, chosen: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b), some more than once, between leaders and members of their buckets, by (bucket, block of members, block of leaders)."""
    sides = chosen.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("sides"))
    block = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    m = now.join(sides, "key").select("key", block.alias("i"), F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("j"), F.lit(0).alias("leads"), "id", "component")
    x = chosen.join(sides, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"),
                                         F.pmod(F.xxhash64("id"), F.col("sides")).cast("int").alias("j"), F.lit(1).alias("leads"), "id", "component")
    rows = m.unionByName(x).join(sets, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "leads")
    return arrow_map(rows, _compare_batches, "a long, b long", percent=percent)


def _compare_batches(batches, percent: int):
    for g in groups(batches, ["key", "i", "j"]):
        leads, ids, comp = (g.column(c).to_numpy() for c in ("leads", "id", "component"))
        col = g.column("shingles")
        size = col.value_lengths().to_numpy().astype(np.int64)
        flat, first = col.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)])
        n = int((leads == 0).sum())
        row, own = np.repeat(np.arange(n), size[:n]), flat[: first[n]]
        a, b = [], []
        for k in range(n, len(ids)):
            may = (comp[:n] != comp[k]) & (100 * np.minimum(size[:n], size[k]) >= percent * np.maximum(size[:n], size[k]))
            if not may.any():
                continue
            if may.all():
                r, f = row, own
            else:
                keep = may[row]
                r, f = row[keep], own[keep]
            lead = np.sort(flat[first[k]: first[k + 1]])
            at = np.minimum(np.searchsorted(lead, f), len(lead) - 1)
            inter = np.bincount(r[lead[at] == f], minlength=n)
            for i in np.flatnonzero(may & (100 * inter >= percent * (size[:n] + size[k] - inter))).tolist():
                a.append(int(ids[k]))
                b.append(int(ids[i]))
        if a:
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
