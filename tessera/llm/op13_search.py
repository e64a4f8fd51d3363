"""Ranked lexical search by norm buckets (LEMP).

A document is a vector of integer impacts, one per term that any item holds; an item is a vector of term
weights; a score is their inner product.  Document vectors are ordered by length and cut into buckets.
For an item, a bucket falls when the product of the lengths (Cauchy-Schwarz) is under the item's
threshold, the 50th best score known.  In the buckets that stay, coordinate bounds decide which terms a
document must share with the item, and bound what the other terms could add; whoever may still reach the
threshold is scored exactly, in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import textvec as tv
from .common import arrow_map

BUCKET = 1024             # documents of a bucket
POSTINGS = 1 << 20        # postings of focus terms looked at together; items are taken in runs of about as many
ITEM_TERMS = 1 << 20      # terms of the items that one pass over the documents serves; further items take further passes
ITEMS = 1 << 12           # items of a pass
VECTORS = "doc long, doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, doc long, score long"
ROUNDING = 1e-9           # what a bound in double precision may be off, relatively


def _item_batches(batches):
    """The distinct term hashes of each item."""
    for b in tv.chunks(batches, "text"):
        w = tv.words(*tv.text_buffers(b.column("text")))
        row, h = w.row, w.hash
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=b.num_rows))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column("item"), pa.ListArray.from_arrays(pa.array(ends), pa.array(h[new].view(np.int64)))], names=["item", "terms"])


def _vector_batches(batches, vocabulary: bytes):
    """Term numbers and frequencies of each document, of the vocabulary's terms alone, and its length in all terms."""
    known = np.frombuffer(vocabulary, np.uint64)
    for b in tv.chunks(batches, "text"):
        w = tv.words(*tv.text_buffers(b.column("text")))
        at = np.minimum(np.searchsorted(known, w.hash), max(len(known) - 1, 0))
        hit = known[at] == w.hash if len(known) else np.zeros(len(w.hash), bool)
        pair, tf = tv.counted(w.row[hit].astype(np.int64) << 32 | at[hit])
        ends = np.concatenate([[0], np.cumsum(np.bincount(pair >> 32, minlength=b.num_rows))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            b.column("doc"), b.column("doc_id"), pa.array(w.per_row), pa.ListArray.from_arrays(pa.array(ends), pa.array((pair & 0xFFFFFFFF).astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int32)))], names=["doc", "doc_id", "n", "terms", "tfs"])


def _df_batches(batches, size: int):
    """How many of a task's documents hold each term, and the task's counts of documents and terms (as -1 and -2)."""
    df, docs, length = np.zeros(size, np.int64), 0, 0
    for b in batches:
        df += np.bincount(b.column("terms").flatten().to_numpy(), minlength=size)
        n = b.column("n").to_numpy()
        docs, length = docs + int((n > 0).sum()), length + int(n.sum())
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([at, [-1, -2]]).astype(np.int32)), pa.array(np.concatenate([df[at], [docs, length]]))], names=["term", "df"])


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 20 * m), m = 100 - 50 + ((50 * n * docs) div length)."""
    per = np.array([50 * int(k) * docs // max(length, 1) for k in n], np.int64) if len(n) and int(n.max()) * docs > 1 << 57 else 50 * n * docs // max(length, 1)
    return 1_000_000_000 * tf // (1000 * tf + 20 * (100 - 50 + per))


def _impact_batches(batches, docs: int, length: int):
    """Impact vectors and their lengths; documents without any of the terms go."""
    for b in batches:
        b = b.filter(pa.array(b.column("terms").value_lengths().to_numpy() > 0))
        if not b.num_rows:
            continue
        size = b.column("terms").value_lengths().to_numpy()
        row = np.repeat(np.arange(b.num_rows), size)
        p = impacts(b.column("tfs").flatten().to_numpy().astype(np.int64), b.column("n").to_numpy()[row], docs, length)
        norm = np.sqrt(np.bincount(row, weights=p.astype(np.float64) ** 2, minlength=b.num_rows))
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("doc_id"), pa.array(norm), b.column("terms"), pa.ListArray.from_arrays(pa.array(ends), pa.array(p.astype(np.int32)))],
                                         names=["doc", "doc_id", "norm", "terms", "impacts"])


def _spread(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, position) of every position of the ranges first .. first + size - 1."""
    which = np.repeat(np.arange(len(first)), size)
    return which, np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(which))


class Items:
    """Items as sparse weight vectors: terms and weights one after the other, and where each item starts."""

    def __init__(self, first: bytes, terms: bytes, weights: bytes) -> None:
        self.first, self.terms, self.weights = np.frombuffer(first, np.int64), np.frombuffer(terms, np.int32), np.frombuffer(weights, np.int64)
        self.size = np.diff(self.first)
        self.item = np.repeat(np.arange(len(self.size)), self.size)
        self.length = np.sqrt(np.bincount(self.item, weights=self.weights.astype(np.float64) ** 2, minlength=len(self.size)))


def search_bucket(items: Items, floor: np.ndarray, norm: np.ndarray, row: np.ndarray, term: np.ndarray, impact: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, row, score) of the bucket's documents that score at least ``floor`` of the item.

    ``row``, ``term`` and ``impact`` are the documents' coordinates by row and term; ``size`` is the vocabulary's.
    """
    none = np.zeros(0, np.int64)
    alive = items.length * norm.max() * (1 + ROUNDING) >= floor  # Cauchy-Schwarz for the whole bucket
    if not alive.any():
        return none, none, none
    top = np.zeros(size, np.int64)
    np.maximum.at(top, term, impact)
    # an item's terms by what they can add at most; those whose whole rest cannot reach the threshold need not be met
    add = items.weights * top[items.terms]
    order = np.lexsort((-add, items.item))
    order = order[alive[items.item[order]] & (add[order] > 0)]
    item, part = items.item[order], add[order]
    if not len(order):
        return none, none, none
    total = np.bincount(item, weights=part, minlength=len(items.size))
    upto = np.cumsum(part)
    start = np.concatenate([[0], np.flatnonzero(item[1:] != item[:-1]) + 1])
    before = upto - part - np.repeat((upto - part)[start], np.diff(np.append(start, len(item))))  # what the terms ahead can add
    focus = (total[item] - before) * (1 + ROUNDING) >= floor[item]
    rest = np.bincount(item[~focus], weights=part[~focus], minlength=len(items.size))  # what the others can add together
    weight, terms = items.weights[order], items.terms[order]
    free = np.sqrt(np.bincount(item[~focus], weights=weight[~focus].astype(np.float64) ** 2, minlength=len(items.size)))
    item, weight, terms = item[focus], weight[focus], terms[focus]
    by_term = np.argsort(term, kind="stable")
    ends = np.searchsorted(term[by_term], np.arange(size + 1))
    postings = np.cumsum(ends[terms + 1] - ends[terms])
    key = row.astype(np.int64) * size + term
    out, a = [], 0
    while a < len(item):
        # a run of whole items with some POSTINGS postings of focus terms
        z = int(np.searchsorted(postings, (postings[a - 1] if a else 0) + POSTINGS, "right"))
        z = int(np.searchsorted(item, item[min(max(z, a), len(item) - 1)], "left"))
        z = z if z > a else int(np.searchsorted(item, item[a], "right"))
        run, w, t = item[a:z], weight[a:z], terms[a:z]
        a = z
        which, place = _spread(ends[t], ends[t + 1] - ends[t])
        place = by_term[place]
        pair, back = np.unique(run[which] * np.int64(len(norm)) + row[place], return_inverse=True)
        partial = np.zeros(len(pair), np.int64)
        np.add.at(partial, back, w[which] * impact[place])
        square = np.bincount(back, weights=impact[place].astype(np.float64) ** 2, minlength=len(pair))
        who, doc = pair // len(norm), pair % len(norm)
        # the rest adds at most its coordinate bounds, and at most the product of what is left of both lengths
        left = np.sqrt(np.maximum(norm[doc] ** 2 * (1 + ROUNDING) - square, 0))
        may = (partial + np.minimum(rest[who], free[who] * left)) * (1 + ROUNDING) >= floor[who]
        who, doc = who[may], doc[may]
        # survivors, exactly
        which, place = _spread(items.first[who], items.size[who])
        wanted = doc[which] * size + items.terms[place]
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        hit = key[at] == wanted
        score = np.zeros(len(who), np.int64)
        np.add.at(score, which[hit], items.weights[place[hit]] * impact[at[hit]])
        ok = (score >= floor[who]) & (score > 0)
        out.append((who[ok], doc[ok], score[ok]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (none, none, none)


def _search_batches(batches, items: dict, floor: bytes, size: int, k: int, buckets: int):
    """The best ``k`` documents of each item among a task's first ``buckets`` buckets (0: all), longest vectors first.

    Thresholds start at ``floor`` and rise with the k best found so far; equal scores are kept.
    """
    q = Items(**items)
    floor = np.frombuffer(floor, np.int64).copy()
    best = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, document's id, its number
    held, rows, done = [], 0, 0

    def bucket(table):
        nonlocal best
        terms = table.column("terms")
        lengths = terms.value_lengths().to_numpy()
        row = np.repeat(np.arange(table.num_rows), lengths)
        who, doc, score = search_bucket(q, floor, table.column("norm").to_numpy(), row, terms.flatten().to_numpy(), table.column("impacts").flatten().to_numpy().astype(np.int64), size)
        if not len(who):
            return
        ids = table.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        best = [np.concatenate([a, b]) for a, b in zip(best, (who, score, ids[doc], table.column("doc").to_numpy()[doc]), strict=True)]
        order = np.lexsort((best[3], best[2], -best[1], best[0]))
        best = [a[order] for a in best]
        first = np.searchsorted(best[0], np.arange(len(q.size) + 1))
        rank = np.arange(len(order)) - first[best[0]]
        kth = np.flatnonzero(rank == k - 1)
        floor[best[0][kth]] = np.maximum(floor[best[0][kth]], best[1][kth])
        best = [a[rank < k] for a in best]

    for b in batches:
        while b.num_rows:
            some = b.slice(0, BUCKET - rows)
            b = b.slice(some.num_rows)
            held.append(some)
            rows += some.num_rows
            if rows == BUCKET and not (buckets and done >= buckets):
                bucket(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, rows, done = [], 0, done + 1
            elif rows == BUCKET:
                held, rows = [], 0
    if rows and not (buckets and done >= buckets):
        bucket(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
    ids = pa.array(best[2], mask=best[2] == np.iinfo(np.int64).max)
    yield pa.RecordBatch.from_arrays([pa.array(best[0].astype(np.int32)), ids, pa.array(best[3]), pa.array(best[1])], names=["item", "doc_id", "doc", "score"])


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "doc")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 for each item.

    ``docs`` (doc_id, text), ``items`` (item_id, text); other columns are left out.  Terms are runs of letters, digits
    and non-ASCII characters, A-Z lower-cased, known by a 64-bit hash.  Null and empty texts have no terms: such items
    have no rows and such documents count nowhere.  Equal scores go to the smaller doc_id, null ids last.  Rows that
    share a doc_id are documents of their own, items that share an item_id are ranked each for itself.

    Items are served in passes of ``ITEM_TERMS`` terms and ``ITEMS`` items at most, so what tasks are sent is bounded.
    """
    spark = docs.sparkSession
    numbered = cut_lineage(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()))
    listed = cut_lineage(arrow_map(numbered.select("item", "text"), _item_batches, "item long, terms array<long>").where("size(terms) > 0"))
    place = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # passes: runs of items, by the terms and items before them; one row per task of the items' table
    part = listed.withColumn("part", F.shiftright("item", 33)).groupBy("part").agg(F.sum(F.size("terms")).alias("terms"), F.count(F.lit(1)).alias("n"))
    part = part.select("part", F.coalesce(F.sum("terms").over(place), F.lit(0)).alias("terms0"), F.coalesce(F.sum("n").over(place), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("part").orderBy("item")
    run = listed.withColumn("part", F.shiftright("item", 33)).join(F.broadcast(part), "part")
    run = run.withColumn("t", F.col("terms0") + F.sum(F.size("terms")).over(inside)).withColumn("r", F.col("n0") + F.row_number().over(inside) - 1)
    run = cut_lineage(run.select("item", "terms", F.greatest(F.floor(F.col("t") / ITEM_TERMS), F.floor(F.col("r") / ITEMS)).alias("pass")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("doc", F.monotonically_increasing_id())
    out = None
    for (number,) in sorted(run.select("pass").distinct().collect()):
        found = _pass(texts, run.where(F.col("pass") == number), k)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    return out.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _pass(texts: DataFrame, run: DataFrame, k: int) -> DataFrame:
    """item, rank, doc_id, score of the items of one pass."""
    mine = run.orderBy("item").toArrow()
    terms = mine.column("terms").combine_chunks()
    flat = terms.flatten().to_numpy().view(np.uint64)
    known, number = np.unique(flat, return_inverse=True)
    first = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())]).astype(np.int64)
    vectors = cut_lineage(arrow_map(texts, _vector_batches, VECTORS, vocabulary=known.tobytes()))
    counts = arrow_map(vectors.select("n", "terms"), _df_batches, "term int, df long", size=len(known)).groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    counts = dict(zip(counts.column("term").to_pylist(), counts.column("df").to_pylist(), strict=True))
    docs, length = counts.pop(-1, 0), counts.pop(-2, 0)
    df = np.zeros(len(known), np.int64)
    df[list(counts)] = list(counts.values())
    weight = np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)
    sent = {"first": first.tobytes(), "terms": number.astype(np.int32).tobytes(), "weights": weight[number].tobytes()}
    ordered = arrow_map(vectors, _impact_batches, "doc long, doc_id long, norm double, terms array<int>, impacts array<int>", docs=docs, length=length)
    ordered = cut_lineage(ordered.repartitionByRange(F.desc("norm"), "doc").sortWithinPartitions(F.desc("norm"), "doc"))
    # the longest vectors of every task give first thresholds; the k-th best of any documents is a lower bound
    start = np.ones(len(first) - 1, np.int64)
    sample = arrow_map(ordered, _search_batches, FOUND, items=sent, floor=start.tobytes(), size=len(known), k=k, buckets=1)
    for r in _top(sample, k).where(F.col("rank") == k).select("item", "score").collect():
        start[r["item"]] = max(1, r["score"])
    found = arrow_map(ordered, _search_batches, FOUND, items=sent, floor=start.tobytes(), size=len(known), k=k, buckets=0)
    names = run.sparkSession.createDataFrame(pa.table({"number": pa.array(np.arange(len(first) - 1, dtype=np.int32)), "item": mine.column("item")}))
    best = _top(found, k).withColumnRenamed("item", "number")
    return cut_lineage(best.join(names, "number").select("item", "rank", "doc_id", "score"))
