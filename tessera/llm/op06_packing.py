"""Packing token pieces into sequences by minimum bin slack.

Texts are cut where the tokenizer never joins, and each distinct word is encoded once per worker.  Bins are planned on the histogram of piece lengths: the bin
holds the largest length left and the combination of the others that fills it best (a
subset-sum over bitsets); that combination is taken as often as its lengths last.  The plan has
at most some thousand rows whatever the corpus' size.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import textvec as tv
from .common import arrow_map

CAPACITY = 4096
CACHE_WORDS = 1 << 19  # distinct words a worker remembers before it starts anew; some 35 bytes each


_PLAIN = np.zeros(256, bool)
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = True
_MARKS = np.zeros(256, bool)
_MARKS[np.frombuffer(b"!#$%&()*+,-./:;=?@[]^_{}~", np.uint8)] = True  # neither apostrophe nor the marks of special tokens


class WordEncoder:
    """Token ids of texts, by way of a memory of word ids.

    Texts are cut at ASCII white space, and where an ASCII letter or digit meets an ASCII mark; the
    tokenizer splits at both places before it merges.  It also lower-cases, so words are remembered
    lower-cased, but for those with a ``<``, which may be a special token.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks run side by side already; threads for short words mostly wait
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # by ascending hash: which word it is
        self.first, self.size, self.pool, self.used = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32), np.zeros(1 << 14, np.uint32), 0

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size, k = np.fromiter(map(len, ids), np.int64, len(ids)), len(self.keys)
        flat = np.fromiter((x for i in ids for x in i), np.uint32, int(size.sum()))
        while k + len(ids) > len(self.first):
            self.first, self.size = np.resize(self.first, 2 * len(self.first)), np.resize(self.size, 2 * len(self.size))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.first[k: k + len(ids)], self.size[k: k + len(ids)] = self.used + np.cumsum(size) - size, size
        self.pool[self.used: self.used + len(flat)] = flat
        self.used += len(flat)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, at, keys), np.insert(self.place, at, np.arange(k, k + len(ids), dtype=np.int32))

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, number of ids per row)."""
        low = tv.LOWER[data]
        inside = tv.NONSPACE[data]
        for a, z in zip(*tv.runs(inside, off), strict=True) if (data == 60).any() else ():
            if (data[a:z] == 60).any():
                low[a:z] = data[a:z]
        edge = np.zeros(len(data), bool)
        edge[1:] = _PLAIN[data[:-1]] & _MARKS[data[1:]]
        start, end = tv.runs(inside, np.concatenate([off, np.flatnonzero(edge)]))
        row = np.searchsorted(off, start, "right") - 1
        keys, one, back = tv.distinct(tv.span_hash(low, start, end))
        if len(self.keys) > CACHE_WORDS:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != keys) if len(self.keys) else np.arange(len(keys))
        for k in range(0, len(new), 1 << 13):
            some = new[k: k + (1 << 13)]
            part = one[some]
            self._learn(keys[some], [low[a:z].tobytes().decode() for a, z in zip(start[part].tolist(), end[part].tolist(), strict=True)])
        place = self.place[np.searchsorted(self.keys, keys)][back]
        size, first = self.size[place].astype(np.int64), self.first[place].astype(np.int64)
        before = np.cumsum(size) - size
        ids = self.pool[np.repeat(first - before, size) + np.arange(int(size.sum()))]
        return ids, np.bincount(row, weights=size, minlength=len(off) - 1).astype(np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The process' encoder: a worker keeps its memory of words from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _piece_batches(batches, path: str, capacity: int, end_id: int):
    words, part, seen = encoder(path), TaskContext.get().partitionId(), {}
    for b in tv.chunks(batches, "text"):
        ids, n = words.encode(*tv.text_buffers(b.column("text")))
        ids = np.insert(ids, np.cumsum(n), end_id).astype("<u4")
        total = n + 1
        pieces = -(-total // capacity)
        row = np.repeat(np.arange(b.num_rows), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * capacity
        length = np.minimum(capacity, total[row] - start)
        at = (np.cumsum(total) - total)[row] + start
        crc = [zlib.crc32(ids[a: a + k].tobytes()) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
        local = []
        for k in length.tolist():
            seen[k] = seen.get(k, -1) + 1
            local.append(seen[k])
        yield pa.RecordBatch.from_arrays([
            b.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
            pa.array(crc, pa.int64()), pa.array(np.full(len(row), part), pa.int32()), pa.array(local, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"])


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Combination of available lengths with the largest sum of at most ``room`` (subset-sum over a bitset)."""
    mask, bits, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            more = bits | (bits << length) & mask
            if more == bits:
                break
            steps.append((length, bits))
            bits = more
            if bits >> room & 1:
                break
        if bits >> room & 1:
            break
    left, used = bits.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> left & 1:  # this sum needs the step
            used[length] = used.get(length, 0) + 1
            left -= length
    return used


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (length, first rank, first bin, bins, offset of the first slot) and the number of bins.

    Pieces of a length are ranked from 0; those from the first rank on fill one slot per bin, bin after bin,
    and begin again with the next slot.
    """
    left, taken, out, bins = dict(histogram), dict.fromkeys(histogram, 0), [], 0
    while left:
        big = max(left)
        rest = {k: n - (k == big) for k, n in left.items() if n > (k == big)}
        use = fullest(rest, capacity - big)
        use[big] = use.get(big, 0) + 1
        times, offset = min(left[k] // n for k, n in use.items()), 0
        for k in sorted(use, reverse=True):
            out.append((k, taken[k], bins, times, offset))
            taken[k] += times * use[k]
            offset += k * use[k]
            left[k] -= times * use[k]
            if not left[k]:
                del left[k]
        bins += times
    return out, bins


def _place_batches(batches, rows: np.ndarray):
    key = rows[:, 0] << 45 | rows[:, 1]
    for b in batches:
        length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
        r = rows[np.searchsorted(key, length << 45 | rank, "right") - 1] if len(rows) else np.zeros((len(rank), 5), np.int64)
        k = rank - r[:, 1]
        put = {"sequence_id": pa.array(r[:, 2] + k % r[:, 3], pa.int64()), "offset": pa.array(r[:, 4] + k // r[:, 3] * length, pa.int64())}
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        yield pa.RecordBatch.from_arrays([put.get(n) if n in put else b.column(n) for n in names], names=names)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece of ``docs`` (doc_id, text).

    A null or empty text is the end id alone.  Repeated rows and null ids are packed like any other.  Pieces
    are ranked within their length by task and place, with one count per task and length; no piece is shuffled
    to a group of its length.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"
    pieces = cut_lineage(arrow_map(docs.select("doc_id", "text"), _piece_batches, schema, path=path, capacity=capacity, end_id=end_id))
    per = cut_lineage(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("c")))
    histogram = {r["length"]: r["c"] for r in per.groupBy("length").agg(F.sum("c").alias("c")).collect()}  # at most ``capacity`` rows
    rows, _ = plan(histogram, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    base = per.withColumn("base", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return arrow_map(ranked, _place_batches, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", rows=table)
