"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Training words stream through the automaton, which tracks the longest match that ends at
each word; where it reaches the window length (or a whole shorter item) the words matched
are hit.  The automaton says which items hold a matched window.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import textvec as tv
from .common import arrow_column, arrow_map

WINDOW = 10
SHARD_WORDS = 1 << 19  # item words in one automaton; it has at most twice as many states
SIEVE = 3


class SuffixAutomaton:
    """All substrings of a set of word sequences; a state stands for substrings that end at the same places."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _exact(self, p: int, word: int) -> int:
        """The state of p's longest string plus word, split off from the target if that one is longer."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            if word in self.next[last]:
                last = self._exact(last, word)
                continue
            new, p = self._state(self.length[last] + 1, {}, 0), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._exact(p, word)
            last = new

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """Longest suffix of (what was matched + word) that some item holds."""
        while word not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            matched = self.length[state]
        return self.next[state][word], matched + 1


def build(items: list[tuple[str, list[int]]], window: int) -> dict:
    """Automaton of (id, word hashes), with the ids of every window's and every shorter item's state."""
    auto = SuffixAutomaton()
    for _, seq in items:
        auto.add(seq)
    full: dict[int, set[str]] = {}   # state of a window -> items that hold it
    short: dict[int, set[str]] = {}  # state of a whole short item -> items that are it
    words: dict[int, int] = {}       # and its words
    least = min([window, *(len(s) for _, s in items if s)])
    g = min(SIEVE, least)
    sieve: set[int] = set()
    for name, seq in items:
        if not seq:
            continue
        sieve.update(tv.ngram_hash(np.array(seq, tv.U64), g).tolist())
        state = 0
        for k, word in enumerate(seq, 1):
            state = auto.next[state][word]
            if k >= window:
                at = state
                while auto.length[auto.link[at]] >= window:
                    at = auto.link[at]
                full.setdefault(at, set()).add(name)
        if len(seq) < window:
            short.setdefault(state, set()).add(name)
            words[state] = len(seq)
    # per state: the state of its suffix of ``window`` words, and of the longest of its suffixes that is a short item
    order = sorted(range(len(auto.link)), key=auto.length.__getitem__)
    reach, ends = [0] * len(order), [0] * len(order)
    for s in order[1:]:
        up = auto.link[s]
        if auto.length[s] >= window:
            reach[s] = reach[up] if auto.length[up] >= window else s
        ends[s] = s if s in short else ends[up]
    return {"auto": auto, "full": full, "short": short, "words": words, "reach": reach, "ends": ends, "window": window, "least": least, "g": g,
            "sieve": np.array(sorted(sieve), tv.U64)}


def _build_batches(batches, window: int):
    items: dict[int, list] = {}
    for b in batches:
        data, off = tv.text_buffers(b.column("text"))
        seqs = np.split((w := tv.words(data, off)).hash, w.first[1:-1]) if b.num_rows else []
        for shard, name, seq in zip(b.column("shard").to_pylist(), b.column("item").to_pylist(), seqs, strict=True):
            items.setdefault(shard, []).append((name, seq.tolist()))
    for shard, rows in items.items():
        if any(seq for _, seq in rows):
            yield pa.RecordBatch.from_pydict({"automaton": pa.array([pickle.dumps(build(rows, window))], pa.binary())})


def automata(items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard of items, with its automaton (built in the tasks, each of bounded size)."""
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0  # a word has a letter and a separator at least
    shards = int(total // shard_words) + 1
    parted = items.withColumn("shard", F.pmod(F.xxhash64("item", "text"), F.lit(shards)).cast("int"))
    return cut_lineage(arrow_map(parted.repartition(shards, "shard"), _build_batches, "automaton binary", window=window))


def scan(model: dict, hashes: np.ndarray, hit: np.ndarray) -> tuple[set[str], int]:
    """Mark the hit words of one text; returns the items found and the longest match in words.

    Only stretches whose every short word group stands in some item are streamed: no match of a window or
    whole item can reach beyond one.
    """
    g, least, window, auto = model["g"], model["least"], model["window"], model["auto"]
    windows: set[int] = set()
    whole: set[int] = set()
    longest, words, ends = 0, model["words"], model["ends"]
    if len(hashes) < least:
        return set(), longest
    grams, sieve = tv.ngram_hash(hashes, g), model["sieve"]
    known = sieve[np.minimum(np.searchsorted(sieve, grams), len(sieve) - 1)] == grams
    start, end = tv.runs(known, np.array([0, len(known)]))
    for a, b in zip(start.tolist(), (end + g - 1).tolist(), strict=True):
        if b - a < least:
            continue
        state = matched = 0
        for i, word in enumerate(hashes[a:b].tolist(), a):
            state, matched = auto.step(state, matched, word)
            if matched >= window:
                hit[i - matched + 1: i + 1] = True
                windows.add(model["reach"][state])
                longest = max(longest, matched)
            at = ends[state]
            while at:  # at most one short item of each length
                n = words[at]
                if n <= matched:
                    hit[i - n + 1: i + 1] = True
                    whole.add(at)
                    longest = max(longest, n)
                at = ends[auto.link[at]]
    return set().union(*(model["full"][s] for s in windows), *(model["short"][s] for s in whole)), longest


def _load(blob) -> dict:
    return pickle.loads(blob.value)


def _scan_column(text: pa.Array, hits: pa.Array, items: pa.Array, longest: pa.Array, model) -> pa.Array:
    """What an automaton finds in the texts, added to what others found."""
    model = _load(model)
    parts, sieve = [], model["sieve"]
    for b in tv.chunks(iter([pa.RecordBatch.from_arrays([text, hits, items, longest], names=["text", "hits", "items", "longest"])]), "text"):
        data, off = tv.text_buffers(b.column("text"))
        w = tv.words(data, off)
        first, grams = w.first, tv.ngram_hash(w.hash, model["g"])
        known = np.zeros(len(w.hash), bool)
        known[: len(grams)] = sieve[np.minimum(np.searchsorted(sieve, grams), len(sieve) - 1)] == grams
        some = np.add.reduceat(np.append(known, False), first[:-1]) if len(first) > 1 else np.zeros(0)
        spans, names, far = b.column("hits").to_pylist(), b.column("items").to_pylist(), b.column("longest").to_pylist()
        for r in np.flatnonzero((some > 0) & (w.per_row > 0)).tolist():
            hit = np.zeros(w.per_row[r], bool)
            found, most = scan(model, w.hash[first[r]: first[r + 1]], hit)
            if found:
                for s in spans[r]:
                    hit[s["from"]: s["to"]] = True
                a, z = tv.runs(hit, np.array([0, len(hit)]))
                spans[r] = [{"from": x, "to": y} for x, y in zip(a.tolist(), z.tolist(), strict=True)]
                names[r] = sorted(found | set(names[r]))
                far[r] = max(far[r], most)
        parts.append(_state(w.per_row, spans, names, far))
    return pa.concat_arrays(parts) if parts else _state([], [], [], [])


def _count_column(text: pa.Array) -> pa.Array:
    parts = []
    for b in tv.chunks(iter([pa.RecordBatch.from_arrays([text], names=["text"])]), "text"):
        n = tv.words(*tv.text_buffers(b.column("text"))).per_row
        parts.append(_state(n, [[]] * len(n), [[]] * len(n), [0] * len(n)))
    return pa.concat_arrays(parts) if parts else _state([], [], [], [])


HITS = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
STATE = "n_words bigint, hits array<struct<from:bigint,to:bigint>>, items array<string>, longest bigint"


def _state(n_words, hits, items, longest) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(hits, HITS), pa.array(items, pa.list_(pa.string())), pa.array(longest, pa.int64())],
                                      names=["n_words", "hits", "items", "longest"])


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Rows of ``docs`` (any columns, with ``text``) in struct ``doc`` plus n_words, hits, items, longest.

    hits: [from, to) word spans covered by windows of ``window`` consecutive item words, or by whole items of
    fewer words; items: ids found, sorted as strings (a null id counts as ''); longest: longest match in words.
    Null or empty texts have no words and no hits; items without words match nothing; with no items nothing is
    hit.  Each automaton has a bounded size and is broadcast; with more than one, the documents pass one after
    the other.
    """
    spark = docs.sparkSession
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    models = automata(items, window, shard_words)
    n, k = models.count(), 0
    if not n:
        df = df.select("doc", arrow_column(_count_column, STATE, F.col("doc.text")).alias("s")).select("doc", "s.*")
    before = [F.expr("cast(array() as array<struct<from:bigint,to:bigint>>)"), F.expr("cast(array() as array<string>)"), F.lit(0).cast("long")]
    for row in models.toLocalIterator():  # one bounded automaton at a time
        found = arrow_column(_scan_column, STATE, F.col("doc.text"), *before, model=spark.sparkContext.broadcast(bytes(row["automaton"])))
        df, before = df.select("doc", found.alias("s")).select("doc", "s.*"), [F.col(c) for c in ("hits", "items", "longest")]
        k += 1
        df = cut_lineage(df) if k < n else df
    return df


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest per row of ``docs``."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x["to"] - x["from"])
    return hits(docs.select("doc_id", "text"), items, window).select(
        "doc.doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"), "longest")


def _cut_column(text: pa.Array, hits: pa.Array, max_words: int) -> pa.Array:
    """Texts without their longer hit spans; null where there is no such span."""
    parts = []
    for b in tv.chunks(iter([pa.RecordBatch.from_arrays([text, hits], names=["text", "hits"])]), "text"):
        data, off = tv.text_buffers(b.column("text"))
        w, texts = tv.words(data, off), [None] * b.num_rows
        first = w.first
        for r, spans in enumerate(b.column("hits").to_pylist()):
            gone = [s for s in spans or () if s["to"] - s["from"] > max_words]
            if gone:
                raw, at, left = data[off[r]: off[r + 1]].tobytes(), 0, []
                for s in gone:
                    a, z = int(w.start[first[r] + s["from"]] - off[r]), int(w.end[first[r] + s["to"] - 1] - off[r])
                    left.append(raw[at:a])
                    at = z
                texts[r] = b"".join([*left, raw[at:]]).decode()
        parts.append(pa.array(texts, pa.string()))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_words: int = 0, max_coverage: float = 0.5) -> DataFrame:
    """``docs`` without hit spans of over ``max_words`` words and without rows hit on over ``max_coverage`` of their words.

    Other columns stay as they are, but for n_chars where there is one, which follows the text.
    """
    covered = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + x["to"] - x["from"])
    found = hits(docs, items, window).where(covered <= max_coverage * F.greatest(F.lit(1), "n_words"))
    # texts without a hit do not go to Python again
    cut = arrow_column(_cut_column, "string", F.when(F.size("hits") > 0, F.col("doc.text")), F.when(F.size("hits") > 0, F.col("hits")), max_words=max_words)
    new = found.select("doc", cut.alias("cut")).select("doc", F.coalesce("cut", "doc.text").alias("text"))
    return new.select(*[F.col("text") if c == "text" else F.coalesce(F.length("text").cast(docs.schema[c].dataType), F.col(f"doc.`{c}`")).alias(c)
                        if c == "n_chars" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
