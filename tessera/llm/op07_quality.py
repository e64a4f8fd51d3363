"""Document quality by a factorisation machine over hashed words, text structure and length.

The score of a feature vector x is  w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j.  The pair
sum is taken in time linear in the features as half of (sum v_i x_i)^2 - sum (v_i x_i)^2.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import arrow_map, fold, sampled

U64 = tv.U64
SAMPLE_ROWS = 4_000  # labelled rows that training sees, by id hash
BUCKETS = 1 << 14    # hashed words
FACTORS = 8
STATS = 24           # width of the structure block
THRESHOLD = 0.3

LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
MARK = np.zeros(256, bool)
MARK[33:48] = MARK[58:65] = MARK[91:97] = MARK[123:127] = True


def _per_row(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flag)])[off])


def structure(data: np.ndarray, off: np.ndarray, w: tv.Words) -> np.ndarray:
    """rows x STATS numbers of about unit size: lengths, byte-class shares, repetition of words and lines."""
    rows = len(off) - 1
    size, n = np.maximum(np.diff(off), 1), np.maximum(w.per_row, 1)
    share = [_per_row(c[data], off) / size for c in (LETTER, UPPER, DIGIT, NEWLINE, MARK)]
    marks = [_per_row(data == ord(c), off) / n for c in ".,!?|$#&%*"]
    lengths = np.bincount(w.row, weights=w.end - w.start, minlength=rows) / n
    pair = np.unique(np.stack([w.row.astype(U64), w.hash]), axis=1)[0].astype(np.int64) if len(w.row) else np.zeros(0, np.int64)
    distinct = np.bincount(pair, minlength=rows) / n
    # lines: share that repeats an earlier line, and the mean length
    start, end = tv.runs(~NEWLINE[data], off)
    line_row = np.searchsorted(off, start, "right") - 1
    lines = np.maximum(np.bincount(line_row, minlength=rows), 1)
    keys = tv.span_hash(data, start, end) if len(start) else np.zeros(0, U64)
    once = np.unique(np.stack([line_row.astype(U64), keys]), axis=1)[0].astype(np.int64) if len(keys) else np.zeros(0, np.int64)
    repeat = 1 - np.bincount(once, minlength=rows) / lines
    wide = np.log1p(np.diff(off) / lines)
    cols = [np.log1p(np.diff(off)) / 10, np.log1p(w.per_row) / 8, lengths / 10, distinct, repeat, wide / 6, np.log1p(lines) / 5,
            *share, *marks, (w.per_row == 0).astype(float)]
    out = np.zeros((rows, STATS))
    out[:, : len(cols)] = np.stack(cols, axis=1)
    return np.minimum(out, 5.0)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value): distinct hashed words with damped counts of unit length per row, then structure."""
    rows = len(off) - 1
    w = tv.words(data, off, tv.NONSPACE)
    key, n = tv.counted(w.row.astype(np.int64) * BUCKETS + (w.hash % U64(BUCKETS)).astype(np.int64))
    row, feat, value = key // BUCKETS, key % BUCKETS, np.log1p(n)
    norm = np.sqrt(np.bincount(row, weights=value**2, minlength=rows))
    value = value / np.maximum(norm, 1e-12)[row]
    stats = structure(data, off, w)
    return (np.concatenate([row, np.repeat(np.arange(rows), STATS)]), np.concatenate([feat, np.tile(BUCKETS + np.arange(STATS), rows)]),
            np.concatenate([value, stats.ravel()]))


def raw_score(model: dict, row: np.ndarray, feat: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(score, per-row factor sums) by the sum-of-squares identity."""
    out = model["w0"] + np.bincount(row, weights=model["w"][feat] * value, minlength=rows)
    sums = np.zeros((rows, FACTORS))
    for f in range(FACTORS):
        x = model["v"][feat, f] * value
        sums[:, f] = np.bincount(row, weights=x, minlength=rows)
        out += 0.5 * (sums[:, f] ** 2 - np.bincount(row, weights=x * x, minlength=rows))
    return out, sums


def scaled(model: dict, row, feat, value):
    """Structure features about their training mean, in training deviations."""
    stat = feat >= BUCKETS
    k = feat[stat] - BUCKETS
    value = value.copy()
    value[stat] = np.clip((value[stat] - model["mean"][k]) / model["dev"][k], -4, 4) / 4
    return row, feat, value


def train(rows: list[tuple[str, int]], epochs: int = 60, rate: float = 0.1, decay: float = 2e-4, batch: int = 256, seed: int = 3) -> dict:
    """Adagrad on the logistic loss of (text, label) rows, then a two-parameter calibration on a quarter held back."""
    rng = np.random.default_rng(seed)
    model = {"w0": 0.0, "w": np.zeros(BUCKETS + STATS), "v": rng.normal(0, 0.05, (BUCKETS + STATS, FACTORS)), "mean": np.zeros(STATS), "dev": np.ones(STATS), "scale": 1.0, "shift": 0.0}
    y = np.array([v for _, v in rows], float)
    if not len(rows) or y.min() == y.max():
        p = min(max((y.mean() if len(y) else 0.5), 0.01), 0.99)
        return model | {"v": np.zeros_like(model["v"]), "w0": float(np.log(p / (1 - p)))}
    parts, base = [], 0
    for at in range(0, len(rows), 64):
        data, off = tv.text_buffers(pa.array([t for t, _ in rows[at: at + 64]], pa.large_string()))
        r, f, x = features(data, off)
        parts.append((r + base, f, x))
        base += len(off) - 1
    row, feat, value = (np.concatenate([p[k] for p in parts]) for k in range(3))
    stats = np.zeros((len(rows), STATS))
    s = feat >= BUCKETS
    stats[row[s], feat[s] - BUCKETS] = value[s]
    model["mean"], model["dev"] = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    row, feat, value = scaled(model, row, feat, value)
    order = np.argsort(row, kind="stable")
    row, feat, value = row[order], feat[order], value[order]
    first = np.searchsorted(row, np.arange(len(rows) + 1))
    kept = np.arange(len(rows)) % 4 == 3 if len(rows) >= 40 else np.zeros(len(rows), bool)
    learn = np.flatnonzero(~kept)
    sums = {"w0": 1e-6, "w": np.full(len(model["w"]), 1e-6), "v": np.full(model["v"].shape, 1e-6)}
    for _ in range(epochs):
        rng.shuffle(learn)
        for at in range(0, len(learn), batch):
            pick = learn[at: at + batch]
            n = first[pick + 1] - first[pick]
            where = np.repeat(first[pick] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            r, f, x = np.repeat(np.arange(len(pick)), n), feat[where], value[where]
            z, q = raw_score(model, r, f, x, len(pick))
            g = (1 / (1 + np.exp(-z)) - y[pick]) / len(pick)
            gx = g[r] * x
            used, back = np.unique(f, return_inverse=True)
            gw = np.bincount(back, weights=gx) + decay * model["w"][used]
            sums["w"][used] += gw * gw
            model["w"][used] -= rate * gw / np.sqrt(sums["w"][used])
            for k in range(FACTORS):
                vk = model["v"][f, k]
                gv = np.bincount(back, weights=gx * (q[r, k] - vk * x)) + decay * model["v"][used, k]
                sums["v"][used, k] += gv * gv
                model["v"][used, k] -= rate * gv / np.sqrt(sums["v"][used, k])
            sums["w0"] += g.sum() ** 2
            model["w0"] -= rate * g.sum() / np.sqrt(sums["w0"])
    if kept.any() and 0 < y[kept].mean() < 1:
        z, _ = raw_score(model, row, feat, value, len(rows))
        a, b = 1.0, 0.0
        for _ in range(200):  # logistic fit of label on score; the slope is held to (0, 4]
            p = 1 / (1 + np.exp(-(a * z[kept] + b)))
            d = p - y[kept]
            a -= 0.2 * ((d * z[kept]).mean() + 0.01 * (a - 1))
            b -= 0.2 * d.mean()
            a = min(max(a, 0.05), 4.0)
        model["scale"], model["shift"] = a, b
    return model


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Model from at most ``sample_rows`` labelled rows outside the held-out fold, taken by id hash."""
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("y"))
    marked = marked.where(fold("doc_id", 5) != 0)
    marked = sampled(marked, "doc_id", sample_rows, marked.count())
    rows = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")  # at most ``sample_rows`` short rows
    return train([(r["text"] or "", r["y"]) for r in sampled(rows, "doc_id", sample_rows, sample_rows).collect()])


def _score_batches(batches, model):
    model = model.value
    for b in tv.chunks(batches, "text"):
        row, feat, value = scaled(model, *features(*tv.text_buffers(b.column("text"))))
        z, _ = raw_score(model, row, feat, value, b.num_rows)
        p = 1 / (1 + np.exp(-np.clip(model["scale"] * z + model["shift"], -50, 50)))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                                         names=["doc_id", "held_out", "score", "predicted"])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs`` (doc_id, text).

    Null texts count as empty and get a score like any other.  Without labelled rows, or with one label only,
    the score is the same for all.  A document labelled twice takes its larger label.
    """
    rows = docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return arrow_map(rows, _score_batches, "doc_id long, held_out boolean, score double, predicted int", model=model)
