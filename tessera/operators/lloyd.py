"""Lloyd's k-means for many runs at once: every round reads the points one time for all (k, restart) runs.

A run's centres travel with the tasks (k x d numbers); a task adds up, per run and centre, the number, the
sum and the squared distance of the points nearest to it, and one aggregate adds the tasks' sums.  Runs
that have settled leave the following rounds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .blocks import matrix, square_distances

SAMPLE = 4096   # points that first centres are drawn from, at most
ROWS = 4096     # points whose distances a task holds at once


def first_centres(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ on a sample: each next centre is drawn by its squared distance to the nearest one so far."""
    rng = np.random.default_rng(seed)
    chosen = [sample[rng.integers(len(sample))]]
    left = ((sample - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = left.sum()
        chosen.append(sample[rng.choice(len(sample), p=left / total) if total > 0 else rng.integers(len(sample))])
        left = np.minimum(left, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of each row's nearest centre, ties to the lowest.  The product formula prunes; near ties are taken exactly."""
    d = square_distances(x, centres)
    best = d.argmin(axis=1)
    scale = (x * x).sum(axis=1) + (centres * centres).sum(axis=1).max(initial=0)
    close = d <= (d[np.arange(len(x)), best] + 1e-12 * scale)[:, None]
    for r in np.flatnonzero(close.sum(axis=1) > 1):
        some = np.flatnonzero(close[r])
        best[r] = some[((x[r] - centres[some]) ** 2).sum(axis=1).argmin()]
    return best


def _sums(centres: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = centres[0].shape[1]
        total = [np.zeros((len(c), dims + 2)) for c in centres]
        for b in batches:
            x = matrix(b.column("x"))
            for s in range(0, len(x), ROWS):
                part = x[s: s + ROWS]
                for c, t in zip(centres, total):
                    who = nearest(part, c)
                    t[:, 0] += np.bincount(who, minlength=len(c))
                    t[:, 1] += np.bincount(who, weights=((part - c[who]) ** 2).sum(axis=1), minlength=len(c))
                    for j in range(dims):
                        t[:, 2 + j] += np.bincount(who, weights=part[:, j], minlength=len(c))
        rows = [(r, i, float(v[0]), float(v[1]), v[2:].tolist()) for r, t in enumerate(total) for i, v in enumerate(t)]
        cols = list(zip(*rows))
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["run", "cluster", "n", "cost", "sums"])
    return run


def _pass(pts: DataFrame, centres: list[np.ndarray]) -> list[np.ndarray]:
    """(n, cost, sums...) per run and centre: one scan, at most (number of centres) rows to the driver."""
    dims = centres[0].shape[1]
    part = pts.select("x").mapInArrow(_sums(centres), "run int, cluster int, n double, cost double, sums array<double>")
    rows = part.groupBy("run", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(dims)]).collect()
    out = [np.zeros((len(c), dims + 2)) for c in centres]
    for r in rows:
        out[r["run"]][r["cluster"]] = [r["n"], r["cost"], *[r[f"s{j}"] for j in range(dims)]]
    return out


def lloyd(points: DataFrame, starts: Sequence[np.ndarray], x: str = "x", max_iter: int = 300, tol: float = 1e-4,
          rounds: int | None = None) -> list[tuple[np.ndarray, float, int]]:
    """(centres, inertia, rounds) of each run that begins with ``starts``.

    A run ends when its centres move by no more than ``tol`` times the mean variance of the columns (sum of
    squares), or after ``max_iter`` rounds; ``rounds`` runs just so many instead.  An empty cluster keeps its
    centre.  The inertia is that of the final centres.
    """
    pts = cut_lineage(points.select(F.col(x).alias("x")))
    centres = [np.array(c, np.float64) for c in starts]
    dims = centres[0].shape[1]
    spread = pts.agg(*[F.var_pop(F.col("x")[j]) for j in range(dims)]).first()
    least = tol * float(np.mean([v or 0.0 for v in spread]))
    open_runs, used = list(range(len(centres))), [0] * len(centres)
    for step in range(rounds if rounds is not None else max_iter):
        found, still = _pass(pts, [centres[r] for r in open_runs]), []
        for r, t in zip(open_runs, found):
            full = t[:, 0] > 0
            new = centres[r].copy()
            new[full] = t[full, 2:] / t[full, :1]
            moved = float(((new - centres[r]) ** 2).sum())
            centres[r], used[r] = new, step + 1
            if rounds is not None or moved > least:
                still.append(r)
        open_runs = still
        if not open_runs:
            break
    return [(c, float(t[:, 1].sum()), n) for c, t, n in zip(centres, _pass(pts, centres), used)]


def sample_points(points: DataFrame, key: str, x: str = "x", n: int = SAMPLE) -> np.ndarray:
    """At most ``n`` points by hash of the key: what first centres are drawn from."""
    rows = points.select(x, F.xxhash64(key).alias("__h"), key).orderBy("__h", key).limit(n).collect()
    return np.array([r[0] for r in rows], np.float64)
