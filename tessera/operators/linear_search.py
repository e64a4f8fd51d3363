"""Ridge and lasso searches from sufficient statistics.

One scan adds up, per fold, the number of rows and the products of all pairs of features and target.
Whatever penalty is tried, a fold's fit and its error on the rows held out follow from those sums, so a search
over any number of penalties and folds reads the data once.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_SWEEPS = 10_000


def log_uniform(low: float, high: float, n: int, seed: int) -> list[float]:
    """n seeded draws whose logarithm is uniform."""
    rng = random.Random(seed)
    return [math.exp(rng.uniform(math.log(low), math.log(high))) for _ in range(n)]


def _products(width: int):
    """Sums of [1, features, target] x [1, features, target] per fold of a task's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            fold = b.column("fold").to_numpy(zero_copy_only=False)
            z = np.stack([np.ones(b.num_rows), *[b.column(f"c{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(width)]], axis=1)
            if not np.isfinite(z).all():
                raise ValueError("features and target need finite values; impute or drop rows first")
            for f in np.unique(fold).tolist():
                part = z[fold == f]
                total[f] = total.get(f, 0) + part.T @ part
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.ravel().tolist() for t in total.values()], pa.list_(pa.float64()))], names=["fold", "g"])
    return run


def fold_products(df: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, np.ndarray]:
    """fold -> (p + 2) x (p + 2) sums of products of 1, the features and the target; rows without a fold are left out."""
    cols = [*features, label]
    rows = df.where(F.col(fold).isNotNull()).select(F.col(fold).cast("int").alias("fold"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    part = rows.mapInArrow(_products(len(cols)), "fold int, g array<double>")
    size = (len(cols) + 1) ** 2
    summed = part.groupBy("fold").agg(F.array(*[F.sum(F.col("g")[i]) for i in range(size)]).alias("g")) if size <= 400 else \
        part.select("fold", F.posexplode("g").alias("i", "v")).groupBy("fold", "i").agg(F.sum("v").alias("v")).groupBy("fold").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("g"))
    return {r["fold"]: np.array(r["g"]).reshape(len(cols) + 1, -1) for r in summed.collect()}  # a matrix per fold


def _scaled(g: np.ndarray):
    """(n, means, deviations, centred and scaled x'x / n, x'y / n) of sums of products; constant columns scale to 0."""
    n = g[0, 0]
    mean = g[0, 1:] / n
    cov = g[1:, 1:] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
    by = np.where(sd > 1e-12 * np.maximum(np.abs(mean[:-1]), 1e-300), sd, np.inf)
    return n, mean, by, cov[:-1, :-1] / np.outer(by, by), cov[:-1, -1] / by


def ridge_fit(g: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) in the features' own units; the penalty alpha |b|^2 counts scaled coefficients."""
    n, mean, by, xx, xy = _scaled(g)
    b = np.linalg.solve(xx + alpha / n * np.eye(len(xy)), xy) / by
    return b, float(mean[-1] - b @ mean[:-1])


def lasso_fit(g: np.ndarray, alpha: float, tol: float = 1e-12) -> tuple[np.ndarray, float]:
    """(coefficients, intercept): coordinate descent on |y - xb|^2 / 2n + alpha |b|_1 over scaled features."""
    _, mean, by, xx, xy = _scaled(g)
    b = np.zeros(len(xy))
    for _ in range(MAX_SWEEPS):
        moved = 0.0
        for j in range(len(b)):
            if xx[j, j] <= 0:
                continue
            left = xy[j] - xx[j] @ b + xx[j, j] * b[j]
            new = math.copysign(max(abs(left) - alpha, 0.0), left) / xx[j, j]
            moved, b[j] = max(moved, abs(new - b[j])), new
        if moved <= tol * max(1.0, float(np.abs(b).max())):
            break
    b = b / by
    return b, float(mean[-1] - b @ mean[:-1])


def r_squared(g: np.ndarray, b: np.ndarray, intercept: float) -> float:
    """R^2 on the rows that the sums of products come from."""
    c = np.concatenate([[-intercept], -b, [1.0]])  # target - prediction, as weights of 1, features, target
    total = g[-1, -1] - g[0, -1] ** 2 / g[0, 0]
    return float(1 - c @ g @ c / total) if total > 0 else float("nan")


FITS = {"ridge": ridge_fit, "lasso": lasso_fit}


def linear_search(df: DataFrame, features: Sequence[str], label: str, fold: str, kind: str, alphas: Sequence[float]) -> tuple[DataFrame, dict]:
    """((alpha, mean_r2, std_r2, rnk) by cross-validation, the best penalty's fit on all rows).

    Features are scaled by the training folds' own means and deviations.  std is that of the folds (ddof 0); equal
    means rank by the smaller alpha.  The fit: alpha, r2 (on all rows), intercept, coefficients (by feature).
    """
    sums = fold_products(df, features, label, fold)
    if len(sums) < 2:
        raise ValueError("a search needs rows in at least two folds")
    total, fit, rows = sum(sums.values()), FITS[kind], []
    for alpha in alphas:
        scores = [r_squared(g, *fit(total - g, alpha)) for g in sums.values()]
        rows.append((float(alpha), float(np.mean(scores)), float(np.std(scores))))
    ranked = sorted(rows, key=lambda r: (-r[1], r[0]))
    table = df.sparkSession.createDataFrame([(*r, k) for k, r in enumerate(ranked, 1)], "alpha double, mean_r2 double, std_r2 double, rnk int")
    b, intercept = fit(total, ranked[0][0])
    return table, {"alpha": ranked[0][0], "r2": r_squared(total, b, intercept), "intercept": intercept, "coefficients": dict(zip(features, map(float, b)))}


def linear_prediction(model: dict) -> Column:
    """The fitted value as a column expression."""
    out = F.lit(model["intercept"])
    for c, b in model["coefficients"].items():
        out = out + F.col(c).cast("double") * F.lit(b)
    return out
