"""Numpy over Arrow batches for the few operators that work on whole matrices of points.

Spark partitions and shuffles the rows; a task turns its own into arrays and puts out partial sums, or
the pairs of one bounded block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an ``array<double>`` column; they must be of one length and hold no null."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten()
    dims = len(flat) // n if n else 0
    if column.null_count or flat.null_count or len(flat) != n * dims or (n and (column.value_lengths().to_numpy() != dims).any()):
        raise ValueError("points need arrays of one length without nulls")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, dims)


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all rows of ``a`` to all rows of ``b`` by the product formula (bounds, not results)."""
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)[None, :], 0)
