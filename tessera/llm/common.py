"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import importlib
import sys
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable, schema: str, **args) -> DataFrame:
    """``mapInArrow`` of ``fn(batches, **args)``, a module-level function found by name on the worker.

    Only the name and ``args`` travel with the tasks.  The package must be importable there (installed,
    ``--py-files``, or, with one machine, from this checkout).
    """
    module, name, root = fn.__module__, fn.__name__, ROOT

    def run(batches):
        if root not in sys.path:
            sys.path.append(root)
        yield from getattr(importlib.import_module(module), name)(batches, **args)
        importlib.import_module("tessera.llm.common").give_back()

    return df.mapInArrow(run, schema)


def arrow_column(fn: Callable, schema: str, *columns, **args) -> Column:
    """Arrow UDF ``fn(*arrays, **args)`` over ``columns``: a row's other columns stay with Spark.

    ``fn`` is found by name on the worker, as in ``arrow_map``.  The column counts as nondeterministic, so Spark
    neither copies it into filters nor works it out twice.
    """
    module, name, root = fn.__module__, fn.__name__, ROOT

    def run(*arrays: pa.Array) -> pa.Array:
        if root not in sys.path:
            sys.path.append(root)
        out = getattr(importlib.import_module(module), name)(*arrays, **args)
        importlib.import_module("tessera.llm.common").give_back()
        return out

    return F.arrow_udf(run, schema, F.ArrowUDFType.SCALAR).asNondeterministic()(*columns)


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks, several to an executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; rows with remainder 0 are held out.  A null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def sampled(df: DataFrame, key: str, n: int, rows: int) -> DataFrame:
    """At most ``n`` of about ``rows`` rows, by hash of ``key``: a training sample of bounded size.

    A hash threshold keeps some 2n rows on the executors, so what reaches the driver does not grow with the
    number of partitions; the order of hash and content picks n of them.
    """
    span = 1 << 32
    place = F.pmod(F.xxhash64(key), F.lit(span))
    return df.where(place < min(span, span * 2 * n // max(rows, 1) + 1)).orderBy(place, *[f"`{c}`" for c in df.columns]).limit(n)


def plain_path(uri: str) -> str:
    """The path of a shared folder as the workers' file system has it.

    Files that workers map into memory need a folder that every machine mounts; a folder only Spark can
    read is refused here rather than written to a local disk.
    """
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"{uri}: memory-mapped files need spark.checkpoint.dir on a file system that every machine mounts")
    return uri


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows with equal integer keys, each as one batch, of a partition sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None

    def whole():
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
        edge = np.concatenate([[0], np.flatnonzero((cols[:, 1:] != cols[:, :-1]).any(axis=0)) + 1, [b.num_rows]]).tolist()
        for a, z in zip(edge[:-1], edge[1:], strict=True):
            now = tuple(cols[:, a])
            if held and now != last:
                yield whole()
                held = []
            held.append(b.slice(a, z - a))
            last = now
    if held:
        yield whole()
