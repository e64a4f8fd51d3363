"""Registry of named queries: Spark callable + equivalent DuckDB SQL.

Each plan module registers its queries with :func:`query`.  A query reads the
test tables (or data Spark derives from them) under ``sf_dir`` and returns a
DataFrame; the SQL twin computes the same table over DuckDB views named after
the tables.  ``sql=None`` marks an operator with no SQL form (iterative or
model-based); those get a rows-only check plus their own pytest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load_all() -> None:
    from . import (q_profile, q_clean, q_features, q_split, q_metrics, q_report,  # noqa: F401
                   q_cluster, q_labels, q_models, q_stream, q_io)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
