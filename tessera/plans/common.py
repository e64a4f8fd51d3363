"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column so the oracle's value hash is engine independent."""
    return df.select(*[
        F.round(F.col(f.name).cast("double"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)) else F.col(f.name)
        for f in df.schema.fields])


def R(expr: str, digits: int = DIGITS) -> str:
    """SQL twin of :func:`rounded` for one expression."""
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def union_sql(parts) -> str:
    return "\n  UNION ALL\n".join(parts)


def hash_unit_sql(key_sql: str, seed=42) -> str:
    """SQL twin of ``functions.columns.hash_unit``."""
    return (f"(CAST(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{seed}'), 1, 13)) AS BIGINT)"
            f" / CAST(4503599627370496 AS DOUBLE))")
