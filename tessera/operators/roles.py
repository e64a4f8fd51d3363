"""Column roles (S4) and feature/target separation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .profile import NUMERIC


@dataclass
class Roles:
    id: list[str] = field(default_factory=list)
    date: list[str] = field(default_factory=list)
    target: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)

    def as_rows(self) -> list[tuple[str, str]]:
        return [(role, c) for role in ("id", "date", "target", "numeric", "categorical") for c in getattr(self, role)]


def infer_roles(df: DataFrame, id: Sequence[str] = (), date: Sequence[str] = (), target: Sequence[str] = ()) -> Roles:
    """Numeric by type, categorical = remaining text; id/date/target as given.

    Timestamps/dates not listed are reported as dates.  Schema inspection only:
    no job runs.
    """
    fixed = set(id) | set(date) | set(target)
    r = Roles(list(id), list(date), list(target))
    for f in df.schema.fields:
        if f.name in fixed:
            continue
        if isinstance(f.dataType, NUMERIC):
            r.numeric.append(f.name)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            r.date.append(f.name)
        else:
            r.categorical.append(f.name)
    return r


def role_table(df: DataFrame, roles: Roles) -> DataFrame:
    """(role, column, n_non_null) -- the role catalogue with one counting pass."""
    rows = roles.as_rows()
    counts = df.agg(*[F.count(F.col(c)).alias(c) for _, c in rows])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(r).alias("role"), F.lit(c).alias("column"), F.col(c).alias("n_non_null")) for r, c in rows])))


def split_features_target(df: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(X keyed by ``key`` without the target, y = (key, target)) -- rejoin on the key."""
    return df.drop(target), df.select(key, target)
