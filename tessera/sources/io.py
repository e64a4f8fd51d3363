"""Sources, sinks and contracts."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import attach_row

REPLACEMENT = "�"


def clean_name(name: str, snake: bool = False) -> str:
    """Drop a BOM and surrounding blanks/tabs; optionally snake_case."""
    n = name.replace("﻿", "").strip(" \t\r\n")
    if snake:
        n = re.sub(r"[^0-9a-zA-Z]+", "_", n).strip("_").lower()
    return n


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a missing value: NULL in every float and double column, whatever wrote it."""
    floats = (T.FloatType, T.DoubleType)
    if not any(isinstance(f.dataType, floats) for f in df.schema.fields):
        return df
    return df.select(*[F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name) if isinstance(f.dataType, floats)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",",
             encoding: str = "utf-8", fallback: str = "ISO-8859-1", header: bool = True,
             clean_names: bool = True, snake: bool = False) -> DataFrame:
    """CSV read in which every file that is not valid ``encoding`` is read in ``fallback`` instead.

    Spark never fails on bad UTF-8; it substitutes U+FFFD.  One job names the files that hold that character, in
    their rows or headers; each file is then read in its own encoding.  A file that
    holds U+FFFD itself counts as not valid.
    """
    def _read(enc, paths):
        r = spark.read.option("header", header).option("sep", sep).option("encoding", enc)
        df = (r.schema(schema) if schema is not None else r.option("inferSchema", False)).csv(paths)
        return df.toDF(*[clean_name(c, snake) for c in df.columns]) if clean_names else df

    df = _read(encoding, path)
    if fallback:
        # whole lines, decoded as the columns will be
        lines = spark.read.option("encoding", encoding).option("sep", "\x01").option("quote", "").schema("line string").csv(path)
        bad = {r[0] for r in lines.where(F.col("line").contains(REPLACEMENT)).select("_metadata.file_path").distinct().collect()}  # names of files
        if bad:
            files = {_local_name(f): unquote(f) for f in df.inputFiles()}
            bad = {_local_name(f) for f in bad}
            good = sorted(f for n, f in files.items() if n not in bad)
            df = _read(fallback, sorted(f for n, f in files.items() if n in bad))
            if good:
                valid = _read(encoding, good)
                df = valid.unionByName(df, allowMissingColumns=True)
    return nan_to_null(df)


def _local_name(uri: str) -> str:
    """A file's URI without differences of writing: ``file:/a`` and ``file:///a`` are one file."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(uri))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet read with NaN as NULL."""
    return nan_to_null(spark.read.parquet(path))


def expect(df: DataFrame, required: Sequence[str] = (), no_nulls: Sequence[str] = (),
           unique: Sequence[str] = (), n_rows: int | None = None) -> DataFrame:
    """(check, passed, observed) from one aggregate (plus one per uniqueness key)."""
    spark = df.sparkSession
    rows = [(f"required:{c}", c in df.columns, 1 if c in df.columns else 0) for c in required]
    present = [c for c in no_nulls if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("__n")] + [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"n_{c}")
                                               for c in present]
    agg = df.agg(*aggs)
    checks = [F.struct(F.lit(f"no_nulls:{c}").alias("check"), (F.col(f"n_{c}") == 0).alias("passed"),
                       F.col(f"n_{c}").cast("long").alias("observed")) for c in present]
    if n_rows is not None:
        checks.append(F.struct(F.lit("n_rows").alias("check"), (F.col("__n") == n_rows).alias("passed"),
                               F.col("__n").cast("long").alias("observed")))
    out = agg.select(F.inline(F.array(*checks))) if checks else None
    for c in unique:
        dup = df.groupBy(c).agg(F.count(F.lit(1)).alias("__c")).agg(
            F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).cast("long").alias("observed"))
        u = dup.select(F.lit(f"unique:{c}").alias("check"), (F.col("observed") == 0).alias("passed"), "observed")
        out = u if out is None else out.unionByName(u)
    if rows:
        r = spark.createDataFrame(rows, "check string, passed boolean, observed long")
        out = r if out is None else r.unionByName(out)
    return out


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """S8."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "utf-8", mode: str = "overwrite") -> None:
    """S9."""
    df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding).csv(path)


def write_json_summary(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Each row as one JSON object per line (``to_json(struct(*))``)."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def hand_off(df: DataFrame, path: str, key: str) -> DataFrame:
    """Write a keyed table, read it back and verify key alignment.

    Returns (n_written, n_read, n_missing, n_extra) -- missing/extra keys by
    anti-joins; both must be 0.
    """
    write_parquet(df, path)
    back = df.sparkSession.read.parquet(path)
    n_w = df.agg(F.count(F.lit(1)).alias("n_written"))
    n_r = back.agg(F.count(F.lit(1)).alias("n_read"))
    miss = df.select(key).join(back.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("n_missing"))
    extra = back.select(key).join(df.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("n_extra"))
    return attach_row(attach_row(attach_row(n_w, n_r), miss), extra)  # four one-row tables


def save_model(model, path: str) -> None:
    """S12."""
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    import uuid
    from ..session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")
