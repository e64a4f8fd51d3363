"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _named_settings() -> dict[str, str]:
    """Settings named by a submit command or a configuration folder; none for a plain Python start."""
    started = "PYSPARK_GATEWAY_PORT" in os.environ or "SPARK_CONF_DIR" in os.environ
    if not started and os.environ.get("PYSPARK_SUBMIT_ARGS", "pyspark-shell").split() == ["pyspark-shell"]:
        return {}
    SparkContext._ensure_initialized()  # the gateway holds what the submit command named
    return dict(SparkConf().getAll())


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera", driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    Explicit arguments come first, then what the submit command, the configuration folder or a
    running session name, then ``TESSERA_MASTER`` and ``TESSERA_SHUFFLE_PARTITIONS``, and only
    then the local defaults.  On a cluster, pass nothing.
    """
    running = SparkSession.getActiveSession()
    named = dict(running.sparkContext.getConf().getAll()) if running else _named_settings()
    wanted = {
        "spark.master": master, "spark.sql.shuffle.partitions": shuffle_partitions,
        "spark.default.parallelism": shuffle_partitions, "spark.driver.memory": driver_memory,
    }
    local = named.get("spark.master", "local").startswith("local")
    parts = os.environ.get("TESSERA_SHUFFLE_PARTITIONS", "8") if local and not running else None
    fallback = {
        "spark.master": os.environ.get("TESSERA_MASTER", "local[8]"),
        "spark.sql.shuffle.partitions": parts, "spark.default.parallelism": None if "spark.master" in named else parts,
        "spark.driver.memory": "16g" if not named else None,
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf = {k: str(v) for k, v in wanted.items() if v is not None}
    conf |= {k: v for k, v in fallback.items() if v is not None and k not in named and k not in conf}
    spark = SparkSession.builder.appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not running and (local or "spark.checkpoint.dir" in named):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    context).  Only a local master, where driver and executor are one process,
    may do without: it gets a private folder.  Any other master without the
    setting is refused, since executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder all machines share (master: {sc.master})")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_scopes: list[list[str]] = []


@contextmanager
def cuts(spark: SparkSession):
    """Scope whose lineage cuts are deleted when it ends; use the results inside it."""
    _scopes.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _scopes.pop():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def input_stamp(spark: SparkSession, paths: list[str]) -> tuple:
    """(path, length, modification time) of the files under ``paths``; changes when the data change."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return tuple(sorted(map(tuple, files.select("path", "length", F.col("modificationTime").cast("string")).collect())))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    A written table survives executor loss and cuts lineage like a reliable
    checkpoint, but the re-read carries real file-size statistics.
    (``DataFrame.checkpoint`` keeps the original plan's size estimate; in an
    iterative join loop that estimate multiplies every round until adaptive
    re-planning spends seconds on BigInteger arithmetic.)
    """
    import uuid
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"tessera-cut-{uuid.uuid4().hex}")
    if _scopes:
        _scopes[-1].append(path)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


SPLIT_BUCKETS = 1 << 16


def split_buckets(spark: SparkSession) -> int:
    """Hash buckets per group for split/fold row numbers (``spark.tessera.splitBuckets``).

    Rows are numbered by a window over (group, bucket), so a hot group is cut
    into this many window partitions; the bucket offset table has at most
    #groups x buckets rows.  The default keeps each window near 15M rows even
    when one class holds a trillion rows.
    """
    return int(spark.conf.get("spark.tessera.splitBuckets", str(SPLIT_BUCKETS)))
