"""Nothing is lost silently, the submit configuration wins, cuts go away, hot values stay in one row."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from tessera import session
from tessera.operators import profile
from tessera.operators.labels import transition_long
from tessera.operators.quantile import quantile_table
from tessera.plans.registry import oracle_sql, queries
from tessera.sources.io import nan_to_null, read_parquet


def test_labels_outside_the_order_keep_their_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "l string")
    got = {r["label"]: (r["n"], r["pct"]) for r in profile.class_distribution(df, "l", ["a", "b", "c"]).collect()}
    assert got == {"a": (1, 25.0), "b": (1, 25.0), "c": (0, 0.0), "z": (1, 25.0), None: (1, 25.0)}
    rel = spark.createDataFrame([("a", "b"), ("z", "a")], "original string, corrected string")
    assert transition_long(rel, ["a", "b"]).agg(F.sum("n")).first()[0] == 2


def test_quantiles_equal_numpy_on_hot_values(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([np.full(3000, 0.05), rng.integers(0, 11, 2000) / 100, rng.normal(size=500)])
    df = spark.createDataFrame([(float(x), int(i % 3 == 0) if i % 7 else None) for i, x in enumerate(v)] + [(None, 1)], "x double, g int")
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    row = quantile_table(df, ["x"], qs).first()
    assert np.allclose([row[f"q{i}"] for i in range(len(qs))], np.quantile(v, qs))
    by = {r["g"]: [r[f"q{i}"] for i in range(len(qs))] for r in quantile_table(df, ["x"], qs, by=["g"]).collect()}
    for g in (0, 1, None):
        own = [x for i, x in enumerate(v) if (int(i % 3 == 0) if i % 7 else None) == g]
        assert np.allclose(by[g], np.quantile(own, qs))


def test_hot_values_are_counted_before_they_are_ranged(spark, monkeypatch):
    from tessera.operators import order
    seen = []
    cut = order.cut_lineage
    monkeypatch.setattr(order, "cut_lineage", lambda df: seen.append(cut(df)) or seen[-1])
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    quantile_table(li, ["l_discount"], [0.5]).collect()
    assert seen[0].count() == li.select("l_discount").distinct().count()


def test_nan_is_missing(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "x double, s string")
    assert [r["x"] for r in nan_to_null(df).orderBy("s").collect()] == [1.0, None, None]
    df.write.parquet(f"{tmp_path}/t")
    assert read_parquet(spark, f"{tmp_path}/t").where("x is null").count() == 2
    got = profile.describe(read_parquet(spark, f"{tmp_path}/t"), ["x"]).first()
    assert (got["count"], got["mean"], got["max"]) == (1, 1.0, 1.0)


def test_cuts_are_deleted_with_their_scope(spark):
    with session.cuts(spark):
        df = session.cut_lineage(spark.range(5))
        path = df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert df.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_submit_configuration_wins():
    code = ("from tessera.session import get_spark; s = get_spark(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.sparkContext.defaultParallelism)")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("TESSERA", "PYSPARK", "SPARK"))}
    for args, want in (("--master local[2] --conf spark.sql.shuffle.partitions=37 pyspark-shell", "GOT local[2] 37 2"), (None, "GOT local[8] 8 8")):
        out = subprocess.run([sys.executable, "-c", code], cwd=root, env=env | ({"PYSPARK_SUBMIT_ARGS": args} if args else {}), capture_output=True, text=True, timeout=120)
        assert want in out.stdout, out.stderr[-2000:]


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}


class _Cluster:
    sparkContext, conf = _Context(), {}


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Cluster())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_queries_without_sql_run(spark, name):
    df = queries()[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and len(rows[0]) == len(df.columns)
    assert not any(isinstance(v, float) and np.isnan(v) for r in rows for v in r)
