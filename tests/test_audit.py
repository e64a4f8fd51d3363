"""Label audit over clusterings made without the label, the Euclidean silhouette, and a plan fitted on train rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from tessera.operators import cluster as cl
from tessera.operators import labels as lb
from tessera.plans import prepare as pr


def test_planted_flips_are_found_without_the_label(spark):
    """Three blobs whose labels are flipped for 8 %, and a few strays: discord finds the flips, noise the strays."""
    rng = np.random.default_rng(6)
    X = np.concatenate([rng.normal(size=(200, 2)) + c for c in ([0, 0], [9, 0], [0, 9])] + [rng.random((12, 2)) * 60 - 30])
    true = np.array(["a"] * 200 + ["b"] * 200 + ["c"] * 200 + ["a"] * 12)
    flip = np.zeros(len(X), bool)
    flip[rng.choice(600, 48, replace=False)] = True
    label = np.where(flip, np.array(list("bca"))[(np.char.replace(np.char.replace(np.char.replace(true, "a", "0"), "b", "1"), "c", "2")).astype(int)], true)
    df = spark.createDataFrame([(i, [float(v) for v in r], str(c)) for i, (r, c) in enumerate(zip(X, label))], "key long, x array<double>, label string")
    got = {r["key"]: r for r in lb.audit(df, "key", "label", 3, eps=1.2, min_samples=5, n_init=8).collect()}
    assert len(got) == len(X)
    inside = range(600)
    found = {i for i in inside if got[i]["flag_discord"]}
    hit = len(found & set(np.flatnonzero(flip)))
    assert hit / 48 >= 0.95 and hit / len(found) >= 0.9
    assert sum(got[i]["flag_noise"] for i in range(600, 612)) >= 9 and np.mean([got[i]["flag_noise"] for i in inside]) < 0.05
    assert all(r["suspicion_score"] == r["flag_discord"] + r["flag_ambiguous"] + r["flag_noise"] and r["is_suspect"] == (r["suspicion_score"] >= 2) for r in got.values())


@pytest.mark.parametrize("m", [50, 10_000])
def test_euclidean_silhouette_by_definition(spark, m):
    rng = np.random.default_rng(2)
    X, lab = rng.normal(size=(240, 3)), rng.integers(-1, 3, 240)
    X[lab == 1] += 3
    lab[0] = 7  # alone
    points = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(X)], "key long, x array<double>").repartition(4)
    labels = spark.createDataFrame([(i, int(c)) for i, c in enumerate(lab)], "key long, cluster int")
    from tessera.functions.columns import hash_unit
    order = [r["key"] for r in points.where(F.col("key").isin([int(i) for i in np.flatnonzero(lab >= 0)])).orderBy(hash_unit("key", 42), "key").collect()][:m]
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    want = []
    for i in order:
        own = (lab == lab[i]) & (np.arange(240) != i)
        b = min(D[i, lab == c].mean() for c in set(lab[lab >= 0]) - {lab[i]})
        want.append((b - D[i, own].mean()) / max(b, D[i, own].mean()) if own.any() else 0.0)
    got = cl.silhouette_sample(points, labels, "key", m=m).first()
    assert got["n"] == len(order) and got["silhouette"] == pytest.approx(np.mean(want))
    assert cl.silhouette_sample(points, labels.where("cluster = 1"), "key").first()["silhouette"] is None
    assert cl.silhouette_sample(points, labels.where("cluster < 0"), "key").first()["n"] == 0


def test_train_fit_sees_no_test_row(spark, tmp_path):
    """Test prices made absurd change nothing of the train rows but returns on a test row's price."""
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    plain = pr.prepare(spark, SF_SMALL, train_fit=True)
    test = plain.where("split = 'test'").select("o_orderkey", F.lit(True).alias("t"))
    o.join(test, "o_orderkey", "left").withColumn("o_totalprice", F.when(F.col("t"), F.col("o_totalprice") * 1000).otherwise(F.col("o_totalprice"))).drop("t").write.parquet(f"{tmp_path}/orders.parquet")
    changed = pr.prepare(spark, str(tmp_path), train_fit=True)
    one, two = ({r["o_orderkey"]: r["o_totalprice"] for r in df.where("split = 'train'").select("o_orderkey", "o_totalprice").collect()} for df in (plain, changed))
    assert one == two
    top = plain.where("split = 'train'").agg(F.max("o_totalprice")).first()[0]
    assert changed.where("split = 'test'").agg(F.max("o_totalprice")).first()[0] == top
