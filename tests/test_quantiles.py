"""Exact quantiles by selection against numpy, and the ways around a missed bracket."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import quantile as qu

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def expected(values, qs):
    return [float(np.quantile(values, q)) for q in qs]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    n = 60_000
    a = rng.normal(size=n)
    a[: n // 3] = 0.25  # a third of all rows share one value
    b = np.exp(rng.normal(size=n) * 4)
    g = rng.integers(0, 4, n)
    g[n // 2:] = 0  # a hot group
    rows = [(int(k), None if i % 7 == 0 else float(x), float(y), None) for i, (k, x, y) in enumerate(zip(g, a, b))]
    rows += [(None, 1.0, 2.0, None), (None, 3.0, None, None), (9, None, 5.0, None)]
    df = spark.createDataFrame(rows, "g int, a double, b double, empty double").repartition(7).cache()
    df.count()
    return df, rows


@pytest.mark.parametrize("small", [qu.SMALL, 0, 10**9])
def test_whole_table(data, monkeypatch, small):
    df, rows = data
    monkeypatch.setattr(qu, "SMALL", small)
    got = {r["column"]: [r[f"q{i}"] for i in range(len(QS))] for r in qu.quantile_table(df, ["a", "b", "empty"], QS).collect()}
    assert set(got) == {"a", "b"}
    for j, c in ((1, "a"), (2, "b")):
        assert np.allclose(got[c], expected([r[j] for r in rows if r[j] is not None], QS), rtol=1e-13)


def test_groups(data, monkeypatch):
    df, rows = data
    monkeypatch.setattr(qu, "SMALL", 100)
    got = {(r["g"], r["column"]): [r[f"q{i}"] for i in range(len(QS))] for r in qu.quantile_table(df, ["a", "b"], QS, by=["g"]).collect()}
    want = {(g, c): expected(v, QS) for g in {r[0] for r in rows} for j, c in ((1, "a"), (2, "b")) if (v := [r[j] for r in rows if r[0] == g and r[j] is not None])}
    assert set(got) == set(want)
    assert all(np.allclose(got[k], want[k], rtol=1e-13) for k in want)


def test_many_values_are_ranked_by_running_sums(data, monkeypatch):
    df, rows = data
    monkeypatch.setattr(qu, "WINDOW_ROWS", 10)
    got = qu.quantile_table(df, ["b"], [0.25, 0.75]).first()
    assert np.allclose([got["q0"], got["q1"]], expected([r[2] for r in rows if r[2] is not None], [0.25, 0.75]), rtol=1e-13)


def test_a_missed_bracket_is_noticed(data, monkeypatch):
    df, rows = data
    real = F.percentile_approx
    monkeypatch.setattr(qu.F, "percentile_approx", lambda c, ps, acc: real(c, [min(1.0, p + 0.3) for p in ps], acc))
    used = []
    old = qu._counted
    monkeypatch.setattr(qu, "_counted", lambda *a: used.append(1) or old(*a))
    got = qu.quantile_table(df, ["a", "b"], [0.5]).collect()
    assert used and {r["column"]: r["q0"] for r in got} == pytest.approx({c: expected([r[j] for r in rows if r[j] is not None], [0.5])[0] for j, c in ((1, "a"), (2, "b"))})


def test_nothing_and_not_a_number(spark):
    none = spark.createDataFrame([], "g int, a double")
    assert qu.quantile_table(none, ["a"], [0.5]).count() == 0
    assert qu.quantile_table(none, ["a"], [0.5], by=["g"]).count() == 0
    nan = spark.createDataFrame([(1, 1.0), (1, float("nan")), (2, 4.0)], "g int, a double")
    assert str([r["q0"] for r in qu.quantile_table(nan, ["a"], [1.0], by=["g"]).orderBy("g").collect()]) == "[nan, 4.0]"
    one = spark.createDataFrame([(1, 2.5)], "g int, a double")
    assert qu.quantile_table(one, ["a"], [0.5], by=["g"]).first()["q0"] == 2.5


def test_no_sort_and_no_shuffle_of_the_data(data, monkeypatch):
    """Only counted values inside the brackets are written: a few thousandths of the rows."""
    df, _ = data
    monkeypatch.setattr(qu, "SMALL", 100)
    cuts, real = [], qu.cut_lineage
    monkeypatch.setattr(qu, "cut_lineage", lambda d: cuts.append(real(d)) or cuts[-1])
    qu.quantile_table(df, ["b"], [0.25, 0.5, 0.75]).collect()
    assert max(c.count() for c in cuts) < 0.02 * df.count()
