import math

import numpy as np

from tessera.llm import op12_neighbours as op

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, class int, row int, query_id int"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "x", "x", 1, 1, 1) for i, v in data], schema)


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(data, k=5):
    """Every query row against every other row."""
    dims = max([len(v) for _, v in data if usable(v)], default=0)
    rows = [(i, np.array(v + [0.0] * (dims - len(v)), np.float32).astype(np.float64)) for i, v in data if usable(v)]
    out = []
    for n, (q, x) in enumerate(rows):
        if q is None or q % 50:
            continue
        scores = [(-float(x @ y / np.sqrt((x @ x) * (y @ y))), c is None, c or 0) for m, (c, y) in enumerate(rows) if m != n]
        out += [(q, r + 1, None if none else c, -s) for r, (s, none, c) in enumerate(sorted(scores, key=lambda e: (round(e[0], 12), *e[1:]))[:k])]
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def check(got, want):
    got = sorted([tuple(r) for r in got], key=lambda r: (r[0], r[1], r[3]))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(a[3] - b[3]) < 1e-12 for a, b in zip(got, want, strict=True))
    assert sorted(r[:3] for r in got if r[2] is not None) == sorted(r[:3] for r in want if r[2] is not None)


def test_all_neighbours_found(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 24))
    x[2000:2200] = x[0] + 1e-3 * rng.normal(size=(200, 24))  # far closer than int8 can tell
    x[3000:4500] = x[50]                                     # a hot vector, queries among its copies
    data = [(i, np.float32(v).tolist()) for i, v in enumerate(x)]
    check(op.nearest(frame(spark, data)).collect(), brute(data))


def test_several_blocks_of_queries(spark):
    rng = np.random.default_rng(5)
    data = [(i, np.float32(v).tolist()) for i, v in enumerate(rng.normal(size=(3000, 8)))]
    old = op.QUERY_VALUES, op.CANDIDATE_BLOCK
    op.QUERY_VALUES, op.CANDIDATE_BLOCK = 8 * 20, 100
    try:
        check(op.nearest(frame(spark, data)).collect(), brute(data))
    finally:
        op.QUERY_VALUES, op.CANDIDATE_BLOCK = old


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 4.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (None, [-1.0, 0.5]), (None, [0.0, -0.0, 1.0]),
            (3, [2.0**-60, 2.0**-59]), (4, [3e38, 3e38]), (100, None), (150, []), (200, [0.0, -0.0]), (250, [1.0, nan]), (300, [inf, 1.0]), (350, [None, 1.0])]
    check(op.nearest(frame(spark, data)).collect(), brute(data))
    assert op.nearest(frame(spark, [])).count() == 0
    assert op.nearest(frame(spark, [(50, [1.0])])).count() == 0
    assert op.nearest(frame(spark, [(51, [1.0]), (52, [1.0])])).count() == 0
    double = SCHEMA.replace("array<float>", "array<double>")
    got = op.nearest(frame(spark, [(0, [1e300, 1.0]), (1, [1e-300, 0.0]), (2, [1e200, -1e200])], double)).collect()
    assert [(r["vec_id"], round(r["score"], 9)) for r in got] == [(1, 1.0), (2, round(math.sqrt(0.5), 9))]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for dims in (1, 3, 64, 1500):
        q, c = op.scaled(rng.normal(size=(40, dims)) * 10.0 ** rng.integers(-20, 20, (40, 1))), op.scaled(rng.normal(size=(70, dims)) ** 3)
        estimate, off = op.bounds(op.Int8(q), slice(0, 40), op.Int8(c))
        exact = np.array([op.cosines(np.repeat(q[i: i + 1], 70, axis=0), c) for i in range(40)])
        assert (np.abs(estimate - exact) <= off).all()
        a, b = op.Int8(q).codes, op.Int8(c).codes
        assert (op.product(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()
