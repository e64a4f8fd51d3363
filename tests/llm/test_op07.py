import random
import zlib

import numpy as np
import pyarrow as pa

from cases import EN, frame, rows, sentence
from tessera.llm import op07_quality as op
from tessera.llm import textvec as tv


def test_pair_sum_identity():
    rng = np.random.default_rng(0)
    model = {"w0": 0.3, "w": rng.normal(size=12), "v": rng.normal(size=(12, op.FACTORS))}
    feat = [np.array([0, 3, 7]), np.array([], int), np.array([1, 2, 3, 11])]
    value = [rng.normal(size=len(f)) for f in feat]
    got, _ = op.raw_score(model, np.repeat([0, 1, 2], [3, 0, 4]), np.concatenate(feat), np.concatenate(value), 3)
    for r, (f, x) in enumerate(zip(feat, value)):
        want = 0.3 + sum(model["w"][i] * a for i, a in zip(f, x))
        want += sum(model["v"][f[a]] @ model["v"][f[b]] * x[a] * x[b] for a in range(len(f)) for b in range(a + 1, len(f)))
        assert np.isclose(got[r], want)


def test_structure_sees_repetition():
    data, off = tv.text_buffers(pa.array(["a b\na b\na b", "a b\nc d\ne f", "", None]))
    s = op.structure(data, off, tv.words(data, off, tv.NONSPACE))
    assert s[0, 4] > 0.6 and s[1, 4] == 0 and s[0, 3] < s[1, 3] and np.isfinite(s).all()


def labelled(seed=1):
    rng = random.Random(seed)
    data, labels = [], []
    for i in range(400):
        good = i % 2
        t = sentence(rng, EN, 40) + "." if good else rng.choice([sentence(rng, EN, 30).upper().replace(" ", "!! "), "buy now\n" * 20, " | ".join(EN[:5] * 4)])
        data.append((i, t, "en"))
        labels.append((i, good, 0))
    return data, labels + [(1, None, 1), (99999, 1, 0), (None, 1, 0), (3, 1, 1)]


def test_held_out_accuracy_and_cases(spark):
    data, labels = labelled()
    data += rows(4)[4:11]
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = op.quality(frame(spark, data), marked).collect()
    assert len(got) == len(data) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert len(held) > 40 and np.mean([r["predicted"] == r["doc_id"] % 2 for r in held]) > 0.9


def test_one_label_or_none(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in op.quality(frame(spark, rows(6)), none).collect()} == {0.5}
    assert op.quality(frame(spark, []), none).count() == 0
