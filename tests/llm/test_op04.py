import itertools
import random

import numpy as np

from cases import DE, EN, frame, rows, sentence
from tessera.llm import op04_language as op


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    k, per = 3, [5, 0, 1, 7]
    emit, move = rng.normal(size=(sum(per), k)) * 2, rng.normal(size=(k, k))
    got, at = op.marginals(emit, np.array(per), move), 0
    for n in per:
        want, total = np.zeros((n, k)), 0.0
        for path in itertools.product(range(k), repeat=n):
            p = np.exp(sum(emit[at + i, y] for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            total += p
            for i, y in enumerate(path):
                want[i, y] += p
        assert np.allclose(got[at: at + n], want / total)
        at += n


def test_blocks_equal_one_long_pass():
    rng = np.random.default_rng(1)
    per = np.array([300, 0, 32, 33, 64, 1])
    emit, move = rng.normal(size=(per.sum(), 4)) * 3, rng.normal(size=(4, 4)) * 2
    got, at, m = op.marginals(emit, per, move), 0, np.exp(move)
    for n in per.tolist():
        e = np.exp(emit[at: at + n])
        a, b = np.ones((n, 4)), np.ones((n, 4))
        for t in range(n):
            a[t] = e[t] * ((a[t - 1] @ m) if t else m.sum(axis=0) * 0 + 1)
            a[t] /= a[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = m @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        want = a * b
        assert np.allclose(want / want.sum(axis=1, keepdims=True), got[at: at + n])
        at += n


def test_held_out_accuracy_and_cases(spark):
    data = rows(200, seed=8)
    got = {(r["doc_id"], r["lang_pred"]): r for r in op.identify(frame(spark, data)).collect()}
    truth = {i: lang for i, t, lang in data if i is not None and i < 200}
    pred = {i: p for i, p in got}
    held = [i for (i, _), r in got.items() if r["held_out"] and i is not None and i < 200]
    assert len(held) > 20 and np.mean([pred[i] == truth[i] for i in held]) > 0.95
    assert all(pred[i] == "und" and got[i, "und"]["score"] == 0 for i in (900, 901, 902, 903))
    assert all(0 <= r["score"] <= 1 for r in got.values()) and pred[905] in ("en", "de")
    assert op.identify(frame(spark, data)).count() == len(data)


def test_code_switched_words_are_told_apart():
    rng = random.Random(2)
    model = op.train([(sentence(rng, w, 60), lang) for w, lang in ((EN, "en"), (DE, "de")) for _ in range(30)])
    text = sentence(rng, EN, 20) + " " + sentence(rng, DE, 20)
    import pyarrow as pa
    from tessera.llm import textvec as tv
    _, n, mass = op.label(model, *tv.text_buffers(pa.array([text])))
    said = [model["langs"][j] for j in mass.argmax(axis=1)]
    assert n.tolist() == [40] and said[:18].count("en") >= 17 and said[22:].count("de") >= 17


def test_nothing_to_learn_from(spark):
    assert op.identify(frame(spark, [])).count() == 0
    got = op.identify(frame(spark, [(1, "words here", None), (2, None, None)])).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und"]


def test_texts_of_no_learned_language_go(spark, monkeypatch):
    docs = frame(spark, [(k, "t", None) for k in range(5)])
    scores = {0: 0.0, 1: 0.1, 2: 0.25, 3: 0.31, 4: 0.9}
    monkeypatch.setattr(op, "predict", lambda d, m: d.selectExpr("struct(*) as doc", "'x' as lang_pred", f"element_at(array({', '.join(map(str, scores.values()))}), int(doc_id) + 1) * 1.0D as score"))
    for langs, kept in (("abcd", {3, 4}), ("ab", {3, 4}), ("abcdefghij", {2, 3, 4}), ("a", {1, 2, 3, 4})):
        monkeypatch.setattr(op, "fit", lambda d, langs=langs: {"langs": list(langs)})
        out = op.known(docs)
        assert {r["doc_id"] for r in out.collect()} == kept and out.columns == docs.columns
