import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from cases import frame, rows
from tessera.llm import op10_language_model as op
from tessera.llm import textvec as tv
from test_textvec import LOW


def seq(t):
    return ["<s>", *re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), "</s>"]


def model(train, order):
    """Interpolated modified Kneser-Ney by its definition; returns p(word, history)."""
    raw = [Counter() for _ in range(order + 1)]
    for s in train:
        for k in range(1, order + 1):
            for i in range(len(s) - k + 1):
                raw[k][tuple(s[i:i + k])] += 1
    used = [None] * (order + 1)
    for k in range(1, order + 1):
        if k == order:
            used[k] = dict(raw[k])
        else:
            left = defaultdict(set)
            for g in raw[k + 1]:
                left[g[1:]].add(g[0])
            used[k] = {g: len(left[g]) if g in left else c for g, c in raw[k].items()}
    used[1].pop(("<s>",), None)
    tables, v = [], len(used[1])
    for k in range(1, order + 1):
        n = Counter(min(c, 5) for c in used[k].values())
        d = op.discounts(n[1], n[2], n[3], n[4])
        total, kinds = defaultdict(float), defaultdict(lambda: [0, 0, 0])
        for g, c in used[k].items():
            total[g[:-1]] += c
            kinds[g[:-1]][min(c, 3) - 1] += 1
        tables.append((used[k], d, total, kinds))

    def p(word, history, k):
        if k == 0:
            return 1 / (v + 1)
        h = tuple(history[len(history) - k + 1:]) if k > 1 else ()
        if k > 1 and len(h) < k - 1:
            return p(word, history, k - 1)
        c, d, total, kinds = tables[k - 1]
        lower = p(word, history, k - 1)
        if h not in total:
            return lower if k > 1 or total else 1.0
        n = c.get((*h, word), 0)
        return (max(n - (0, *d)[min(n, 3)], 0) + sum(x * y for x, y in zip(d, kinds[h]))  * lower) / total[h]

    return p, v


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_the_definition(spark, order):
    rng = random.Random(order)
    vocab = [f"w{min(int(rng.expovariate(0.2)), 40)}" for _ in range(60)]
    data = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(30))), "en") for i in range(80)] + rows(20)
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    train = [seq(t) for i, t, _ in data if not held(i)]
    p, v = model(train, order)
    count = Counter(w for s in train for w in s[1:])
    n = sum(count.values())
    got = sorted(op.score(frame(spark, data), order).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    assert len(got) == len(data) and {r["held_out"] for r in got} == {True, False}
    for r, (i, t, _) in zip(got, sorted(data, key=lambda x: (x[0] is None, x[0] or 0))):
        s = seq(t)
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["train_tokens"]) == (i, held(i), len(s) - 1, n)
        assert r["n_known"] == sum(w in count for w in s[1:])
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in s[1:]), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(w, s[:k], order)) for k, w in enumerate(s) if k), rel_tol=1e-4), r
        assert math.isclose(r["perplexity"], 10 ** (-r["score"] / r["n_tokens"]), rel_tol=1e-9)


def test_probabilities_sum_to_one():
    rng = random.Random(9)
    train = [["<s>", *[rng.choice("abcde") for _ in range(9)], "</s>"] for _ in range(30)]
    p, _ = model(train, 3)
    for history in (["<s>"], ["<s>", "a"], ["a", "b"], ["zz", "a"]):
        assert math.isclose(sum(p(w, history, 3) for w in [*"abcde", "</s>", "unseen"]), 1.0, rel_tol=1e-9)


def test_empty_tables(spark):
    assert op.score(frame(spark, [])).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = op.score(frame(spark, [(alone, "a b", "en")])).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)


def test_mix_can_be_undone():
    x = np.random.default_rng(0).integers(0, 2**63, 1000).astype(tv.U64) * tv.U64(2) + tv.U64(1)
    assert (op.unmix(tv.mix(x)) == x).all()


def test_the_query_scores_with_trigrams(spark, tmp_path):
    from tessera.llm import queries
    rng = random.Random(5)
    data = [(i, " ".join(rng.choice("abcdef") for _ in range(20)), "en") for i in range(60)]
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    p, _ = model([seq(t) for i, t, _ in data if zlib.crc32(str(i).encode()) % 10], 3)
    for r in queries.op10_kneser_ney(spark, str(tmp_path)).collect():
        s = seq(data[r["doc_id"]][1])
        assert math.isclose(r["score"], sum(math.log10(p(w, s[:k], 3)) for k, w in enumerate(s) if k), rel_tol=1e-4)


def test_packed_arrays_come_back():
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 500).astype(tv.U64) * tv.U64(2))
    assert (op.unpacked(op.packed(x, True), tv.U64, True) == x).all()
    assert (op.unpacked(op.packed(x.astype(np.uint32)), np.uint32) == x.astype(np.uint32)).all()
    assert len(op.unpacked(op.packed(x[:0], True), tv.U64, True)) == 0


def test_tokens_do_not_depend_on_the_rows_hashed_together(monkeypatch):
    texts = ["", "", "a b", "", "Ünï  code\n", *[f"w{k} W{k % 7} end" for k in range(300)], "x " * 50, "", " "]
    data, off = tv.text_buffers(pa.array(texts))
    asked, words = [], tv.words
    monkeypatch.setattr(op.tv, "words", lambda data, *a: asked.append(len(data)) or words(data, *a))
    whole = op.tokens(data, off)
    assert sum(asked) == max(asked) == len(data)
    asked.clear()
    monkeypatch.setattr(op, "HASH_BYTES", 64)
    few = op.tokens(data, off)
    assert [x.tolist() for x in few] == [x.tolist() for x in whole]
    assert sum(asked) == len(data) and max(asked) < 200
    assert [len(x) for x in op.tokens(*tv.text_buffers(pa.array([], pa.string())))] == [0, 0]
