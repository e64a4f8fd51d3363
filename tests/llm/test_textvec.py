import random
import re

import numpy as np
import pyarrow as pa

from tessera.llm import textvec as tv

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(n=200, seed=2):
    rng = random.Random(seed)
    alphabet = "abcABC019 \n\t\x0b\x0c\r\x1c.,-@é ß漢\U0001F600"
    return [None, "", " "] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


def check(pattern, member):
    rows = texts()
    col = pa.array(rows, pa.string())
    for part in (col, col[5:77], col[:0], pa.chunked_array([col[:9], col[9:]])):
        some = part.to_pylist()
        data, off = tv.text_buffers(part)
        w = tv.words(data, off, member)
        want = [re.findall(pattern, (t or "").translate(LOW)) for t in some]
        assert w.per_row.tolist() == list(map(len, want))
        flat = [x for ws in want for x in ws]
        got = [data[a:z].tobytes().decode().translate(LOW) for a, z in zip(w.start, w.end)]
        assert got == flat
        seen = {}
        for x, h in zip(flat, w.hash.tolist()):
            assert seen.setdefault(x, h) == h
        assert len(set(seen.values())) == len(seen)


def test_word_classes_equal_the_patterns():
    check(r"[^\x20\x09-\x0D]+", tv.NONSPACE)
    check(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", tv.ALNUM)


def test_chunks_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts()), "n": pa.array(range(203))})
    parts = list(tv.chunks(iter([batch, batch.slice(0, 0)]), "text", 50))
    assert sum((p.column("n").to_pylist() for p in parts), []) == list(range(203)) and len(parts) > 20


def test_ngrams_and_rows():
    w = tv.words(*tv.text_buffers(pa.array(["a b c d", "b c d", "x"])), tv.NONSPACE)
    h, inside = tv.ngram_hash(w.hash, 3), tv.within_row(w, 3)
    assert inside.tolist() == [True, True, False, False, True, False] and h[1] == h[4] and h[0] != h[1]
    assert len(tv.ngram_hash(w.hash, 99)) == 0 and len(tv.within_row(w, 99)) == 0


def test_counted():
    keys, n = tv.counted(np.array([3, 1, 3], np.uint64))
    assert keys.tolist() == [1, 3] and n.tolist() == [1, 2]
    assert tv.counted(np.array([3, 1, 3], np.uint64), np.array([5, 6, 7]))[1].tolist() == [6, 12]


def test_values_come_in_order_with_their_places():
    rng = np.random.default_rng(5)
    top = rng.integers(1, 1 << 62, 400).astype(np.uint64) << np.uint64(1)
    cases = [np.zeros(0, np.uint64), np.array([7], np.int64), rng.integers(0, 50, 1000), rng.integers(0, 1 << 32, 1000), np.repeat(top, 3),
             np.concatenate([top, top + np.uint64(1)]), np.array([2**64 - 1, 0, 2**64 - 1, 2**63], np.uint64), np.zeros(9, np.uint64)]
    # equal leading bits, later ones in falling order: sorting by the leading bits alone would leave them so
    cases.append((np.uint64(1) << np.uint64(63)) + np.arange(1000, dtype=np.uint64)[::-1])
    for x in cases:
        order, ordered = tv.in_order(x)
        assert ordered.dtype == x.dtype and ordered.tolist() == sorted(x.tolist()) and (x[order] == ordered).all()
        assert sorted(order.tolist()) == list(range(len(x)))
        values, one, back = tv.distinct(x)
        assert values.tolist() == sorted(set(x.tolist())) and (x[one] == values).all() and (values[back] == x).all()


def test_powers_are_not_made_anew_for_every_larger_chunk(monkeypatch):
    monkeypatch.setattr(tv, "_POW", {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)})
    up, _ = tv._powers(tv.CHUNK_BYTES + 5)
    assert tv._powers(tv.CHUNK_BYTES + 500)[0] is up
