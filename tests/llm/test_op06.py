import os
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from cases import frame, rows
from tessera.llm import op06_packing as op
from tessera.llm import textvec as tv

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_memory_gives_the_tokenizers_ids():
    rng = random.Random(3)
    alphabet = ["don't", "Ünïcode", "é", "́x", " ", " a", "漢字", "<|endoftext|>", "a<|startoftext|>b", "İstanbul", "ΣΑΣ", "10,000.5", "'s", "\x00", "\x1c", "  ", "\n", "\x85q", "ﬁ", "🙂👍", "End.", "A,b", "x'S.", "I\u0307.", "A\u030a!", "….", "“.a", "<|ENDOFTEXT|>", "a<b>.C", "###", "it'll!", "K\u212a", "ß.", "1.2,3", "-5"]
    texts = ["", " ", *alphabet] + [rng.choice(["", " "]).join(rng.choice(alphabet) for _ in range(12)) for _ in range(300)] + [t for _, t, _ in rows(10) if t]
    tok = Tokenizer.from_file(PATH)
    enc = op.WordEncoder(PATH)
    for _ in range(2):
        ids, n = enc.encode(*tv.text_buffers(pa.array(texts)))
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_an_encoder_starts_no_threads_of_its_own(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    op.WordEncoder(PATH)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    monkeypatch.setenv("TOKENIZERS_PARALLELISM", "true")
    op.WordEncoder(PATH)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "true"


def test_distinct_names_a_place_of_each_value():
    for x in (np.zeros(0, np.uint64), np.array([7], np.uint64), np.random.default_rng(1).integers(0, 9, 100).astype(np.uint64)):
        values, one, back = tv.distinct(x)
        assert values.tolist() == sorted(set(x.tolist())) and (x[one] == values).all() and (values[back] == x).all()


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(6))}
        room = rng.randrange(60)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * j for s in sums for j in range(n + 1) if s + k * j <= room}
        used = op.fullest(counts, room)
        assert sum(k * n for k, n in used.items()) == max(sums) and all(n <= counts[k] for k, n in used.items())


def test_pieces_and_places(spark):
    data = rows(60)
    tok = Tokenizer.from_file(PATH)
    out = op.pack(frame(spark, data), PATH, capacity=128).collect()
    ids_of = [(i, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, _ in data]
    want = sorted((i if i is not None else -1, p, p * 128, len(c), zlib.crc32(np.array(c, "<u4").tobytes()))
                  for i, ids in ids_of for p, c in enumerate([ids[k:k + 128] for k in range(0, len(ids), 128)]))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    bins = defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 128
    total = sum(len(ids) for _, ids in ids_of)
    assert len(bins) <= -(-total // 128) + 2


def test_bins_are_full_on_many_lengths():
    rng = random.Random(7)
    hist = defaultdict(int)
    for _ in range(30000):
        hist[min(4096, int(rng.lognormvariate(6, 1)) + 1)] += 1
    rows_, n = op.plan(dict(hist), 4096)
    total = sum(k * c for k, c in hist.items())
    assert n <= -(-total // 4096) * 1.002 + 1
    placed = defaultdict(int)
    for length, first, start, times, offset in rows_:
        assert offset + length <= 4096
        placed[length] += times
    assert op.plan({}, 4096) == ([], 0)


def test_empty_table(spark):
    assert op.pack(frame(spark, []), PATH).count() == 0
