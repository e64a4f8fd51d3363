"""Language of code-switched text by a linear-chain conditional random field over words.

A word's features are its affixes, its inner byte n-grams and the learned lexicons that hold
it; transitions between the words' languages are learned too.  Training maximises the
likelihood of sequences spliced from runs of differently labelled texts; labelling takes the
marginals of exact forward-backward over the whole text.  Chains are cut into blocks whose
transfer matrices are chained, so that all blocks of a batch move in step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import arrow_column, fold, give_back, sampled

U64 = tv.U64
SAMPLE_ROWS = 120      # labelled rows per language that training sees
SAMPLE_WORDS = 60_000  # words per language that training sees
BUCKETS = 1 << 15      # hashed affix and n-gram features
LEXICON = 2_000        # words in each language's lexicon
BLOCK = 32
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
LEAST = 1.2  # times its share by chance that a language needs for a text to count as known
ENOUGH = 0.3  # share of words that is enough however few languages there are


def feature_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs of words given as spans of lower-cased bytes; key: the words' hashes."""
    words, feats = [], []
    n = np.arange(len(start))

    def put(which, a, z, salt):
        h = tv.mix(tv.span_hash(data, a, z) + U64(salt))
        words.append(n[which])
        feats.append((h % U64(BUCKETS)).astype(np.int64))

    size = end - start
    for k in range(1, 5):
        ok = size >= k
        put(ok, start[ok], start[ok] + k, k)
        put(ok, end[ok] - k, end[ok], 16 + k)
    for k in (2, 3):  # inner n-grams
        many = np.maximum(size - k + 1, 0)
        which = np.repeat(n, many)
        at = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        if len(at):
            put(which, at, at + k, 32 + k)
    keys, lang = lexicon
    if len(keys):
        left, right = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        many = right - left
        which = np.repeat(n, many)
        at = left[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        words.append(which)
        feats.append(BUCKETS + lang[at])
    return np.concatenate(words), np.concatenate(feats)


def emissions(model: dict, data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Score of each language for each word (without context)."""
    word, feat = feature_ids(data, start, end, key, model["lexicon"])
    k = len(model["langs"])
    out = np.empty((len(start), k))
    for j in range(k):
        out[:, j] = np.bincount(word, weights=model["weights"][feat, j], minlength=len(start))
    return out + model["bias"]


def marginals(emit: np.ndarray, per_row: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Forward-backward marginals (words x languages) of chains that follow each other in ``emit``."""
    k = emit.shape[1]
    if not len(emit):
        return emit
    m = np.exp(move - move.max())
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    blocks = -(-per_row // BLOCK)
    nb = int(blocks.sum())
    first_block = np.concatenate([[0], np.cumsum(blocks)])
    first_word = np.concatenate([[0], np.cumsum(per_row)])
    row = np.repeat(np.arange(len(per_row)), per_row)
    place = np.arange(len(emit)) - first_word[row]
    block, slot = first_block[row] + place // BLOCK, place % BLOCK
    pad = np.ones((nb, BLOCK, k))
    pad[block, slot] = e
    filled = np.zeros((nb, BLOCK), bool)
    filled[block, slot] = True
    # transfer of each block: product of (move, then emission) over its words; padding is the identity
    transfer = np.broadcast_to(np.eye(k), (nb, k, k)).copy()
    opens = np.zeros(nb, bool)
    opens[first_block[:-1][blocks > 0]] = True  # a row's first word is not moved to
    for t in range(BLOCK):
        on = filled[:, t]
        step = transfer[on] @ m
        if t == 0:
            step[opens[on]] = np.eye(k)
        step *= pad[on, t][:, None, :]
        transfer[on] = step / step.max(axis=(1, 2), keepdims=True)
    entry, leave = np.full((nb, k), 1.0 / k), np.full((nb, k), 1.0)
    order = np.argsort(-blocks, kind="stable")
    heads, count = first_block[:-1][order], blocks[order]
    a, z = np.full((len(order), k), 1.0 / k), np.ones((len(order), k))
    for i in range(int(blocks.max(initial=0))):
        live = int(np.searchsorted(-count, -i, "left"))  # rows with more than i blocks
        at = heads[:live] + i
        entry[at] = a[:live]
        a[:live] = np.einsum("nk,nkj->nj", a[:live], transfer[at])
        a[:live] /= a[:live].sum(axis=1, keepdims=True)
        last = heads[:live] + count[:live] - 1 - i
        leave[last] = z[:live]
        z[:live] = np.einsum("nkj,nj->nk", transfer[last], z[:live])
        z[:live] /= z[:live].sum(axis=1, keepdims=True)
    forward = np.zeros((nb, BLOCK, k))
    a = entry
    for t in range(BLOCK):
        on = filled[:, t]
        new = np.where((opens & (t == 0))[:, None], a, a @ m) * pad[:, t]
        a = np.where(on[:, None], new / new.sum(axis=1, keepdims=True), a)
        forward[:, t] = a
    z = leave
    for t in range(BLOCK - 1, -1, -1):
        on = filled[:, t]
        both = forward[:, t] * z
        forward[:, t] = both / both.sum(axis=1, keepdims=True)
        new = (pad[:, t] * z) @ m.T
        z = np.where(on[:, None], new / new.sum(axis=1, keepdims=True), z)
    return forward[block, slot]


def _chain(data: np.ndarray, off: np.ndarray) -> tuple[tv.Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of letters, and their distinct forms: (words, form of each word, a place of each form, kept forms).

    A run of bytes >= 0x80 counts only if it holds a letter.
    """
    w = tv.words(data, off, LETTER)
    keys, one, back = np.unique(w.hash, return_index=True, return_inverse=True)
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    plain = np.concatenate([[0], np.cumsum((data < 128) & LETTER[data])])
    a, z = w.start[one], w.end[one]
    letters = plain[z] - plain[a] > 0
    for i in np.flatnonzero(~letters & (high[z] - high[a] > 0)).tolist():
        letters[i] = any(c.isalpha() for c in data[a[i]: z[i]].tobytes().decode())
    return w, back, one, letters


def train(rows: list[tuple[str, str]], steps: int = 80, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> dict:
    """Fit on (text, language) rows: Adagrad on the exact log-likelihood of spliced sequences."""
    langs = sorted({lang for _, lang in rows})
    rng, k = np.random.default_rng(seed), len(langs)
    data, off = tv.text_buffers(pa.array([t for t, _ in rows], pa.large_string()))
    data = tv.LOWER[data]
    w, form, one, letters = _chain(data, off)
    lang_of = np.array([langs.index(x) for _, x in rows], np.int64) if rows else np.zeros(0, np.int64)
    usable = letters[form]
    word_form, word_lang = form[usable], lang_of[w.row[usable]]
    keep = np.zeros(len(word_lang), bool)
    for j in range(k):
        keep[np.flatnonzero(word_lang == j)[:SAMPLE_WORDS]] = True
    word_form, word_lang = word_form[keep], word_lang[keep]
    if not len(word_form):
        return {"langs": langs or ["und"], "weights": np.zeros((BUCKETS + max(k, 1), max(k, 1))), "bias": np.zeros(max(k, 1)),
                "move": np.zeros((max(k, 1), max(k, 1))), "lexicon": (np.zeros(0, U64), np.zeros(0, np.int64))}
    # lexicons: each language's most frequent forms
    lex_key, lex_lang = [], []
    for j in range(k):
        ids, n = np.unique(word_form[word_lang == j], return_counts=True)
        top = ids[np.argsort(-n, kind="stable")[:LEXICON]]
        lex_key.append(w.hash[one[top]])
        lex_lang.append(np.full(len(top), j))
    lex_key, lex_lang = np.concatenate(lex_key), np.concatenate(lex_lang)
    order = np.lexsort((lex_lang, lex_key))
    lexicon = (lex_key[order], lex_lang[order])
    used, word_form = np.unique(word_form, return_inverse=True)
    fw, ff = (x.astype(np.int32) for x in feature_ids(data, w.start[one[used]], w.end[one[used]], w.hash[one[used]], lexicon))
    # splice runs of 6 to 40 words of random languages into sequences of BLOCK words
    pools = [np.flatnonzero(word_lang == j) for j in range(k)]
    cursor, parts, n_words = [0] * k, [], sum(map(len, pools))
    filled = 0
    while filled < n_words:
        j = int(rng.integers(k))
        size = int(rng.integers(6, 41))
        if len(pools[j]):
            take = (np.arange(cursor[j], cursor[j] + size)) % len(pools[j])
            parts.append(pools[j][take])
            cursor[j] += size
            filled += size
    seq = np.concatenate(parts)
    seq = seq[: max(1, len(seq) // BLOCK) * BLOCK] if len(seq) >= BLOCK else np.resize(seq, BLOCK)
    x, y = word_form[seq].reshape(-1, BLOCK), word_lang[seq].reshape(-1, BLOCK)
    weights, bias, move = np.zeros((BUCKETS + k, k)), np.zeros(k), np.zeros((k, k))
    sums = [np.full(p.shape, 1e-6) for p in (weights, bias, move)]
    gold = np.zeros((len(used), k))
    np.add.at(gold, (x.ravel(), y.ravel()), 1.0)
    gold_move = np.zeros((k, k))
    np.add.at(gold_move, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1.0)
    for _ in range(steps):
        emit = np.stack([np.bincount(fw, weights=weights[ff, j], minlength=len(used)) for j in range(k)], axis=1) + bias
        e = np.exp(emit - emit.max(axis=1, keepdims=True))[x]
        m = np.exp(move)
        alpha, beta = np.empty(e.shape), np.ones(e.shape)
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, BLOCK):
            a = (alpha[:, t - 1] @ m) * e[:, t]
            alpha[:, t] = a / a.sum(axis=1, keepdims=True)
        for t in range(BLOCK - 2, -1, -1):
            z = (e[:, t + 1] * beta[:, t + 1]) @ m.T
            beta[:, t] = z / z.sum(axis=1, keepdims=True)
        mass = alpha * beta
        mass /= mass.sum(axis=2, keepdims=True)
        expect = np.stack([np.bincount(x.ravel(), weights=mass[:, :, j].ravel(), minlength=len(used)) for j in range(k)], axis=1)
        pair = alpha[:, :-1, :, None] * m * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        per_form = (gold - expect) / x.size
        grads = (np.stack([np.bincount(ff, weights=per_form[fw, j], minlength=BUCKETS + k) for j in range(k)], axis=1) - decay / 100 * weights,
                 per_form.sum(axis=0), (gold_move - pair.sum(axis=(0, 1))) / x.size - decay * move)
        for p, g, s in zip((weights, bias, move), grads, sums, strict=True):
            s += g * g
            p += rate * g / np.sqrt(s)
    return {"langs": langs, "weights": weights, "bias": bias, "move": move, "lexicon": lexicon}


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Model from at most ``sample_rows`` labelled rows per language outside the held-out fold, taken by id hash."""
    rows = docs.where("lang is not null and text is not null").where(fold("doc_id", 5) != 0).select("doc_id", "text", "lang")
    langs = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    sample = []
    for lang in sorted(langs):
        sample += [(r["text"], lang) for r in sampled(rows.where(F.col("lang") == lang), "doc_id", sample_rows, langs[lang]).collect()]
    model = train(sample)
    give_back()  # the driver's too
    return model


def label(model: dict, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(expected number of words per row and language, words per row, marginals of the words)."""
    low = tv.LOWER[data]
    w, form, one, letters = _chain(low, off)
    keep = letters[form]
    emit = np.zeros((len(one), len(model["langs"])))
    if letters.any():
        ok = one[letters]
        emit[letters] = emissions(model, low, w.start[ok], w.end[ok], w.hash[ok])
    row = w.row[keep]
    per_row = np.bincount(row, minlength=len(off) - 1)
    mass = marginals(emit[form[keep]], per_row, model["move"])
    share = np.stack([np.bincount(row, weights=mass[:, j], minlength=len(off) - 1) for j in range(mass.shape[1])], axis=1)
    return share, per_row, mass


def _label_column(text: pa.Array, model) -> pa.Array:
    model, parts = model.value, []
    names = np.array([*model["langs"], "und"], object)
    for b in tv.chunks(iter([pa.RecordBatch.from_arrays([text], names=["text"])]), "text"):
        share, n, _ = label(model, *tv.text_buffers(b.column("text")))
        best = np.where(n > 0, share.argmax(axis=1), len(names) - 1)
        score = np.where(n > 0, np.clip(share.max(axis=1) / np.maximum(n, 1), 0, 1), 0.0)
        parts.append(pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=["lang_pred", "score"]))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """Rows of ``docs`` in struct ``doc`` plus lang_pred and score (the expected share of words in it)."""
    found = arrow_column(_label_column, "lang_pred string, score double", F.col("text"), model=docs.sparkSession.sparkContext.broadcast(model))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), found.alias("found")).select("doc", "found.*")


def known(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` without the texts whose language the model cannot tell.

    That is texts without a letter, and those of which no learned language has ``least`` times the share of words
    that it would have by chance, or ``ENOUGH`` of them: texts that switch between two or three languages stay.
    With up to three languages to learn from, only texts without a letter go.
    """
    model = fit(docs)
    share = min(ENOUGH, least / len(model["langs"])) if len(model["langs"]) > 1 else 0.0
    return predict(docs, model).where((F.col("score") > 0) & (F.col("score") >= share)).select("doc.*")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row of ``docs`` (doc_id, text, lang).

    Texts without a letter, null ones among them, are ``und`` with score 0.  Ties go to the first language by
    name.  Without labelled rows every other text is ``und`` as well.
    """
    return predict(docs.select("doc_id", "text"), fit(docs)).select(
        "doc.doc_id", (fold("doc.doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")
