"""Licence scan: a paragraph classifier over word n-grams, with an unknown class and template confirmation.

Training paragraphs are made from licence names and notices set into usual sentences, from
sentences about licences of no known family (the unknown class) and from a bounded sample of
the corpus' own lines (no licence).  A softmax over sparse word 1- to 3-grams is fitted, its
temperature calibrated on a part held back.  A predicted family stands only if a template of
that family is found in the paragraph and the probability is high enough; else it is unknown.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .common import arrow_map, sampled

U64 = tv.U64
SAMPLE_ROWS = 400    # documents whose lines serve as examples of no licence
GRAMS = 3
SURE = 0.5           # calibrated probability below which a licence paragraph is unknown
CONFIRM = 0.6        # share of a template's word pairs that a paragraph must hold
#: words of names and notices that ordinary text is full of; every other word of theirs makes a line worth classifying
ORDINARY = frozenset("""0 1 2 3 4 5 7 v a end new use user any all and are by charge clause code common community conditions copy custom data example fee files following for
forms free general in internal international into is law met nc nd of or person provided public purpose released research sa shared software source style terms that the this to
universal version with without zero evaluation business commercial""".split())
NONE, UNKNOWN = "none", "unknown"

#: Names and notices by which the licences are known.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": ("AGPL-3.0", "AGPLv3", "GNU Affero General Public License", "GNU Affero General Public License, version 3"),
    "Apache-2.0": ("Apache-2.0", "Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache Software License 2.0"),
    "BSD": ("BSD License", "BSD-2-Clause", "BSD-3-Clause", "BSD 3-Clause License", "2-Clause BSD License", "New BSD License",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "CC-BY": ("CC BY 4.0", "CC-BY-4.0", "CC BY 3.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC-BY-NC-4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License"),
    "CC-BY-NC-SA": ("CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-ND": ("CC BY-ND 4.0", "CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-SA": ("CC BY-SA 4.0", "CC-BY-SA-4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License"),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0", "CC0 1.0 Universal", "Creative Commons Zero", "CC0 Public Domain Dedication"),
    "EPL-2.0": ("EPL-2.0", "Eclipse Public License 2.0", "Eclipse Public License, Version 2.0"),
    "GPL-2.0": ("GPL-2.0", "GPLv2", "GPL v2", "GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2"),
    "GPL-3.0": ("GPL-3.0", "GPLv3", "GPL v3", "GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3"),
    "ISC": ("ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    "LGPL": ("LGPL-2.1", "LGPL-3.0", "LGPLv3", "GNU Lesser General Public License", "GNU Lesser General Public License, version 3"),
    "MIT": ("MIT License", "The MIT License (MIT)", "MIT-style license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    "MPL-2.0": ("MPL-2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0"),
    "Unlicense": ("The Unlicense", "This is free and unencumbered software released into the public domain"),
}
CARRIERS = ("{}", "{}.", "License: {}", "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This work is licensed under {}.",
            "Distributed under the terms of the {}.", "Available under the {}", "SPDX-License-Identifier: {}", "This file is subject to the terms of the {}.", "See the {} for details.",
            "All content is published under {} unless noted otherwise.", "Code released under {}", "You may use this under the terms of {}")
#: Licences of no known family.
STRANGERS = ("Acme Public License", "Community Source License 1.1", "Example Software License Agreement", "proprietary license", "commercial license", "custom license", "a license agreement",
             "terms of the license agreement", "Vendor Evaluation License, Version 7", "Shared Source License", "Business Source License 1.1", "internal use license", "Data Use Agreement",
             "License 5.0", "Public License", "End User License Agreement", "Research License, Version 1.0")


def _grams(words: list[np.ndarray]) -> list[np.ndarray]:
    """Hashes of all 1- to GRAMS-grams of each text."""
    return [np.concatenate([tv.ngram_hash(w, n) for n in range(1, GRAMS + 1)]) for w in words]


def examples(lines: list[str], rng: np.random.Generator) -> tuple[list[str], list[str]]:
    texts, classes = [], []

    def around(text):
        if not lines or rng.random() < 0.6:
            return text
        more = " ".join(lines[rng.integers(len(lines))].split()[:12])
        return f"{more} {text}" if rng.random() < 0.5 else f"{text} {more}"

    for family, names in TEMPLATES.items():
        for name in names:
            for carrier in CARRIERS:
                texts.append(around(carrier.format(name)))
                classes.append(family)
    for name in STRANGERS:
        for carrier in CARRIERS:
            texts.append(around(carrier.format(name)))
            classes.append(UNKNOWN)
    texts += lines
    classes += [NONE] * len(lines)
    # prose without a licence that holds the notices' ordinary words
    texts += ["the terms of the work are under discussion", "this is a version of the general public opinion", "see the file for details", "you may use this", "all content is free",
              "apache is a people and a helicopter", "permission was granted to copy the documentation", "a common and creative work", "she released the bird", "licensed to drive", "released on friday",
              "the mit campus", "version 3 of the report", "version 2.0", "4.0", "by the public domain"]
    return texts, classes + [NONE] * (len(texts) - len(classes))


def train(lines: list[str], steps: int = 250, rate: float = 0.5, decay: float = 1e-4, seed: int = 9) -> dict:
    rng = np.random.default_rng(seed)
    texts, classes = examples(lines, rng)
    names = [NONE, UNKNOWN, *TEMPLATES]
    y = np.array([names.index(c) for c in classes])
    words = tv.hash_words(texts)
    grams = _grams(words)
    licence = [g for g, c in zip(grams, classes, strict=True) if c != NONE]
    vocab = np.unique(np.concatenate(licence))  # other n-grams carry no weight
    row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    flat = np.concatenate(grams)
    at = np.minimum(np.searchsorted(vocab, flat), len(vocab) - 1)
    ok = vocab[at] == flat
    pair = np.unique(row[ok] * np.int64(len(vocab)) + at[ok])
    row, at = pair // len(vocab), pair % len(vocab)
    weights, bias = np.zeros((len(vocab), len(names))), np.zeros(len(names))
    gw2, gb2 = np.full(weights.shape, 1e-6), np.full(bias.shape, 1e-6)
    held = rng.random(len(y)) < 0.2
    use = np.where(held, 0.0, 1.0)
    share = np.bincount(y, weights=use, minlength=len(names))
    use = use / np.maximum(share, 1)[y]  # classes count alike

    def scores():
        out = np.zeros((len(y), len(names)))
        for k in range(len(names)):
            out[:, k] = np.bincount(row, weights=weights[at, k], minlength=len(y)) + bias[k]
        return out

    for _ in range(steps):
        z = scores()
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= use[:, None]
        gb = p.sum(axis=0)
        gw = np.stack([np.bincount(at, weights=p[row, k], minlength=len(vocab)) for k in range(len(names))], axis=1) + decay * weights
        gw2 += gw * gw
        gb2 += gb * gb
        weights -= rate * gw / np.sqrt(gw2)
        bias -= rate * gb / np.sqrt(gb2)
    z = scores()
    test = np.flatnonzero(held)

    def loss(t):
        q = z[test] / t
        q = q - q.max(axis=1, keepdims=True)
        return -(q[np.arange(len(test)), y[test]] - np.log(np.exp(q).sum(axis=1))).mean()

    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0, 5.6), key=loss) if len(test) else 1.0
    # anchors: words without which a line is taken for no licence, unless it goes on a notice that a line break cuts
    notices = tv.hash_words([x for x in [*STRANGERS, *(t for ts in TEMPLATES.values() for t in ts), "licensed license licence SPDX copyright"]])
    anchors = np.setdiff1d(np.unique(np.concatenate(notices)), np.concatenate(tv.hash_words([" ".join(sorted(ORDINARY))])))
    pairs = [[np.unique(tv.ngram_hash(w, 2) if len(w) > 1 else tv.ngram_hash(w, 1)) for w in tv.hash_words(list(TEMPLATES[f]))] for f in TEMPLATES]
    return {"names": names, "vocab": vocab, "weights": weights / temperature, "bias": bias / temperature, "anchors": anchors, "templates": pairs,
            "pairs": np.unique(np.concatenate([t for ts in pairs for t in ts]))}


def classify(model: dict, words: np.ndarray) -> tuple[str, float]:
    """(family, unknown or none; probability) of one paragraph's word hashes."""
    grams = np.unique(_grams([words])[0])
    at = np.minimum(np.searchsorted(model["vocab"], grams), len(model["vocab"]) - 1)
    z = model["bias"] + model["weights"][at[model["vocab"][at] == grams]].sum(axis=0)
    p = np.exp(z - z.max())
    p /= p.sum()
    best = int(p.argmax())
    name = model["names"][best]
    if name in (NONE, UNKNOWN):
        return name, float(p[best])
    found = max(np.isin(t, grams, assume_unique=True).mean() for t in model["templates"][best - 2])
    return (name if found >= CONFIRM and p[best] >= SURE else UNKNOWN), float(p[best])


def wrapped(model: dict, words: np.ndarray, edge: np.ndarray, joined: np.ndarray) -> dict[int, int]:
    """First and last line of each stretch of lines that holds more of a template than its lines by themselves.

    ``edge``: per line its first word, and the end; ``joined``: lines whose next line follows at once and goes
    on with a word pair that a template holds across the line break.
    """
    out = {}
    for run in np.split(joined, np.flatnonzero(np.diff(joined) > 1) + 1):
        if len(run):
            a, z = int(run[0]), int(run[-1]) + 1
            whole = np.unique(tv.ngram_hash(words[edge[a]: edge[z + 1]], 2))
            alone = [np.unique(tv.ngram_hash(words[edge[k]: edge[k + 1]], 2)) for k in range(a, z + 1)]
            for t in (t for ts in model["templates"] for t in ts):
                held = np.isin(t, whole, assume_unique=True).mean()
                if held >= CONFIRM and held > max(np.isin(t, x, assume_unique=True).mean() for x in alone):
                    out[a] = z
                    break
    return out


PARAGRAPH = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64())])


def _scan_batches(batches, model):
    model = model.value
    for b in tv.chunks(batches, "text"):
        data, off = tv.text_buffers(b.column("text"))
        points = tv.code_points(data)
        start, end = tv.runs(data != 10, off)
        w = tv.words(data, off)
        hit = np.flatnonzero(np.isin(w.hash, model["anchors"])) if len(w.hash) else np.zeros(0, np.int64)
        line_of = np.searchsorted(start, w.start, "right") - 1
        edge = np.searchsorted(line_of, np.arange(len(start) + 1))
        cross = np.flatnonzero(np.diff(line_of) == 1)  # last words of lines whose next line has words too
        cross = cross[(start[line_of[cross] + 1] == end[line_of[cross]] + 1) & (w.row[cross] == w.row[cross + 1])]
        joined = line_of[cross[np.isin(tv.ngram_hash(w.hash, 2)[cross], model["pairs"])]] if len(cross) else cross
        last = wrapped(model, w.hash, edge, joined)
        found = [[] for _ in range(b.num_rows)]
        done = -1
        for line in np.union1d(line_of[hit], np.array(list(last), np.int64)).tolist():
            if line <= done:
                continue
            to = last.get(line, line)
            family, p = classify(model, w.hash[edge[line]: edge[to + 1]])
            if family in (NONE, UNKNOWN) and to > line:
                to = line
                family, p = classify(model, w.hash[edge[line]: edge[to + 1]])
            done = to
            if family != NONE:
                r = int(w.row[edge[line]])
                found[r].append({"start": int(points[start[line]] - points[off[r]]), "end": int(points[end[to]] - points[off[r]]), "family": family, "probability": p})
        lines = np.bincount(np.searchsorted(off, start, "right") - 1, minlength=b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lines, pa.int64()), pa.array(found, pa.list_(PARAGRAPH))], names=["doc_id", "n_paragraphs", "paragraphs"])


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Model; the examples of no licence are lines of at most ``sample_rows`` documents taken by id hash, without those that hold a template."""
    rows = docs.where("text is not null").select("doc_id", "text")
    rows = sampled(rows, "doc_id", sample_rows, rows.count()).collect()
    lines = sorted({line for r in rows for line in r["text"].split("\n") if line.strip()})
    pairs = [np.unique(tv.ngram_hash(w, 2)) for ts in TEMPLATES.values() for w in tv.hash_words(list(ts)) if len(w) > 1]
    carried = np.unique(np.concatenate(tv.hash_words(["licence license licensed SPDX"])))

    def clean(words):
        grams = tv.ngram_hash(words, 2)
        return not np.isin(words, carried).any() and not any(np.isin(t, grams).all() for t in pairs)

    return train([x for x, w in zip(lines, tv.hash_words(lines), strict=True) if len(w) and clean(w)])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, paragraphs (start, end, family, probability of each licence paragraph) per row of ``docs``.

    A paragraph is a line, or adjacent lines over which a name or notice is wrapped (``n_paragraphs`` counts
    lines); positions are code points.  Null and empty texts have none.  Families are SPDX-like
    names or ``unknown``.  Ties go to the class named first.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))
    return arrow_map(docs.select("doc_id", "text"), _scan_batches,
                     "doc_id long, n_paragraphs long, paragraphs array<struct<start:bigint,end:bigint,family:string,probability:double>>", model=model)


def licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_licensed, families (distinct, sorted, comma-joined), spans, probability (the best) per row."""
    text = F.transform("paragraphs", lambda p: F.concat_ws(":", p["family"], p["start"].cast("string"), p["end"].cast("string")))
    return scan(docs).select(
        "doc_id", "n_paragraphs", F.size("paragraphs").cast("long").alias("n_licensed"),
        F.array_join(F.sort_array(F.array_distinct(F.col("paragraphs.family"))), ",").alias("families"), F.array_join(text, ",").alias("spans"),
        F.coalesce(F.array_max("paragraphs.probability"), F.lit(0.0)).alias("probability"))
