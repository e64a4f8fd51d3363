import random

from cases import EN, frame, rows, sentence
from tessera.llm import op01_license as op

LINES = [("Released under the MIT License.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
         ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC"), ("THIS WORK!! IS LICENSED!! UNDER CC BY-SA 4.0!!", "CC-BY-SA"),
         ("The code is available under the BSD 3-Clause License", "BSD"), ("Licensed under the Vendor Software Agreement 9.", "unknown"), ("the terms of the report were released on friday", None)]


def test_planted_lines(spark):
    rng = random.Random(1)
    data = []
    for i in range(160):
        line, _ = LINES[i % len(LINES)]
        data.append((i, f"{sentence(rng, EN, 20)}.\n{line}\n{sentence(rng, EN, 9)}", "en"))
    data += [(500 + i, f"{sentence(rng, EN, 40)}\n\n{sentence(rng, EN, 40)}", "en") for i in range(100)] + rows(6)
    got = op.licences(frame(spark, data)).collect()
    assert len(got) == len(data)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 160 and r["doc_id"] > 5:
            want = LINES[r["doc_id"] % len(LINES)][1]
            text = data[r["doc_id"]][1]
            assert r["families"] == (want or ""), (text, r)
            if want:
                family, a, z = r["spans"].split(":")
                assert text[int(a): int(z)] == LINES[r["doc_id"] % len(LINES)][0] and r["n_paragraphs"] == 3
        elif r["doc_id"] is None or r["doc_id"] >= 500:
            assert r["n_licensed"] == 0 and r["families"] == "" and r["probability"] == 0.0


def test_templates_are_told_apart():
    rng = random.Random(2)
    model = op.train([sentence(rng, EN, 12) for _ in range(300)])
    from tessera.llm import textvec as tv
    names = [(f, c.format(n)) for f, ts in op.TEMPLATES.items() for n in ts for c in ("Provided under {}", "Files are covered by the {}.")]
    said = [op.classify(model, w)[0] for w in tv.hash_words([t for _, t in names])]
    assert sum(s == f for s, (f, _) in zip(said, names)) >= 0.9 * len(names)


def test_empty_table(spark):
    assert op.licences(frame(spark, [])).count() == 0


WRAPPED = [
    ("# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files", "MIT"),
    (" * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions are met:", "BSD"),
    ("Redistribution and use in source\nand binary forms, with or without\nmodification, are permitted\nprovided that the following\nconditions are met:", "BSD"),
    ("// Permission to use, copy, modify, and/or distribute this software for any\n// purpose with or without fee is hereby granted", "ISC"),
    ("# Licensed under the Apache License,\n# Version 2.0", "Apache-2.0"),
    ("Distributed under the terms of the GNU General Public License,\nversion 2.", "GPL-2.0"),
    ("Distributed under the terms of the GNU General Public License,\nversion 3.", "GPL-3.0"),
]


def test_wrapped_notices(spark):
    rng = random.Random(4)
    data = [(i, f"{sentence(rng, EN, 20)}\n\n{WRAPPED[i % len(WRAPPED)][0]}\n\n{sentence(rng, EN, 20)}", "en") for i in range(7 * 6)]
    # anchors do not depend on the sample: half of the texts have the notices' own words in ordinary lines
    data += [(100 + i, f"{sentence(rng, EN, 9)} permission granted redistribution\n{sentence(rng, EN, 20)}", "en") for i in range(40)]
    for r in op.licences(frame(spark, data)).collect():
        if r["doc_id"] < 100:
            notice, family = WRAPPED[r["doc_id"] % len(WRAPPED)]
            assert r["families"] == family, (notice, r)
            _, a, z = r["spans"].split(":")
            assert data[r["doc_id"]][1][int(a): int(z)] == notice
        else:
            assert r["n_licensed"] == 0, r


def test_anchors_come_from_the_templates_alone():
    rng = random.Random(5)
    lines = [sentence(rng, EN, 12) for _ in range(100)]
    a, b = op.train(lines), op.train([f"{x} permission redistribution apache" for x in lines])
    assert (a["anchors"] == b["anchors"]).all()
