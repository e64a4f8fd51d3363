"""Small tables shared by the tests: nulls, empty and long texts, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, doc string, hits int, spans int, base int, id int, key int"
EN = "the of and that with from this which have been were their would there what about into could other than".split()
DE = "der die und das nicht mit sich auf eine dem werden haben auch nach durch wenn noch über zwischen dieser".split()


def sentence(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "er"]) for _ in range(n))


def rows(n=40, seed=1, extra=()):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words, lang = (EN, "en") if i % 2 else (DE, "de")
        out.append((i, sentence(rng, words, 30), lang))
    out += [(900, None, "en"), (901, "", None), (902, " \n\t ", "de"), (903, "12 345 !!", None), (None, sentence(rng, EN, 12), None), (904, sentence(rng, EN, 6000), "en"),
            (905, "é ü\u0000x \U0001F600 ok", None), out[3], out[3]]
    return out + list(extra)


def frame(spark, data):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "x", "x", "x", 1, 1, 1, 1, 1) for i, t, lang in data], SCHEMA)
