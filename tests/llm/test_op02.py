import hashlib
import random
import re

from cases import frame, rows
from tessera.llm import op02_decontaminate as op
from test_textvec import LOW

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(t):
    return re.findall(WORD, (t or "").translate(LOW))


def brute(text, items, n=10):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        s = words(item)
        k = min(n, len(s))
        for a in range(len(s) - k + 1) if k else ():
            for i in range(len(w) - k + 1):
                if w[i:i + k] == s[a:a + k]:
                    hit |= set(range(i, i + k))
                    found.add("" if name is None else str(name))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def data(seed=0, vocab="a b c d", n_items=12):
    rng = random.Random(seed)
    v = vocab.split()
    items = [(i, " ".join(rng.choice(v) for _ in range(rng.choice([0, 1, 4, 9, 10, 11, 25])))) for i in range(n_items)] + [(None, "q r s"), (3, "q r s"), (50, None), (51, "!!")]
    docs = []
    for i in range(60):
        t = [rng.choice(v + ["Z", "É,"]) for _ in range(rng.randrange(50))]
        if i % 3 == 0:
            t[10:10] = (items[rng.randrange(n_items)][1] or "").upper().split()
        docs.append((i, " ".join(t), "en"))
    return docs, items


def run(spark, docs, items, **args):
    it = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["n_words"]): tuple(r)[1:5] for r in op.contamination(frame(spark, docs), it, **args).collect()}


def test_equals_brute_force(spark):
    for seed, vocab in ((0, "a b c d"), (1, "a b"), (2, "a b c d e f g h i j")):
        docs, items = data(seed, vocab)
        items = [x for x in items if len(words(x[1])) != 1] if seed == 2 else items
        docs = docs + [x for x in rows() if x[0] is None or x[0] >= 900]
        got = run(spark, docs, items)
        for i, t, _ in docs:
            want = brute(t, items)
            assert got[i, want[0]] == want, (seed, i)


def test_several_automata_find_the_same(spark):
    docs, items = data(5)
    it = spark.createDataFrame(items, "item_id long, text string")
    one = op.hits(frame(spark, docs), it).select("doc.doc_id", "hits", "items", "n_words").collect()
    many = op.hits(frame(spark, docs), it, shard_words=20).select("doc.doc_id", "hits", "items", "n_words").collect()
    assert op.automata(it, shard_words=20).count() > 2

    def places(r):
        return {p for s in r["hits"] for p in range(s["from"], s["to"])}

    key = lambda r: r["doc_id"]
    assert [(r[0], places(r), r[2], r[3]) for r in sorted(one, key=key)] == [(r[0], places(r), r[2], r[3]) for r in sorted(many, key=key)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = run(spark, rows(4), [])
    assert got[904, 6000][:3] == (6000, 0, 0)
    assert op.contamination(frame(spark, []), none).count() == 0
    assert op.contamination(frame(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_decontaminate_cuts_spans_and_drops_covered_rows(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, "before it " + item.upper() + ", after it and more words here that are clean and stay as they were é", "en"), (2, "x " + item, "en"), (3, "clean", "en")] + [x for x in rows(4) if x[0] is None or x[0] >= 900]
    df = frame(spark, docs)
    out = op.decontaminate(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.schema.names == df.schema.names
    got = {r["doc_id"]: r for r in out.collect()}
    assert 2 not in got and got[3]["text"] == "clean" and got[900]["text"] is None
    assert got[1]["text"].startswith("before it , after it") and got[1]["n_chars"] == len(got[1]["text"])
    assert out.count() == len(docs) - 1


def test_longest_match_is_tracked():
    auto = op.SuffixAutomaton()
    for s in ([1, 2, 3, 4], [2, 3, 9], [3, 3]):
        auto.add(s)
    items, text = ([1, 2, 3, 4], [2, 3, 9], [3, 3]), [1, 2, 3, 9, 3, 3, 4, 7, 3, 4]
    subs = {tuple(s[a:b]) for s in items for a in range(len(s)) for b in range(a, len(s) + 1)}
    state = far = 0
    for i, w in enumerate(text):
        state, far = auto.step(state, far, w)
        assert far == max(k for k in range(i + 2) if tuple(text[i + 1 - k: i + 1]) in subs)
