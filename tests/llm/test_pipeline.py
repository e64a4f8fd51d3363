import random
import re

import corpus_pipeline
from cases import EN, sentence
from test_op05 import brute
from test_op08 import brute as groups


def write(spark, folder):
    rng = random.Random(1)
    items = [(k, sentence(rng, EN, 25)) for k in range(5)]
    docs = [(i, sentence(rng, EN, rng.randrange(30, 200)), "en", "s") for i in range(60)]
    docs += [(100, docs[3][1], "en", "s"), (101, docs[4][1] + " tail", "en", "t"), (102, None, None, None), (103, "12 34", "en", "s"), (None, sentence(rng, EN, 50), None, None)]
    docs += [(200 + k, f"{sentence(rng, EN, 80)} {items[k][1].upper()} {sentence(rng, EN, 80)}", "en", "s") for k in range(3)] + [(300, items[4][1], "en", "s")]
    docs += [(400, f"mail a.b{k}@c.org {sentence(rng, EN, 60)} from 10.0.0.{k}", "en", "s") for k in range(1)]
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_stages(spark, tmp_path):
    docs, items = write(spark, str(tmp_path))
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = df.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, df, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        df = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r[0]: r for r in df.collect()})
        if k < 4:
            assert df.columns == columns
    language, near, clean, private, packed = seen
    assert set(language) == {i for i, *_ in docs} - {102, 103}
    comp = groups([(i, t, "") for i, t, *_ in docs if i in language], 5, 80)
    assert set(near) == {i for i in language if i is None or comp[i] == i}
    assert 300 not in clean and set(clean) == set(near) - {300}
    for k in range(3):
        gone = re.sub(r"\W+", " ", items[k][1].lower())
        assert gone not in re.sub(r"\W+", " ", clean[200 + k]["text"].lower())
    assert all(clean[i]["text"] == near[i]["text"] for i in range(60) if i in near)
    assert all(not brute(r["text"]) for r in private.values()) and "[email]" in private[400]["text"]
    assert set(packed) == set(private)


def test_run_equals_the_stages(spark, tmp_path):
    write(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns[:2] == ["doc_id", "piece"] and out.select("doc_id").distinct().count() > 55


def test_null_ids_stay_and_shared_ids_have_one_survivor(spark):
    rng = random.Random(3)
    texts = [sentence(rng, EN, 60) for _ in range(8)]
    rows = [(None, texts[0], "en", "s", 1), (None, texts[1], None, "s", 1), (None, texts[1], None, "s", 1), (None, None, None, None, None)]
    rows += [(7, t, "en", "s", 1) for t in texts[2:6]] + [(8, texts[6], "en", "s", 1), (9, texts[7], "en", "b", 1), (9, texts[7], "en", "a", 1)]
    for shuffled in (rows, rows[::-1]):
        df = spark.createDataFrame(shuffled, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        out = corpus_pipeline.near_duplicates(spark, df, "")
        assert out.columns == df.columns
        got = [tuple(r) for r in out.collect()]
        none = lambda rs: sorted((r for r in rs if r[0] is None), key=str)
        assert none(got) == none(rows)
        assert sorted(r for r in got if r[0] is not None) == [(7, min(texts[2:6]), "en", "s", 1), (8, texts[6], "en", "s", 1), (9, texts[7], "en", "a", 1)]


def test_documents_without_labels_stay(spark):
    rng = random.Random(4)
    rows = [(k, sentence(rng, EN, 20), None, "s", 1) for k in range(6)] + [(8, "12 34", None, "s", 1), (9, None, None, "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.language(spark, df, "").collect()) == list(range(6))
