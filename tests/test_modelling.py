"""The document table: texts are read once, and their statistics are those counted in plain Python."""

import numpy as np
import pytest

from tessera.plans import modelling


def _tables(spark, path):
    texts = ["Hello, World! 42", "", None, "ünïcode №7 ’quoted’ \n two lines", "😀 A-B [c] {d} `e` ~", " tabs\tand  spaces ", "no marks at all", "ALL CAPS 1999"]
    rows = [(i, texts[i % len(texts)], ["en", "de", "fr", "es", None][i % 5], "web", i * 7 % 50) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return {r[0]: r[1] for r in rows}


def test_texts_are_read_once_for_all_statistics(spark, tmp_path, monkeypatch):
    texts = _tables(spark, str(tmp_path))
    cuts, cut = [], modelling.cut_lineage
    monkeypatch.setattr(modelling, "cut_lineage", lambda df: cuts.append(cut(df)) or cuts[-1])
    out = modelling.doc_table(spark, str(tmp_path))
    assert out.count() == 80 and len(cuts) > 1
    first = {r["key"]: r for r in cuts[0].collect()}  # before scaling
    assert "split" not in cuts[0].columns and all("documents.parquet" not in f for f in out.inputFiles())
    marks = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
    for key, text in texts.items():
        if text is None:
            assert first[key]["digit_frac"] is None and first[key]["punct_frac"] is None
            continue
        n = max(len(text), 1)
        for name, held in (("digit_frac", "0123456789"), ("upper_frac", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("punct_frac", marks)):
            assert first[key][name] == pytest.approx(sum(c in held for c in text) / n, abs=0)
    assert np.isclose(np.mean([r["digit_frac"] for r in out.where("split = 'train' and digit_frac is not null").collect()]), 0)


def test_customer_points_are_read_from_a_cut(spark):
    from paths import SF_SMALL

    from tessera.sources.tables import rfm_points
    assert not [f for f in rfm_points(spark, SF_SMALL).inputFiles() if "orders.parquet" in f or "customer.parquet" in f]
