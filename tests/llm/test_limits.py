"""Texts made to break or stall an operator, through Spark, each under a time limit."""

import time
from contextlib import contextmanager

import pytest

from cases import frame
from tessera.llm import op02_decontaminate, op03_extract, op05_pii


@contextmanager
def within(seconds):
    began = time.time()
    yield
    assert time.time() - began < seconds


def extracted(spark, *pages):
    rows = [(k, "u", f"<article>{'word ' * 20}</article>" if p is None else p) for k, p in enumerate((None, *pages))]
    got = op03_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(got, key=lambda r: r["page_id"])][1:]


def test_long_references(spark):
    with within(60):
        got = extracted(spark, f"<article><p>a &#{'9' * 5000}; b &#{'0' * 5000}65; c &#x{'f' * 5000}; d &#x{'0' * 30}41; &amp; &eacute; &#233 &#xD800; &#1234567; &#12345678;</p></article>")
    assert got == ["a � b A c � d A & é é � � �"]


def test_cut_off_tags(spark):
    attributes = ' a="1"' * 200
    with within(60):
        got = extracted(spark, f"<article><svg></svg><p>one two three four</p></article><svg{attributes}", "<article><p>x y z w</p></article>" + "<svg></svg>" + "<svg " * 100_000,
                        "<article><p>x y z w</p></article><script/>" + "<script " * 100_000, "<article><p>x y z w</p></article><svg></svg>" + "<!--" * 100_000,
                        "<article><p>x y z w</p></article><svg></svg>" + "<svg a=' a=\" " * 50_000)
    assert got == ["one two three four"] + ["x y z w"] * 4


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "</i>" * 100_000, "<div>" * 50_000 + "<article>a b</article>" * 50_000, "a<b>" * 200_000, "<svg/>" * 100_000, "<" * 500_000, "&" * 300_000 + "&#" * 300_000])
def test_many_open_elements(spark, page):
    with within(60):
        extracted(spark, page)


def test_long_runs_without_a_match(spark):
    n = 1_000_000
    texts = ["a" * n + "@", "a@" * (n // 2), "1" * n + "...", "1." * (n // 2), "0" * 5000 + ".1.1.1", "1.1.1." + "0" * 5000 + "255 1.1.1." + "0" * 5000 + "256", "+1" + "(" * n, "+" * n, "1 " * (n // 2),
             "a@" + "b" * n, "x@" + "b." * (n // 2), "a" * n + "@b.c"]
    with within(120):
        got = {r["doc_id"]: r for r in op05_pii.personal_data(frame(spark, [(k, t, "en") for k, t in enumerate(texts)])).collect()}
    assert [got[k]["n_email"] for k in range(len(texts))] == [0] * 10 + [1, 1]
    assert [got[k]["n_ip"] for k in range(6)] == [0, 0, 0, n // 8, 1, 1]
    assert got[5]["spans"].split(",")[0] == "ip:0:5009"


def test_many_short_items(spark):
    items = spark.createDataFrame([(k, "yes") for k in range(20_000)] + [(20_000, "yes yes"), (20_001, "no")], "item_id long, text string")
    with within(120):
        got = op02_decontaminate.contamination(frame(spark, [(1, "yes " * 20_000, "en"), (2, "no", "en"), (3, "maybe", "en")]), items).collect()
    assert {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in got} == {1: (20_000, 20_001), 2: (1, 1), 3: (0, 0)}
