import pytest

from tessera.llm import op03_extract as op

HEAD = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'
NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav><!-- note --><div class="ad">Buy this now.</div>'
FOOT = "<footer>&copy; example &middot; all rights.</footer></body></html>"
BODY = " ".join(["word and more text of the article"] * 8)
PAGES = [
    (HEAD + NAV + f"<article><h1>A &amp; B</h1><p><b>First\n  line.<br><p>{BODY}</p><p>Caf&eacute; &#8364;5</p></article>" + FOOT, f"A & B\nFirst line.\n{BODY}\nCafé €5"),
    (HEAD + NAV + f"<article><p>{BODY}</p>", BODY),
    (HEAD + NAV + f"<article><p>{BODY}</p><p>cut &am", f"{BODY}\ncut &am"),
    (HEAD + NAV + f"<article><p>{BODY}</p><p cla", BODY),
    (HEAD + f'<header>Site</header><div id="sidebar">Links here</div><main><h1>T</h1><p>{BODY}</p><aside>See also</aside><form><label>Mail</label></form></main>'
     '<section class="comments"><p>I like it very much indeed, thanks.</p></section>' + FOOT, f"T\n{BODY}"),
    (HEAD + f'<form id="page"><div class="cookie-notice">We use cookies.</div><article><header><h1>T</h1></header><p>a<b>b</b>c {BODY}</p><footer>tags</footer>'
     '<article class="comment">Nice.</article></article></form>' + FOOT, f"T\nabc {BODY}"),
    (HEAD + NAV + f"<div><p>{BODY}</p><p>{BODY}</p></div>" + FOOT, f"{BODY}\n{BODY}"),
    ("", ""), (None, ""), ("<html><body></body></html>", ""), ("<script>x", ""), (f"<article>{BODY} <script>var a = '<p>'</script> end</article>", f"{BODY} end"),
    (f"<article><p>1 < 2 and 3 > 2 {BODY}</p><table><tr><td>a<td>b</table></article>", f"1 < 2 and 3 > 2 {BODY}\na\nb"),
]


@pytest.mark.parametrize("page, want", PAGES)
def test_pages(page, want):
    weights = op.learn([p for p, _ in PAGES[:6]])
    assert op.extract_page(page, weights) == want


def test_best_region_equals_brute_force():
    import random
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.choice([-2, -1, 1, 2]) for _ in range(rng.randrange(12))]
        a, z = op.best_region(s)
        assert sum(s[a:z]) == max([0] + [sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)])


def test_words_score_positive_and_tags_negative():
    w = op.learn([p for p, _ in PAGES[:6]])
    assert w["w"] > 0 and all(v < 0 for k, v in w.items() if k != "w")
    assert op.learn([])["w"] > 0


def test_query(spark):
    data = [(i, f"http://x/{i}", p, "x", "x") for i, (p, _) in enumerate(PAGES)] + [(None, None, None, None, None), (1, "http://x/1", PAGES[1][0], "x", "x")]
    df = spark.createDataFrame(data, "page_id long, url string, html string, text string, n_chars string")
    got = op.extract(df).collect()
    assert len(got) == len(data)
    for r in got:
        want = "" if r["page_id"] is None else PAGES[r["page_id"]][1]
        assert r["text"] == want and r["n_chars"] == len(want)
    assert op.extract(spark.createDataFrame([], df.schema)).count() == 0


WHOLE = [
    (HEAD + f'<article><p>Start <svg class="icon"/> {BODY}</p><svg><path d=""/></svg><p>end</p></article>' + FOOT, f"Start {BODY}\nend"),
    (HEAD + f"<article><p>Start <button>{BODY}</p><p>end</p></article>" + FOOT, f"Start {BODY}\nend"),
    (HEAD + f"<article><p>Start</p><object data=x><p>{BODY}</p><object>gone</object><p>end</p></article>" + FOOT, f"Start\n{BODY}\nend"),
    (HEAD + f'<article><script src="a.js"/><p>{BODY}</p><script>var a;</script></article>' + FOOT, BODY),
    (HEAD + f"<article><p>{BODY}</p><script src=a/>var a;</script></article>" + FOOT, BODY),
    (HEAD + f"<!-- <script> --><article><p>{BODY}</p><script>var a;</script><p>end</p></article>" + FOOT, f"{BODY}\nend"),
    (HEAD + f'<div class="content has-sidebar"><article><p>{BODY}</p></article></div><div class="site-footer">gone</div>' + FOOT, BODY),
    (HEAD + f'<div class="no-sidebar"><div class="widget"><article><p>{BODY}</p></article></div></div>' + FOOT, BODY),
    (HEAD + f'<article><p>{BODY}</p></article><div class="related"><article><p>Another story</p></article></div>' + FOOT, BODY),
]


@pytest.mark.parametrize("page, want", WHOLE)
def test_nothing_is_cut_off(page, want):
    assert op.extract_page(page, op.learn([p for p, _ in PAGES[:6]])) == want


def test_region_and_all_its_articles():
    weights = op.learn([p for p, _ in PAGES[:6]])
    parts = "".join(f"<article><h2>Part {k}</h2><p>{BODY}</p></article>" for k in range(3))
    comments = '<section class="comments"><article><p>Nice story.</p></article></section>'
    page = HEAD + NAV + f"<main><h1>Head line of it</h1><p>Lead {BODY}</p>{parts}{comments}</main>" + FOOT
    assert op.extract_page(page, weights) == "\n".join(["Head line of it", f"Lead {BODY}", *(x for k in range(3) for x in (f"Part {k}", BODY))])
