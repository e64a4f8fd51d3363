"""Main text of web pages by a maximum-scoring subsequence of page tokens.

A page is a sequence of tags and words.  Words score positive and tags negative; how much, is
learned per kind of tag and per kind of enclosing element from pages that label themselves
(an article or main element marks their content).  One linear scan finds the contiguous
region with the largest sum.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, sampled

SAMPLE_PAGES = 400
#: what stands in a tag behind its name, taken without second thoughts, so that no text takes more than linear time
INSIDE = r"((?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)"
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)" + INSIDE + "|[^<]+|<", re.S)
#: numeric references of more digits than any code point has, but for leading zeros
LONG_NUMBER = re.compile(r"&#(?:0*+([0-9]++)|[xX]0*+([0-9a-fA-F]++));?")
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
#: elements whose content is never text; that of RAW ones holds no tags
SKIP = frozenset("script style noscript template textarea svg math iframe select object head title button canvas audio video".split())
RAW = frozenset("script style textarea title iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split())
#: elements and words in class, id or role that name what surrounds an article
AROUND = frozenset("nav header footer aside form menu dialog search".split())
AROUND_WORDS = re.compile(r"ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|side|aside|footer|header|masthead|cookies?|consent|notice|"
                          r"alert|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|comments?|disqus|replies|reply|respond|widget|pagination|"
                          r"pager|copyright|legal|skip|toolbar|navigation|complementary|contentinfo|search")
COMMENT_WORDS = re.compile(r"comments?|disqus|replies|reply|respond")
#: words that may stand beside those in a class token, as in site-footer; has-sidebar and no-sidebar tell of the page, not of the element
BESIDE = frozenset("""site page main top bottom left right primary secondary global sub mobile desktop sticky fixed post posts entry article articles story blog section area block box
bar list item items link links wrap wrapper container inner outer content body group panel row col unit slot icon icons button buttons form field title text c l u js
the my wp""".split())
ARTICLE = re.compile(r"<article[\s>]", re.I)
#: elements that end where the next of their kind begins
SIBLINGS = frozenset("p li dt dd tr td th option".split())


def named(attributes: str) -> int:
    """2 if a whole token of class, id or role names comments, 1 if one names other surroundings, else 0."""
    found = 0
    for a in ATTRIBUTE.findall(attributes):
        for token in a.strip("\"'").lower().split():
            parts = [x for x in re.split("[-_]+", token) if x]
            hits = [x for x in parts if AROUND_WORDS.fullmatch(x)]
            if hits and all(x in hits or x in BESIDE or x.isdigit() for x in parts):
                found = max(found, 2 if any(COMMENT_WORDS.fullmatch(x) for x in hits) else 1)
    return found


def decoded(text: str) -> str:
    """``text`` with its character references decoded; numbers beyond all code points become U+FFFD."""
    return html.unescape(LONG_NUMBER.sub(lambda m: "\ufffd" if len(m[1] or m[2]) > 7 else m[0] if len(m[0]) < 16 else f"&#{m[1]};" if m[1] else f"&#x{m[2]};", text))


def skipped(page: str, name: str) -> dict[int, int]:
    """Where the content of each element of a kind begins and where its end tag ends; elements without one are left out."""
    out, opened = {}, []
    for m in re.finditer(rf"<!--.*?(?:-->|\Z)|<(/?){name}(?=[\s/>])" + INSIDE + r"|(?=<body[\s>])" * (name == "head"), page, re.I | re.S):
        if m[0][-1:] not in (">", ""):  # cut off in the middle of a tag
            break
        if m[1] == "":
            if not m[2].endswith("/"):
                opened.append(m.end())
        elif opened and not m[0].startswith("<!"):
            out[opened.pop()] = m.end()
    return out


def tokenise(page: str) -> list[tuple[str, str, int, bool, int]]:
    """(kind, value, block, around, content) of each token: kind 'w' for a word, else the tag's name with + or -.

    block numbers the block element the token stands in; around is true inside menus, footers and the like;
    content numbers the self-declared article it stands in, 0 outside (without articles, the main element).
    Open paragraphs and list items end where the next begins.  A wrapper named as surroundings marks the
    articles in it, but never the one with most words; one that names comments marks all.
    """
    out: list[tuple[str, str, int, bool, int]] = []
    stack: list[tuple[str, bool, int, int, int]] = []  # name, around, content, names its own surroundings, most of those so far (forms apart: one may wrap the page)
    held: Counter = Counter()  # names on the stack
    ends: dict[str, dict[int, int]] = {}
    marked = [0]  # by article: 1 in a wrapper, 2 a comment by its own name, 3 among comments
    own = "article" if ARTICLE.search(page) else "main"
    block, pos, articles = 0, 0, 0
    around, content = False, 0
    text: list[str] = []  # may go on behind an inline tag

    def flush():
        out.extend(("w", word, block, around, content) for word in "".join(text).split())
        text.clear()

    while pos < len(page):
        m = TOKEN.match(page, pos)
        pos = m.end()
        if m[2] is None:
            if m[0][0] != "<" or m[0] == "<":
                text.append(decoded(m[0]) if "&" in m[0] else m[0])
            continue
        if m[0][-1] != ">":  # cut off in the middle of a tag
            break
        name = m[2].lower()
        if name in BLOCK or name in SKIP or name == "br":
            flush()
        if m[1]:
            if name in BLOCK:
                block += 1
            if held[name]:
                if stack[-1][3]:
                    flush()
                while True:
                    gone = stack.pop()[0]
                    held[gone] -= 1
                    if gone == name:
                        break
                around, content = stack[-1][1:3] if stack else (False, 0)
            out.append((f"-{name}", "", block, around, content))
            continue
        out.append((f"+{name}", "", block, around, content))
        if name in SKIP:
            if name in RAW:
                end = re.compile(rf"<(/?){name}(?:\s[^>]*+)?+(?:>|\Z)", re.I).search(page, pos) if m[3].endswith("/") else None
                if m[3].endswith("/") and not (end and end[1]):  # none of its own, or another begins first: it is empty
                    continue
                end = re.compile(rf"</{name}\s*>", re.I).search(page, pos)
                if not end:
                    break
                pos = end.end()
                continue
            if name not in ends:
                ends[name] = skipped(page, name)
            pos = ends[name].get(pos, pos)
            continue
        if name in BLOCK:
            block += 1
            if name in SIBLINGS and stack and stack[-1][0] == name:
                held[stack.pop()[0]] -= 1
                around, content = stack[-1][1:3] if stack else (False, 0)
        if name in VOID or m[3].endswith("/"):
            continue
        hint = named(m[3]) if m[3] else 0
        if name == own:
            if not content:
                articles += 1
                content = articles
                wrapped = stack[-1][4] if stack else 0
                marked.append(3 if wrapped == 2 else 2 if hint == 2 else wrapped)
                around, hint = False, 0
        elif name in AROUND and not hint:
            hint = int(not (name == "header" and content))
        hint = hint if name not in ("html", "body") else 0
        if hint:
            flush()
        around = around or hint > 0
        stack.append((name, around, content, hint, max(stack[-1][4] if stack else 0, hint if name != "form" else 0)))
        held[name] += 1
    flush()
    if any(marked):
        size = Counter(t[4] for t in out if t[4] and t[0] == "w" and not t[3])
        main = max((k for k in range(1, len(marked)) if marked[k] < 3), key=lambda k: (marked[k] < 2, size[k]), default=0)
        out = [(*t[:3], t[3] or marked[t[4]] > 0 and t[4] != main, t[4]) for t in out]
    return out


def kind(token: tuple) -> str:
    """What a token's weight is learned for: words and tags apart, inside and outside of surroundings."""
    k = token[0]
    return f"{'w' if k == 'w' else k}{'~' if token[3] else ''}"


def learn(pages: list[str], smooth: float = 1.0) -> dict[str, float]:
    """Weight of each kind: log odds of standing in content, on pages that declare it; words in the open are
    kept positive, surroundings and all tags negative."""
    inside, outside = {}, {}
    for page in pages:
        tokens = tokenise(page)
        if any(t[4] for t in tokens):
            for t in tokens:
                side = inside if t[4] and not t[3] else outside
                side[kind(t)] = side.get(kind(t), 0) + 1
    total_in, total_out = sum(inside.values()) + 1, sum(outside.values()) + 1
    weights = {}
    for k in inside.keys() | outside.keys():
        odds = log((inside.get(k, 0) + smooth) / total_in) - log((outside.get(k, 0) + smooth) / total_out)
        weights[k] = max(odds, 0.5) if k == "w" else min(odds, -0.02)
    weights.setdefault("w", 1.0)
    weights["w~"] = min(weights.get("w~", -1.0), -1.0)
    return weights


DEFAULT_TAG = -0.3


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the largest positive sum; the first and shortest of equals."""
    best, at, start, run, out = 0.0, 0, 0, 0.0, (0, 0)
    for at, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, at
        run += s
        if run > best:
            best, out = run, (start, at + 1)
    return out


def extract_page(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    tokens = tokenise(page)
    scores = [weights.get(kind(t), DEFAULT_TAG if t[0] != "w" else 0.0) for t in tokens]
    a, z = best_region(scores)
    # the region, and whole every declared article that it reaches into
    reached = {t[4] for t in tokens[a:z] if t[4] and t[0] == "w" and not t[3]}
    chosen = [t for i, t in enumerate(tokens) if a <= i < z or t[4] in reached]
    blocks: list[list[str]] = []
    last = None
    for t in chosen:
        if t[0] == "w" and not t[3]:
            if t[2] != last:
                blocks.append([])
                last = t[2]
            blocks[-1].append(t[1])
    return "\n".join(" ".join(b) for b in blocks)


def _extract_batches(batches, weights):
    for b in batches:
        texts = [extract_page(x.as_py(), weights) for x in b.column("html")]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights from at most ``sample_pages`` pages that hold an article or main element, taken by id hash."""
    some = pages.select("page_id", "html").where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    return learn([r["html"] for r in sampled(some, "page_id", sample_pages, some.count()).collect()])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``; null and empty pages have empty text."""
    return arrow_map(pages.select("page_id", "url", "html"), _extract_batches, "page_id long, url string, text string, n_chars long", weights=fit(pages))
