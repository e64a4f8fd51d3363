"""Personal data: base matches by pattern, further identifiers by bootstrapped contexts.

Base matches are the seeds.  The two words before an identifier-like token (one with a digit
or an @) are its context.  Contexts and tokens form a graph, counted over the whole corpus: a
context is as good as the share of its distinct tokens that are known, a token as its best
context.  Rounds of scoring add tokens of high-confidence contexts to the known ones; in the
end the places of tokens that became known are spans of the seeds' kind.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import textvec as tv
from .common import arrow_column, arrow_map

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")


def _bytes(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


_DIGITS = b"0123456789"
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
DIGIT, AT, DOT, PLUS = _bytes(_DIGITS), _bytes(b"@"), _bytes(b"."), _bytes(b"+")
#: per kind: bytes a match can hold, a byte it must hold, how many of those at least
CLASSES = ((_bytes(_DIGITS + _LETTERS + b"._%+-@"), AT, 1), (_bytes(_DIGITS + b"."), DOT, 3), (_bytes(_DIGITS + b" -"), DIGIT, 12), (_bytes(_DIGITS + b" ().-+"), PLUS, 1))


def luhn(digits: bytes) -> bool:
    """Digits as byte values 48..57; every second one from the right is doubled, nines cast out."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        d -= 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(run: bytes):
    """Matches of the e-mail pattern in a run of its bytes: what stands left of each @ was looked at once."""
    begin, at = 0, run.find(b"@")
    while at >= 0:
        domain = DOMAIN.match(run, at + 1) if at > begin else None
        if domain:
            yield begin, domain.end()
        begin = domain.end() if domain else at + 1
        at = run.find(b"@", begin)


def _ips(run: bytes):
    """Four groups of digits with single dots between them, each group at most 255; failing ones are passed over whole."""
    parts, k, at = run.split(b"."), 0, 0
    while k + 3 < len(parts):
        four = parts[k: k + 4]
        if all(four):
            end = at + sum(map(len, four)) + 3
            small = [p.lstrip(b"0") for p in four]
            if all(len(p) <= 3 and int(p or b"0") <= 255 for p in small):
                yield at, end
            at, k = end + 1, k + 4
        else:
            at, k = at + len(parts[k]) + 1, k + 1


def _cards(run: bytes):
    for m in CARD.finditer(run):
        digits = bytes(c for c in m[0] if 48 <= c <= 57)
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(run: bytes):
    for m in PHONE.finditer(run):
        if 9 <= sum(48 <= c <= 57 for c in m[0]) <= 15:
            yield m.span()


def base_spans(data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(row, start byte, kind, end byte) of all base matches of a chunk, sorted.

    A match lies within a run of its kind's bytes, so only runs that hold enough of the byte it needs are
    searched; inside a run the search is leftmost and non-overlapping, in time linear in the run.
    """
    found = []
    for kind, (search, (may, must, least)) in enumerate(zip((_emails, _ips, _cards, _phones), CLASSES, strict=True)):
        hold = np.concatenate([[0], np.cumsum(must[data])])
        start, end = tv.runs(may[data], off)
        some = hold[end] - hold[start] >= least
        start, end = start[some], end[some]
        row = np.searchsorted(off, start, "right") - 1
        for r, a, z in zip(row.tolist(), start.tolist(), end.tolist(), strict=True):
            found += [(r, a + x, kind, a + y) for x, y in search(data[a:z].tobytes())]
    return sorted(found)


SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
CANDIDATE = pa.struct([("context", pa.int64()), ("token", pa.int64()), ("kind", pa.int32()), ("shape", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
SPAN_DDL = "struct<start:bigint,kind:int,end:bigint>"
CANDIDATE_DDL = "struct<context:bigint,token:bigint,kind:int,shape:int,start:bigint,end:bigint>"


def shape(token: bytes) -> int:
    """Kind whose form a token has, strictly enough to be taken from context alone; -1 for none."""
    digits = sum(48 <= c <= 57 for c in token)
    if b"@" in token[1:-1]:
        return 0
    if token.count(b".") == 3 and digits >= 4 and all(c in b"0123456789." for c in token):
        return 1
    if all(c in b"0123456789()-./+" for c in token):
        return 2 if 12 <= digits <= 19 else 3 if 7 <= digits <= 11 else -1
    return -1


def _find_batches(batches):
    """Base spans of each text, and its identifier-like tokens with their contexts."""
    edge = b".,;:!?\"'()[]{}<>|*#%&$"
    like = DIGIT | AT
    for b in tv.chunks(batches, "text"):
        data, off = tv.text_buffers(b.column("text"))
        points = tv.code_points(data)
        spans = base_spans(data, off)
        w = tv.words(data, off, tv.NONSPACE)
        first = w.first
        hold = np.concatenate([[0], np.cumsum(like[data])])
        per_span, per_cand = [[] for _ in range(b.num_rows)], [[] for _ in range(b.num_rows)]
        for r, a, kind, z in spans:
            per_span[r].append({"start": int(points[a] - points[off[r]]), "kind": kind, "end": int(points[z] - points[off[r]])})
        covered = np.zeros(len(data) + 1, np.int64)
        for _, a, _, z in spans:
            covered[a] += 1
            covered[z] -= 1
        covered = np.cumsum(covered)[:-1] > 0
        # a seed's context is that of the word it begins in; other words stand for themselves
        seeds = {}
        for r, a, kind, z in spans:
            k = int(np.searchsorted(w.start, a, "right")) - 1
            seeds.setdefault(k, (r, a, kind, z))
        for k in np.flatnonzero(hold[w.end] - hold[w.start] > 0).tolist():
            r = int(w.row[k])
            if k - 2 < first[r]:
                continue  # no two words before it
            if k in seeds:
                _, a, kind, z = seeds[k]
                form = kind
            else:
                a, z = int(w.start[k]), int(w.end[k])
                if covered[a:z].any():
                    continue
                token = data[a:z].tobytes()
                left = len(token) - len(token.lstrip(edge.replace(b"(", b"")))
                token = token.strip(edge.replace(b"(", b"").replace(b")", b""))
                a, z, kind, form = a + left, a + left + len(token), -1, shape(token)
                if form < 0:
                    continue
            context = tv.ngram_hash(w.hash[k - 2: k], 2)
            token = tv.span_hash(data[a:z], np.array([0]), np.array([z - a]))
            per_cand[r].append({"context": int(context.view(np.int64)[0]), "token": int(token.view(np.int64)[0]), "kind": kind, "shape": form,
                                "start": int(points[a] - points[off[r]]), "end": int(points[z] - points[off[r]])})
        digest = [hashlib.sha256(",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in x).encode()).hexdigest() for x in per_span]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(per_span, pa.list_(SPAN)), pa.array(digest), pa.array(per_cand, pa.list_(CANDIDATE))],
                                         names=["doc_id", "text_hash", "base", "base_sha256", "candidates"])


def bootstrap(seen: DataFrame, rounds: int = 3, least: int = 5, confidence: float = 0.9) -> DataFrame:
    """(context, shape) pairs whose tokens are taken as personal data.

    ``seen``: distinct (context, token, kind, shape), kind -1 where the token is no base match.  Each round a
    context needs ``least`` distinct known tokens of a shape and at least ``confidence`` of all its tokens known
    or of that shape's best contexts; the unknown tokens of such contexts become known for the next round.
    """
    spark = seen.sparkSession
    known = cut_lineage(seen.groupBy("context", "token", "shape").agg(F.max(F.when(F.col("kind") >= 0, 1.0).otherwise(0.0)).alias("score")))
    good = spark.createDataFrame([], "context long, shape int")
    for _ in range(rounds):
        tokens = known.groupBy("token", "shape").agg(F.max("score").alias("score"))
        scored = known.drop("score").join(tokens, ["token", "shape"])
        per = scored.groupBy("context", "shape").agg(F.sum("score").alias("hit"), F.count(F.lit(1)).alias("n"))
        total = per.groupBy("context").agg(F.sum("n").alias("all"))
        good = per.join(total, "context").where((F.col("hit") >= least) & (F.col("hit") >= confidence * F.col("all"))).select(
            "context", "shape", (F.col("hit") / F.col("all")).alias("trust"))
        known = cut_lineage(scored.join(good, ["context", "shape"], "left").select(
            "context", "token", "shape", F.greatest("score", F.coalesce("trust", F.lit(0.0))).alias("score")))
    return good.select("context", "shape")


def find(docs: DataFrame, rounds: int = 3, least: int = 5, confidence: float = 0.9) -> DataFrame:
    """doc_id, text_hash, base, base_sha256, spans (base and found ones, sorted) per row of ``docs``.

    Null and empty texts have no spans.  Rows of one id and text have the same spans.  With no seeds, or none
    whose context repeats, only base spans come out.
    """
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    first = cut_lineage(arrow_map(rows, _find_batches, f"doc_id long, text_hash long, base array<{SPAN_DDL}>, base_sha256 string, candidates array<{CANDIDATE_DDL}>"))
    places = first.select("doc_id", "text_hash", F.explode("candidates").alias("c")).select("doc_id", "text_hash", "c.*")
    good = cut_lineage(bootstrap(places.select("context", "token", "kind", "shape").distinct(), rounds, least, confidence))
    extra = (places.where("kind < 0").join(good, ["context", "shape"], "left_semi")
             .select("doc_id", "text_hash", F.struct("start", F.col("shape").alias("kind"), "end").alias("s")).distinct()
             .groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("s")).alias("extra")))  # of one text
    none = F.expr(f"cast(array() as array<{SPAN_DDL}>)")
    joined = first.alias("f").join(extra.alias("e"), F.expr("f.doc_id <=> e.doc_id and f.text_hash = e.text_hash"), "left")
    return joined.select("f.doc_id", "f.text_hash", "base", "base_sha256", F.sort_array(F.concat("base", F.coalesce("extra", none))).alias("spans"))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base matches), base_sha256, spans as text, n_found per row."""
    names = F.array(*map(F.lit, KINDS))
    found = find(docs)
    count = [F.expr(f"size(filter(base, s -> s.kind = {k}))").cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    text = F.transform("spans", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", *count, "base_sha256", F.array_join(text, ",").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_found"))


def _redact_column(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts with their spans replaced; null where there is no span."""
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        at, parts = 0, []
        for s in found or ():
            if s["end"] <= at:
                continue
            parts += [text[at:max(at, s["start"])], f"[{KINDS[s['kind']]}]"]
            at = s["end"]
        out.append("".join([*parts, text[at:]]) if parts else None)
    return pa.array(out, pa.string())


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; n_chars, where there is one, follows the text."""
    found = find(docs).where(F.size("spans") > 0).select("doc_id", "text_hash", "spans").dropDuplicates(["doc_id", "text_hash"])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.alias("d").join(found.alias("f"), F.expr("d.doc.doc_id <=> f.doc_id and xxhash64(coalesce(d.doc.text, '')) = f.text_hash"), "left")
    # texts without a span do not go to Python
    new = arrow_column(_redact_column, "string", F.when(F.col("f.spans").isNotNull(), F.col("d.doc.text")), F.col("f.spans"))
    new = rows.select("d.doc", new.alias("new")).select("doc", F.coalesce("new", "doc.text").alias("text"))
    return new.select(*[F.col("text") if c == "text" else F.coalesce(F.length("text").cast(docs.schema[c].dataType), F.col(f"doc.`{c}`")).alias(c)
                        if c == "n_chars" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
