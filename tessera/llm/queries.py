"""The registered queries of this subpackage: production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (op01_license, op02_decontaminate, op03_extract, op04_language, op05_pii, op06_packing, op07_quality, op08_minhash,
               op09_embeddings, op10_language_model, op11_conversations, op12_neighbours, op13_search)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_license.licences(table(spark, sf_dir, "documents"))


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest")


SQL["op2_decontaminate"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item, k, list_aggregate(ws[i : i + k - 1], 'string_agg', ' ') AS win
       FROM (SELECT item, ws, least(len(ws), 10) AS k, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, k, i, list_aggregate(ws[i : i + k - 1], 'string_agg', ' ') AS win
       FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, ks WHERE len(ws) >= k)),
hit AS (SELECT dw.r, dw.i, dw.k, bw.item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
it AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(it.n_items, 0) AS n_items,
       sha256(coalesce(it.items, '')) AS items_sha256, n.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)"""


@query
def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_extract.extract(table(spark, sf_dir, "pages"))


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_language.identify(table(spark, sf_dir, "documents"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op05_pii.personal_data(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


SQL["op8_minhash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_aggregate(ws[i : i + 2], 'string_agg', ' ') AS sh
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT w.doc_id, count(s.sh) AS n_shingles FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
links AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
          JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * inter >= 85 * (na.n_shingles + nb.n_shingles - inter)),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT n.doc_id, n.n_shingles, c.component_id, n.doc_id = c.component_id AS kept
FROM n JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY 1) c ON c.a = n.doc_id"""


@query
def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_language_model.score(table(spark, sf_dir, "documents"), order=LM_ORDER)


LM_ORDER = 3


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_conversations.drill(table(spark, sf_dir, "conversations"))


def _step(state: int, *ways: tuple[str, int, str, str]) -> str:
    """The lightest (c, a) of one state after a step ``x``: its own, deleted or not, or from another state (condition, state, cost, edit)."""
    own = f"CASE WHEN x = 'I' THEN s.e{state} ELSE {{'c': s.e{state}.c + 2, 'a': s.e{state}.a || 'D'}} END"
    found = [f"{{'c': CASE WHEN {when} THEN s.e{k}.c + {cost} ELSE 1000000000000000 END, 'a': s.e{k}.a || '{edit}'}}" for when, k, cost, edit in ways]
    return f"'e{state}': list_min([{', '.join([own, *found])}])"


def _ways(role: str, *sources: int) -> list[tuple[str, int, str, str]]:
    late = "CASE WHEN x[2] = 't' THEN 5 ELSE 0 END"
    keep = [(f"x[2] <> 'x' AND x[1] = '{role}'", k, late, "K") for k in sources]
    return keep if role == "s" else keep + [("x[2] IN ('o', 't')", k, f"1 + {late}", "R") for k in sources] + [("x = 'I'", k, "5", "I") for k in sources]


_STEPS = ", ".join([_step(0), _step(1, *_ways("s", 0)), _step(2, *_ways("u", 0, 1, 3)), _step(3, *_ways("a", 2))])
SQL["op11_repair"] = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT)),
         lambda a, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda v, j: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, xor(a, b)),
         4294967295), 4294967295) % 20 AS kind FROM c),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE kind <> 0)),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM d),
f AS (
  SELECT *, substr(role, 1, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault,
         coalesce(lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au'), false) AS wrong
  FROM p),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (wrong) AS illegal,
         flatten(list(['I', 'I', CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE '-' END || CASE fault WHEN '' THEN 'o' WHEN 'truncated' THEN 't' ELSE 'x' END]
                      ORDER BY place)) || ['I', 'I'] AS steps
  FROM f GROUP BY conv_id),
e AS (
  SELECT * EXCLUDE (steps), list_reduce(steps, lambda s, x: {{{_STEPS}}},
    {{'e0': {{'c': CAST(0 AS BIGINT), 'a': ''}}, 'e1': {{'c': 1000000000000000, 'a': ''}},
      'e2': {{'c': 1000000000000000, 'a': ''}}, 'e3': {{'c': 1000000000000000, 'a': ''}}}}) AS w FROM g),
b AS (SELECT * EXCLUDE (w), list_min([w.e0, w.e3]) AS best FROM e),
o AS (
  SELECT conv_id, edit, length(replace(best.a, 'D', '')) % 2 AS odd,
         length(replace(substr(best.a, 1, i), 'D', '')) - 1 AS spot,
         length(replace(substr(best.a, 1, i), 'I', '')) - 1 AS place
  FROM (SELECT conv_id, best, i, substr(best.a, i, 1) AS edit FROM (SELECT conv_id, best, unnest(range(1, length(best.a) + 1)) AS i FROM b)) WHERE edit <> 'D'),
r AS (
  SELECT o.conv_id, string_agg(CASE WHEN edit = 'K' THEN f.role WHEN (spot - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
                               CASE WHEN edit = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY spot) AS lines
  FROM o LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.place = o.place GROUP BY o.conv_id)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM i.conv_id"""


@query
def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_neighbours.nearest(table(spark, sf_dir, "embeddings"))


SQL["op12_nearest"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE len(embedding) > 0 AND NOT list_bool_or(list_transform(embedding, lambda e: e IS NULL OR NOT isfinite(e))) AND list_bool_or(list_transform(embedding, lambda e: e <> 0))),
n AS (SELECT *, list_reduce(list_transform(x, lambda e: e * e), lambda a, b: a + b) AS square FROM v),
p AS (
  SELECT q.r AS q, q.vec_id AS query_id, c.vec_id AS vec_id, c.r,
         list_reduce(list_transform(list_zip(q.x, c.x), lambda e: coalesce(e[1], 0) * coalesce(e[2], 0)), lambda a, b: a + b) / sqrt(q.square * c.square) AS score
  FROM n q JOIN n c ON c.r <> q.r WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id NULLS LAST, r) AS rank FROM p) WHERE rank <= 5"""


@query
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op13_lexical"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(ws)) AS BIGINT) AS length FROM d WHERE len(ws) > 0),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term, docs),
i AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
p AS (
  SELECT i.i, i.item_id, d.r, d.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(d.ws) * docs) // length)))) AS BIGINT) AS score
  FROM i JOIN t USING (term) JOIN w USING (term) JOIN d ON d.r = t.r CROSS JOIN s GROUP BY 1, 2, 3, 4)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM p WHERE score > 0) WHERE rank <= 50"""
