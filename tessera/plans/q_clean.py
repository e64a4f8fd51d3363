"""Cleaning queries (S3, C1-C18) with their SQL twins."""

from __future__ import annotations

from ..functions import columns as fc
from ..operators import clean
from ..sources.tables import LINEITEM_NULLS_SQL, MESSY_PART_SQL, lineitem_nulls, load, messy_part
from .common import R
from .registry import query

T_NULLS = f"t AS ({LINEITEM_NULLS_SQL})"
M = f"m AS ({MESSY_PART_SQL})"
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
KEYS_SQL = ", ".join(KEYS)
NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_numeric_sql(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '{NUM_RE}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


_tokens = ", ".join(f"'{t}'" for t in fc.MISSING_TOKENS)


@query("normalise_missing", sql=f"""
WITH {M} SELECT p_partkey, CASE WHEN trim(brand_raw) IN ({_tokens}) THEN NULL ELSE trim(brand_raw) END AS brand_raw FROM m
""")
def q_normalise_missing(spark, sf):
    return clean.normalise_missing(messy_part(spark, sf).select("p_partkey", "brand_raw"))


@query("to_numeric", sql=f"WITH {M} SELECT p_partkey, {R(to_numeric_sql('number_raw'))} AS number FROM m")
def q_to_numeric(spark, sf):
    from .common import rounded
    return rounded(messy_part(spark, sf).select("p_partkey", fc.to_numeric("number_raw").alias("number")))


@query("strip_thousands", sql=f"""
WITH {M} SELECT p_partkey, trim(replace(votes_raw, ',', '')) AS votes_text,
  {to_numeric_sql("trim(replace(votes_raw, ',', ''))")} AS votes FROM m
""")
def q_strip_thousands(spark, sf):
    m = messy_part(spark, sf)
    return m.select("p_partkey", fc.strip_thousands("votes_raw").alias("votes_text"),
                    fc.to_numeric(fc.strip_thousands("votes_raw")).alias("votes"))


@query("first_year", sql=f"""
WITH {M} SELECT p_partkey, CAST(nullif(regexp_extract(year_raw, '(\\d{{4}})', 1), '') AS DOUBLE) AS year FROM m
""")
def q_first_year(spark, sf):
    return messy_part(spark, sf).select("p_partkey", fc.first_year("year_raw").alias("year"))


_rsy = "split_part(regexp_replace(year_raw, '[()]', '', 'g'), '–', 1)"


@query("range_start_year", sql=f"WITH {M} SELECT p_partkey, {to_numeric_sql(_rsy)} AS year_start FROM m")
def q_range_start_year(spark, sf):
    return messy_part(spark, sf).select("p_partkey", fc.range_start_year("year_raw").alias("year_start"))


_empty = ", ".join(f"'{t}'" for t in fc.MONEY_EMPTY)


@query("parse_money", sql=f"""
WITH {M},
s AS (SELECT p_partkey, trim(money_raw) AS raw, trim(translate(trim(money_raw), '$€£,', '')) AS s FROM m),
p AS (SELECT p_partkey, raw, s, upper(regexp_extract(s, '([kKmMbB])$', 1)) AS suf,
             regexp_replace(s, '[kKmMbB]$', '') AS body FROM s)
SELECT p_partkey,
  {R(f"CASE WHEN raw IS NULL OR lower(s) IN ({_empty}) THEN NULL ELSE ({to_numeric_sql('body')}) * CASE suf WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9 ELSE 1.0 END END")} AS money
FROM p
""")
def q_parse_money(spark, sf):
    from .common import rounded
    return rounded(messy_part(spark, sf).select("p_partkey", fc.parse_money("money_raw").alias("money")))


@query("parse_money_naive", sql=f"""
WITH {M} SELECT p_partkey,
  {R(to_numeric_sql("replace(replace(replace(trim(money_raw), '$', ''), 'M', ''), 'K', '000')"))} AS money FROM m
""")
def q_parse_money_naive(spark, sf):
    from .common import rounded
    return rounded(messy_part(spark, sf).select("p_partkey", fc.parse_money("money_raw", naive=True).alias("money")))


@query("clean_text", sql=f"""
WITH {M} SELECT p_partkey, trim(regexp_replace(text_raw, '[\\r\\n]+', ' ', 'g')) AS text FROM m
""")
def q_clean_text(spark, sf):
    return messy_part(spark, sf).select("p_partkey", fc.clean_text("text_raw").alias("text"))


@query("to_datetime", sql=f"WITH {M} SELECT p_partkey, TRY_CAST(date_raw AS TIMESTAMP) AS ts FROM m")
def q_to_datetime(spark, sf):
    return messy_part(spark, sf).select("p_partkey", fc.to_datetime("date_raw").alias("ts"))


LI4 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("impute_median_fit", sql=f"""
WITH {T_NULLS}
""" + "\n UNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_filled, "
    f"{R(f'quantile_cont({c}, 0.5)')} AS value FROM t" for c in LI4))
def q_impute_median_fit(spark, sf):
    from .common import rounded
    return rounded(clean.median_fit(lineitem_nulls(spark, sf), LI4))


@query("impute_median", sql=f"""
WITH {T_NULLS}, q AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in LI4)} FROM t)
SELECT {KEYS_SQL}, {', '.join(R(f'coalesce({c}, m_{c})') + f' AS {c}' for c in LI4)} FROM t, q
""")
def q_impute_median(spark, sf):
    from .common import rounded
    t = lineitem_nulls(spark, sf).select(*KEYS, *LI4)
    return rounded(clean.impute_median(t, LI4))


@query("impute_sentinel", sql=f"""
WITH {T_NULLS} SELECT {KEYS_SQL}, coalesce(l_returnflag, '__MISSING__') AS l_returnflag FROM t
""")
def q_impute_sentinel(spark, sf):
    return clean.impute_sentinel(lineitem_nulls(spark, sf).select(*KEYS, "l_returnflag"), ["l_returnflag"])


@query("impute_mode", sql=f"""
WITH {T_NULLS},
md AS (SELECT l_returnflag AS v FROM t WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT {KEYS_SQL}, coalesce(l_returnflag, (SELECT v FROM md)) AS l_returnflag FROM t
""")
def q_impute_mode(spark, sf):
    return clean.impute_mode(lineitem_nulls(spark, sf).select(*KEYS, "l_returnflag"), ["l_returnflag"])


@query("drop_all_null", sql=f"""
WITH {M}, n AS (SELECT CASE WHEN trim(brand_raw) IN ({_tokens}) THEN NULL ELSE trim(brand_raw) END AS brand,
                       money_raw FROM m)
SELECT brand, money_raw FROM n WHERE brand IS NOT NULL OR money_raw IS NOT NULL
""")
def q_drop_all_null(spark, sf):
    m = messy_part(spark, sf).select(fc.normalise_token("brand_raw").alias("brand"), "money_raw")
    return clean.drop_all_null(m)


@query("drop_any_null", sql=f"""
WITH {T_NULLS} SELECT {KEYS_SQL}, l_quantity, l_discount FROM t WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL
""")
def q_drop_any_null(spark, sf):
    return clean.drop_any_null(lineitem_nulls(spark, sf).select(*KEYS, "l_quantity", "l_discount"),
                               ["l_quantity", "l_discount"])


@query("winsorize", sql=f"""
WITH {T_NULLS}, q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS a1, quantile_cont(l_extendedprice, 0.99) AS b1,
                             quantile_cont(l_discount, 0.01) AS a2, quantile_cont(l_discount, 0.99) AS b2 FROM t)
SELECT {KEYS_SQL},
  {R('CASE WHEN l_extendedprice < a1 THEN a1 WHEN l_extendedprice > b1 THEN b1 ELSE l_extendedprice END')} AS l_extendedprice,
  {R('CASE WHEN l_discount < a2 THEN a2 WHEN l_discount > b2 THEN b2 ELSE l_discount END')} AS l_discount
FROM t, q
""")
def q_winsorize(spark, sf):
    from .common import rounded
    t = lineitem_nulls(spark, sf).select(*KEYS, "l_extendedprice", "l_discount")
    return rounded(clean.winsorize(t, ["l_extendedprice", "l_discount"], 0.01, 0.99))


@query("remove_outliers_iqr", sql="""
WITH b AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3,
                  count(o_totalprice) AS n FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, b
WHERE o_totalprice IS NULL OR n < 100
   OR o_totalprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
""")
def q_remove_outliers_iqr(spark, sf):
    return clean.remove_outliers_iqr(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                                     "o_totalprice", 100)


@query("fill_zero", sql=f"""
WITH {T_NULLS} SELECT {KEYS_SQL}, coalesce(l_discount, 0.0) AS l_discount, coalesce(l_tax, 0.0) AS l_tax FROM t
""")
def q_fill_zero(spark, sf):
    return clean.fill_zero(lineitem_nulls(spark, sf).select(*KEYS, "l_discount", "l_tax"), ["l_discount", "l_tax"])


@query("drop_columns", sql="SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def q_drop_columns(spark, sf):
    return clean.drop_columns(load(spark, sf, "orders"), ["o_orderstatus", "o_orderdate"])
