"""Profiling queries (P1-P18) with their SQL twins."""

from __future__ import annotations

from ..operators import clean, profile
from ..sources.tables import LINEITEM_NULLS_SQL, LINEITEM_NUMERIC, lineitem_nulls, load
from .common import R, hash_unit_sql, rounded, union_sql
from .registry import query

LI = LINEITEM_NUMERIC
LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LI, "l_returnflag", "l_linestatus",
          "l_shipdate"]
T_NULLS = f"t AS ({LINEITEM_NULLS_SQL})"

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]
GROUPS = {"amounts": ["l_extendedprice", "l_quantity"], "rates": ["l_discount", "l_tax"]}


@query("profile_shape", sql="""
SELECT count(*) AS n_rows, 11 AS n_cols, 8 AS n_numeric, 3 AS n_other FROM lineitem
""")
def q_profile_shape(spark, sf):
    return profile.profile_shape(load(spark, sf, "lineitem"))


_null_cols = ",\n".join(f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}" for c in LI_ALL)
_null_long = union_sql(f"  SELECT '{c}' AS \"column\", CAST({c} AS BIGINT) AS n_null, n FROM s" for c in LI_ALL)


@query("null_report", sql=f"""
WITH {T_NULLS},
s AS (SELECT count(*) AS n, {_null_cols} FROM t),
l AS ({_null_long})
SELECT "column", n_null, {R('n_null * 100.0 / n')} AS pct_null, {R(f'n_null * 100.0 / (n * {len(LI_ALL)})')} AS pct_cells
FROM l WHERE n_null > 0
""")
def q_null_report(spark, sf):
    return rounded(profile.null_report(lineitem_nulls(spark, sf)))


def _iqr_sql(src: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(f"""  SELECT '{c}' AS "column", lo, hi,
           CAST((SELECT count(*) FROM {src} WHERE {c} < lo OR {c} > hi) AS BIGINT) AS n_outliers
    FROM (SELECT quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
                 quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi
          FROM {src}) b""")
    return union_sql(parts)


@query("iqr_outlier_report", sql=f"""
SELECT "column", {R('lo')} AS lower, {R('hi')} AS upper, n_outliers FROM ({_iqr_sql('lineitem', LI)}) x
""")
def q_iqr_outlier_report(spark, sf):
    return rounded(clean.iqr_outlier_report(load(spark, sf, "lineitem"), LI))


@query("duplicate_count", sql="""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_returnflag, l_linestatus, l_quantity) g
""")
def q_duplicate_count(spark, sf):
    return profile.duplicate_count(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity"])


_describe_parts = union_sql(f"""  SELECT '{c}' AS "column", count({c}) AS count, {R(f'avg({c})')} AS mean,
         {R(f'stddev_samp({c})')} AS std, {R(f'min({c})')} AS min,
         {R(f'quantile_cont({c}, 0.25)')} AS q25, {R(f'quantile_cont({c}, 0.5)')} AS q50,
         {R(f'quantile_cont({c}, 0.75)')} AS q75, {R(f'max({c})')} AS max FROM t""" for c in LI)


@query("describe", sql=f"WITH {T_NULLS} {_describe_parts}")
def q_describe(spark, sf):
    return rounded(profile.describe(lineitem_nulls(spark, sf), LI))


_ct_parts = union_sql(f"""  SELECT '{c}' AS "column", {R(f'avg({c})')} AS mean, {R(f'quantile_cont({c}, 0.5)')} AS median,
         (SELECT {R(c)} FROM t WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode
  FROM t""" for c in LI)


@query("central_tendency", sql=f"WITH {T_NULLS} {_ct_parts}")
def q_central_tendency(spark, sf):
    return rounded(profile.central_tendency(lineitem_nulls(spark, sf), LI))


_disp_parts = union_sql(f"""  SELECT '{c}' AS "column", {R(f'stddev_samp({c})')} AS std, {R(f'var_samp({c})')} AS var,
         {R(f'min({c})')} AS min, {R(f'max({c})')} AS max FROM t""" for c in LI)


@query("dispersion", sql=f"WITH {T_NULLS} {_disp_parts}")
def q_dispersion(spark, sf):
    return rounded(profile.dispersion(lineitem_nulls(spark, sf), LI))


_skew_parts = union_sql(f"""  SELECT '{c}' AS "column", {R(f'skewness({c})')} AS skew FROM t""" for c in LI)


@query("skewness", sql=f"WITH {T_NULLS} {_skew_parts}")
def q_skewness(spark, sf):
    return rounded(profile.skewness(lineitem_nulls(spark, sf), LI))


_gd_parts = union_sql(f"""  SELECT '{g}' AS grp, '{c}' AS "column", {R(f'avg({c})')} AS mean, {R(f'stddev_samp({c})')} AS std,
         {R(f'min({c})')} AS min, {R(f'max({c})')} AS max FROM t""" for g, cs in GROUPS.items() for c in cs)


@query("group_describe", sql=f"WITH {T_NULLS} {_gd_parts}")
def q_group_describe(spark, sf):
    return rounded(profile.group_describe(lineitem_nulls(spark, sf), GROUPS))


_prio_values = ", ".join(f"('{p}', {i})" for i, p in enumerate(PRIORITIES))


@query("class_distribution", sql=f"""
WITH dim(label, ord) AS (VALUES {_prio_values}),
c AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1),
j AS (SELECT d.label, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM dim d LEFT JOIN c ON d.label = c.label)
SELECT label, n, {R('n * 100.0 / sum(n) OVER ()')} AS pct,
       n = min(CASE WHEN n > 0 THEN n END) OVER () AS is_minority
FROM j
""")
def q_class_distribution(spark, sf):
    return rounded(profile.class_distribution(load(spark, sf, "orders"), "o_orderpriority", PRIORITIES))


def _corr_sql(a, b):
    return f"corr({a}, {b})"


_corr_parts = []
for i, a in enumerate(LI):
    for b in LI:
        if a == b:
            _corr_parts.append(f"  SELECT '{a}' AS col_a, '{b}' AS col_b, "
                               f"CASE WHEN stddev_samp({a}) > 0 THEN 1.0 END AS r FROM t")
        else:
            _corr_parts.append(f"  SELECT '{a}' AS col_a, '{b}' AS col_b, {R(_corr_sql(a, b))} AS r FROM t")


@query("correlation_matrix", sql=f"WITH {T_NULLS} {union_sql(_corr_parts)}")
def q_correlation_matrix(spark, sf):
    return rounded(profile.correlation(lineitem_nulls(spark, sf), LI))


_cwt = [c for c in LI if c != "l_extendedprice"]
_cwt_parts = union_sql(f"  SELECT '{c}' AS \"column\", corr(l_extendedprice, {c}) AS r FROM t" for c in _cwt)


@query("corr_with_target", sql=f"""
WITH {T_NULLS}, c AS ({_cwt_parts})
SELECT "column", {R('r')} AS r, CAST(row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, "column") AS INTEGER) AS rnk FROM c
""")
def q_corr_with_target(spark, sf):
    return rounded(profile.corr_with_target(lineitem_nulls(spark, sf), _cwt, "l_extendedprice"))


_hc_parts = union_sql(f"  SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS r FROM t"
                      for i, a in enumerate(LI) for b in LI[i + 1:])


@query("high_corr_pairs", sql=f"""
WITH {T_NULLS}, c AS ({_hc_parts})
SELECT col_a, col_b, {R('r')} AS r FROM c WHERE abs(r) >= 0.5
""")
def q_high_corr_pairs(spark, sf):
    return rounded(profile.high_corr_pairs(lineitem_nulls(spark, sf), LI, 0.5))


@query("pair_corr", sql=f"SELECT {R('corr(l_quantity, l_extendedprice)')} AS r FROM lineitem")
def q_pair_corr(spark, sf):
    return rounded(profile.pair_corr(load(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


@query("histogram", sql=f"""
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT l_returnflag AS "by",
             CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((l_extendedprice - lo) / ((hi - lo) / 30.0)), 29) END AS INTEGER) AS bin,
             lo, hi
      FROM lineitem, r WHERE l_extendedprice IS NOT NULL)
SELECT "by", bin, {R('lo + bin * (hi - lo) / 30.0')} AS lo, {R('lo + (bin + 1) * (hi - lo) / 30.0')} AS hi, count(*) AS n
FROM b GROUP BY "by", bin, lo, hi
""")
def q_histogram(spark, sf):
    return rounded(profile.histogram(load(spark, sf, "lineitem"), "l_extendedprice", 30, by="l_returnflag"))


@query("box_stats", sql=f"""
WITH q AS (SELECT l_returnflag AS "by", quantile_cont(l_extendedprice, 0.25) AS q1,
                  quantile_cont(l_extendedprice, 0.5) AS med, quantile_cont(l_extendedprice, 0.75) AS q3
           FROM lineitem GROUP BY 1),
j AS (SELECT q.*, l_extendedprice AS x,
             l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM lineitem JOIN q ON l_returnflag = q."by")
SELECT "by", {R('any_value(q1)')} AS q1, {R('any_value(med)')} AS med, {R('any_value(q3)')} AS q3,
       {R('min(CASE WHEN inside THEN x END)')} AS lo_whisker, {R('max(CASE WHEN inside THEN x END)')} AS hi_whisker,
       CAST(sum(CASE WHEN inside THEN 0 ELSE 1 END) AS BIGINT) AS n_out
FROM j GROUP BY "by"
""")
def q_box_stats(spark, sf):
    return rounded(profile.box_stats(load(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag"))


@query("scatter_sample", sql=f"""
SELECT o_orderkey, o_totalprice, o_custkey FROM orders
WHERE o_totalprice IS NOT NULL AND o_custkey IS NOT NULL AND {hash_unit_sql('o_orderkey')} < 0.1
""")
def q_scatter_sample(spark, sf):
    return profile.scatter_sample(load(spark, sf, "orders"), "o_orderkey", "o_totalprice", "o_custkey", 0.1)


@query("preview", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_preview(spark, sf):
    return profile.preview(load(spark, sf, "orders"), "o_orderkey", 5)


_cov_parts = union_sql(f"  SELECT '{c}' AS \"column\", count({c}) AS n, {R(f'count({c}) * 100.0 / count(*)')} AS pct FROM t"
                       for c in LI_ALL)


@query("coverage", sql=f"WITH {T_NULLS} {_cov_parts}")
def q_coverage(spark, sf):
    return rounded(profile.coverage(lineitem_nulls(spark, sf), LI_ALL))
