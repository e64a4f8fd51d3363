"""Feature-engineering queries (F1-F20) with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as fc
from ..operators import features as fe
from ..operators.order import attach_row
from ..sources.tables import LINEITEM_NULLS_SQL, PANEL_SQL, load, panel, rfm_cte, rfm_points
from .common import R, rounded
from .registry import query

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_LAG = "lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
_RET = f"(o_totalprice / nullif({_LAG}, 0) - 1)"


@query("pct_change", sql=f"SELECT o_orderkey, o_custkey, {R(_RET)} AS o_totalprice_ret FROM orders")
def q_pct_change(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = fe.pct_change(o, "o_totalprice", ["o_custkey"], ["o_orderdate"], "o_orderkey")
    return rounded(r.select("o_orderkey", "o_custkey", "o_totalprice_ret"))


@query("log_return", sql=f"""
SELECT o_orderkey, {R('coalesce(CASE WHEN r > -1 THEN ln(1 + r) END, 0.0)')} AS o_totalprice_logret
FROM (SELECT o_orderkey, {_RET} AS r FROM orders) t
""")
def q_log_return(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = fe.log_return(fe.pct_change(o, "o_totalprice", ["o_custkey"], ["o_orderdate"], "o_orderkey"),
                      "o_totalprice")
    return rounded(r.select("o_orderkey", "o_totalprice_logret"))


@query("log1p_cols", sql=f"""
SELECT o_orderkey, {R('ln(1 + o_totalprice)')} AS o_totalprice_log FROM orders
""")
def q_log1p_cols(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(fe.log1p_cols(o, ["o_totalprice"]).drop("o_totalprice"))


_dummies_drop = ", ".join(f"CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS \"o_orderpriority_{p}\""
                          for p in PRIORITIES[1:])


@query("one_hot_drop_first", sql=f"SELECT o_orderkey, {_dummies_drop} FROM orders")
def q_one_hot_drop_first(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return fe.one_hot(o, "o_orderpriority", drop_first=True)


_fit_cats = [p for p in PRIORITIES if p != "5-LOW"]
_dummies_full = ", ".join(f"CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS \"o_orderpriority_{p}\""
                          for p in _fit_cats)


@query("one_hot_full", sql=f"SELECT o_orderkey, {_dummies_full} FROM orders")
def q_one_hot_full(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    train = o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "5-LOW"))
    cats = fe.categories(train, "o_orderpriority")  # fitted on train; '5-LOW' is unseen
    return fe.one_hot(o.drop("o_orderstatus"), "o_orderpriority", drop_first=False, cats=cats)


@query("label_encode", sql="""
SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type_encoded FROM part
""")
def q_label_encode(spark, sf):
    return fe.label_encode(load(spark, sf, "part").select("p_partkey", "p_type"), "p_type")


_ord_case = " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITIES))


@query("ordinal_encode", sql=f"""
SELECT o_orderkey, CASE o_orderpriority {_ord_case} END AS o_orderpriority_code,
       o_orderpriority AS decoded FROM orders
""")
def q_ordinal_encode(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    e = fe.ordinal_encode(o, "o_orderpriority", PRIORITIES)
    return e.select("o_orderkey", "o_orderpriority_code",
                    fe.ordinal_decode(F.col("o_orderpriority_code"), PRIORITIES).alias("decoded"))


@query("binary_encode", sql="SELECT p_partkey, bin(CAST(p_size AS BIGINT)) AS p_size_binary FROM part")
def q_binary_encode(spark, sf):
    return fe.binary_encode(load(spark, sf, "part").select("p_partkey", "p_size"), "p_size").drop("p_size")


_TRAIN = "o_orderdate < TIMESTAMP '1998-01-01'"


@query("standard_scale", sql=f"""
WITH f AS (SELECT avg(o_totalprice) AS a, stddev_pop(o_totalprice) AS b FROM orders WHERE {_TRAIN})
SELECT o_orderkey, {R('CASE WHEN b = 0 THEN 0.0 ELSE (o_totalprice - a) / b END')} AS o_totalprice_std FROM orders, f
""")
def q_standard_scale(spark, sf):
    o = load(spark, sf, "orders")
    train = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"))
    s = fe.standard_scale(o.select("o_orderkey", "o_totalprice"), ["o_totalprice"], fit_on=train)
    return rounded(s.drop("o_totalprice"))


@query("minmax_scale", sql=f"""
WITH f AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders WHERE {_TRAIN})
SELECT o_orderkey, {R('CASE WHEN b = a THEN 0.0 ELSE (o_totalprice - a) / (b - a) END')} AS o_totalprice_mm FROM orders, f
""")
def q_minmax_scale(spark, sf):
    o = load(spark, sf, "orders")
    train = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"))
    s = fe.minmax_scale(o.select("o_orderkey", "o_totalprice"), ["o_totalprice"], fit_on=train)
    return rounded(s.drop("o_totalprice"))


@query("poly_interactions", sql=f"""
SELECT c_custkey, {R('c_acctbal * c_nationkey')} AS c_acctbal_x_c_nationkey,
       {R('c_acctbal * len(c_name)')} AS c_acctbal_x_name_len, CAST(c_nationkey * len(c_name) AS INTEGER) AS c_nationkey_x_name_len
FROM customer
""")
def q_poly_interactions(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_nationkey",
                                            F.length("c_name").alias("name_len"))
    p = fe.poly_interactions(c, ["c_acctbal", "c_nationkey", "name_len"])
    return rounded(p.drop("c_acctbal", "c_nationkey", "name_len"))


@query("ratios", sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {R('coalesce(l_discount / nullif(l_tax, 0), 0.0)')} AS ratio,
       {R('l_tax - l_discount')} AS delta, {R('(l_discount + l_tax) / 2.0')} AS mean2
FROM lineitem
""")
def q_ratios(spark, sf):
    li = load(spark, sf, "lineitem")
    return rounded(li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             fc.safe_ratio("l_discount", "l_tax").alias("ratio"),
                             fc.delta("l_discount", "l_tax").alias("delta"),
                             fc.mean_of("l_discount", "l_tax").alias("mean2")))


@query("threshold_target", sql="""
WITH m AS (SELECT quantile_cont(o_totalprice, 0.5) AS m1, quantile_cont(CAST(o_custkey AS DOUBLE), 0.5) AS m2 FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice >= m1 AND o_custkey >= m2 THEN 1 ELSE 0 END AS target FROM orders, m
""")
def q_threshold_target(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    return fe.threshold_target(o, ["o_totalprice", "o_custkey"]).select("o_orderkey", "target")


@query("stress_label", sql=f"""
WITH p AS ({PANEL_SQL}),
l AS (SELECT *, lag(flow) OVER (PARTITION BY unit ORDER BY yr) AS prev_flow FROM p)
SELECT unit, yr, CAST((coalesce(flow < 0 AND prev_flow < 0, false) OR coalesce(liquidity < 1, false)
                         OR coalesce(cash_days < 30, false)) AS INTEGER) AS stress
FROM l
""")
def q_stress_label(spark, sf):
    s = fe.stress_label(panel(spark, sf), "unit", "yr", "flow", "liquidity", "cash_days")
    return s.select("unit", "yr", "stress")


@query("cost_income_ratio", sql=f"""
WITH p AS ({PANEL_SQL}) SELECT unit, yr, {R('cost / nullif(income, 0)')} AS cost_ratio FROM p
""")
def q_cost_income_ratio(spark, sf):
    p = panel(spark, sf)
    return rounded(p.select("unit", "yr", fe.cost_income_ratio(F.col("cost"), F.col("income")).alias("cost_ratio")))


@query("concentration", sql=f"""
SELECT o_custkey, {R('sum(o_totalprice * o_totalprice) / (sum(o_totalprice) * sum(o_totalprice))')} AS hhi
FROM orders GROUP BY o_custkey
""")
def q_concentration(spark, sf):
    return rounded(fe.concentration(load(spark, sf, "orders"), "o_custkey", "o_totalprice"))


@query("pca_project")
def q_pca_project(spark, sf):
    li = load(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("key"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    proj, _ = fe.pca_project(li, "key", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 2)
    return proj


@query("feature_groups", sql="""
SELECT g.grp, g."column", CAST(count(*) AS BIGINT) AS n
FROM (VALUES ('amounts', 'l_extendedprice'), ('amounts', 'l_quantity'), ('rates', 'l_discount'),
             ('rates', 'l_tax')) g(grp, "column"), lineitem
GROUP BY g.grp, g."column"
""")
def q_feature_groups(spark, sf):
    cat = fe.feature_groups(spark, {"amounts": ["l_extendedprice", "l_quantity"], "rates": ["l_discount", "l_tax"]})
    li = load(spark, sf, "lineitem")
    n = li.agg(F.count(F.lit(1)).alias("n"))
    return attach_row(cat, n)


def _hu(key, seed):
    from .common import hash_unit_sql
    return hash_unit_sql(key, seed)


_STD = ", ".join(f"{R(f'CASE WHEN b{i} = 0 THEN 0.0 ELSE ({c} - a{i}) / b{i} END')} AS {n}_std"
                 for i, (c, n) in enumerate([("price", "o_totalprice"), ("ret0", "o_totalprice_ret"),
                                             ("logret", "o_totalprice_logret")]))


@query("prepare_orders", sql=f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
                  CASE WHEN {_hu('o_orderkey', 5)} < 0.05 THEN NULL ELSE o_totalprice END AS p FROM orders),
m AS (SELECT quantile_cont(p, 0.5) AS med FROM o),
i AS (SELECT o.*, coalesce(p, med) AS p1 FROM o, m),
q AS (SELECT quantile_cont(p1, 0.01) AS lo, quantile_cont(p1, 0.99) AS hi FROM i),
w AS (SELECT i.*, CASE WHEN p1 < lo THEN lo WHEN p1 > hi THEN hi ELSE p1 END AS price FROM i, q),
r AS (SELECT *, price / nullif(lag(price) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 0) - 1 AS ret
      FROM w),
l AS (SELECT *, coalesce(CASE WHEN ret > -1 THEN ln(1 + ret) END, 0.0) AS logret, coalesce(ret, 0.0) AS ret0 FROM r),
s AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_hu('o_orderkey', 42)}, o_orderkey) - 1 AS rn,
             count(*) OVER (PARTITION BY o_orderpriority) AS n FROM l),
sp AS (SELECT *, CASE WHEN rn < floor(n * 0.25 + 0.5) THEN 'test' ELSE 'train' END AS split FROM s),
f AS (SELECT avg(price) AS a0, stddev_pop(price) AS b0, avg(ret0) AS a1, stddev_pop(ret0) AS b1,
             avg(logret) AS a2, stddev_pop(logret) AS b2 FROM sp WHERE split = 'train')
SELECT o_orderkey, o_custkey, o_orderstatus, {R('price')} AS o_totalprice, o_orderdate, o_orderpriority,
       {R('ret0')} AS o_totalprice_ret, {R('logret')} AS o_totalprice_logret, split, {_STD}
FROM sp, f WHERE split = 'train'
""")
def q_prepare_orders(spark, sf):
    from .prepare import prepare_orders
    return rounded(prepare_orders(spark, sf))


@query("prepare_train_fit", sql=f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
                  CASE WHEN {_hu('o_orderkey', 5)} < 0.05 THEN NULL ELSE o_totalprice END AS p,
                  row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_hu('o_orderkey', 42)}, o_orderkey) - 1
                    < floor(count(*) OVER (PARTITION BY o_orderpriority) * 0.25 + 0.5) AS test FROM orders),
m AS (SELECT quantile_cont(p, 0.5) AS med FROM o WHERE NOT test),
i AS (SELECT o.*, coalesce(p, med) AS p1 FROM o, m),
q AS (SELECT quantile_cont(p1, 0.01) AS lo, quantile_cont(p1, 0.99) AS hi FROM i WHERE NOT test),
w AS (SELECT i.*, greatest(lo, least(hi, p1)) AS price FROM i, q),
r AS (SELECT *, price / nullif(lag(price) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 0) - 1 AS ret FROM w),
sp AS (SELECT *, CASE WHEN test THEN 'test' ELSE 'train' END AS split, coalesce(CASE WHEN ret > -1 THEN ln(1 + ret) END, 0.0) AS logret, coalesce(ret, 0.0) AS ret0 FROM r),
f AS (SELECT avg(price) AS a0, stddev_pop(price) AS b0, avg(ret0) AS a1, stddev_pop(ret0) AS b1,
             avg(logret) AS a2, stddev_pop(logret) AS b2 FROM sp WHERE split = 'train')
SELECT o_orderkey, {R('price')} AS o_totalprice, split, {_STD} FROM sp, f
""")
def q_prepare_train_fit(spark, sf):
    """The prepare plan with median, winsor bounds and scaler all fitted on the train rows; every row."""
    from .prepare import prepare
    scaled = [c for c in ("o_totalprice_std", "o_totalprice_ret_std", "o_totalprice_logret_std")]
    return rounded(prepare(spark, sf, train_fit=True).select("o_orderkey", "o_totalprice", "split", *scaled))


@query("pca_first", sql=f"""WITH {rfm_cte('duck')},
c AS (SELECT corr(z1, z2) AS r FROM rz) SELECT key, {R('(z1 + z2) / sqrt(2)')} AS pc1, {R('(1 + r) / 2')} AS explained_variance FROM rz, c""")
def q_pca_first(spark, sf):
    """F18 on two columns, whose first component is known in closed form (they rise together)."""
    proj, ev = fe.pca_project(rfm_points(spark, sf), "key", ["z1", "z2"], 2)
    return rounded(attach_row(proj.select("key", "pc1"), ev.where("component = 'pc1'").select("explained_variance")))


@query("shape_features", sql=f"""
SELECT p_partkey, {R('CAST(p_size AS DOUBLE) / nullif(p_retailprice, 0)')} AS p_size_per_p_retailprice,
       {R('CAST(p_size AS DOUBLE) * p_retailprice')} AS p_size_by_p_retailprice FROM part
""")
def q_shape_features(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return rounded(fe.shape_features(p, [("p_size", "p_retailprice")]).drop("p_size", "p_retailprice"))


@query("category_flag", sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus IS NULL THEN NULL WHEN o_orderstatus IN ('F') THEN 1 ELSE 0 END
       AS o_orderstatus_flag FROM orders
""")
def q_category_flag(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return fe.category_flag(o, "o_orderstatus", ["F"]).drop("o_orderstatus")


_ROLE_COLS = [("id", "l_orderkey"), ("id", "l_linenumber"), ("date", "l_shipdate"), ("target", "l_returnflag"),
              ("numeric", "l_partkey"), ("numeric", "l_suppkey"), ("numeric", "l_quantity"),
              ("numeric", "l_extendedprice"), ("numeric", "l_discount"), ("numeric", "l_tax"),
              ("categorical", "l_linestatus")]


@query("infer_roles", sql="\nUNION ALL\n".join(
    f"SELECT '{r}' AS role, '{c}' AS \"column\", count({c}) AS n_non_null FROM ({LINEITEM_NULLS_SQL}) t"
    for r, c in _ROLE_COLS))
def q_infer_roles(spark, sf):
    from ..operators.roles import infer_roles, role_table
    from ..sources.tables import lineitem_nulls
    li = lineitem_nulls(spark, sf)
    roles = infer_roles(li, id=["l_orderkey", "l_linenumber"], target=["l_returnflag"])
    return role_table(li, roles)


@query("features_of_split", sql="SELECT * EXCLUDE (o_orderpriority) FROM orders")
def q_features_of_split(spark, sf):
    """The feature side, whole."""
    from ..operators.roles import split_features_target
    return split_features_target(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority")[0]


@query("split_features_target", sql="""
SELECT o_orderkey, o_orderpriority, CAST(count(*) OVER () AS BIGINT) AS n_features_rows FROM orders
""")
def q_split_features_target(spark, sf):
    from ..operators.roles import split_features_target
    x, y = split_features_target(load(spark, sf, "orders"), "o_orderkey", "o_orderpriority")
    n = x.agg(F.count(F.lit(1)).alias("n_features_rows"))
    return attach_row(y, n)  # one-row count
