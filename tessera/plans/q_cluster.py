"""Clustering queries (K1-K20) over customer RFM points.

Oracle-checked queries use fixed centres -- the per-segment means of the
standardised points -- so both engines compute the same assignment; the
iterative solvers (k-means restarts, fuzzy c-means, subtractive, DBSCAN ids,
Ward) are registered without SQL and tested against brute force in pytest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as cl
from ..operators.distance import knn
from ..operators.lloyd import lloyd
from ..operators.projected_knn import knn_projected
from ..operators.quantile import quantile_table
from ..session import cut_lineage
from ..sources.tables import SEGMENTS, load, rfm_cte, rfm_points
from .common import R, hash_unit_sql, rounded
from .registry import query

M = 1.3
EPS = 0.35
MIN_SAMPLES = 6
K_NN = 5


def segment_centres(pts):
    """Per-segment mean of the points, in segment order (5 rows to the driver)."""
    rows = pts.groupBy("segment").agg(F.avg("z0").alias("c0"), F.avg("z1").alias("c1"), F.avg("z2").alias("c2")) \
        .orderBy("segment").collect()
    return [[r["c0"], r["c1"], r["c2"]] for r in rows]


def _assigned(spark, sf):
    pts = rfm_points(spark, sf).cache()
    centres = segment_centres(pts)
    return pts, centres, cl.assign_nearest(pts, "key", centres)


def _truth(pts):
    seg_id = F.create_map(*[x for i, s in enumerate(SEGMENTS) for x in (F.lit(s), F.lit(i))])
    return pts.select("key", seg_id[F.col("segment")].alias("label"))


_D2 = "(rz.z0 - s.c0) * (rz.z0 - s.c0) + (rz.z1 - s.c1) * (rz.z1 - s.c1) + (rz.z2 - s.c2) * (rz.z2 - s.c2)"
BASE = f"""WITH {rfm_cte('duck')},
segs AS (SELECT segment, CAST(row_number() OVER (ORDER BY segment) - 1 AS INTEGER) AS sid,
                avg(z0) AS c0, avg(z1) AS c1, avg(z2) AS c2 FROM rz GROUP BY segment),
dd AS (SELECT rz.key, s.sid, {_D2} AS d2 FROM rz, segs s),
asg AS (SELECT key, CAST(arg_min(sid, d2) AS INTEGER) AS cluster FROM dd GROUP BY key),
tr AS (SELECT rz.key, s.sid AS label FROM rz JOIN segs s ON rz.segment = s.segment)"""


@query("nearest_centre", sql=BASE + " SELECT key, cluster FROM asg")
def q_nearest_centre(spark, sf):
    return _assigned(spark, sf)[2]


@query("inertia", sql=BASE + f" SELECT {R('sum(d2)')} AS inertia FROM dd JOIN asg ON dd.key = asg.key AND dd.sid = asg.cluster")
def q_inertia(spark, sf):
    pts, centres, lab = _assigned(spark, sf)
    return rounded(cl.inertia(pts, lab, cl.centres_frame(spark, centres), "key"))


@query("cluster_sizes", sql=BASE + " SELECT cluster, count(*) AS n FROM asg GROUP BY cluster")
def q_cluster_sizes(spark, sf):
    return cl.cluster_sizes(_assigned(spark, sf)[2])


@query("cluster_centroids", sql=BASE + f"""
SELECT cluster, count(*) AS n, {R('avg(z0)')} AS c0, {R('avg(z1)')} AS c1, {R('avg(z2)')} AS c2
FROM rz JOIN asg ON rz.key = asg.key GROUP BY cluster""")
def q_cluster_centroids(spark, sf):
    pts, _, lab = _assigned(spark, sf)
    c = cl.centroids(pts, lab, "key")
    return rounded(c.select("cluster", "n", *[F.col("centre")[i].alias(f"c{i}") for i in range(3)]))


_CONT = "ct AS (SELECT asg.cluster AS a, tr.label AS b, count(*) AS nij FROM asg JOIN tr ON asg.key = tr.key GROUP BY 1, 2)"


@query("adjusted_rand", sql=BASE + f""", {_CONT},
s AS (SELECT sum(nij * (nij - 1) / 2.0) AS sij, sum(nij) AS n FROM ct),
sa AS (SELECT sum(ai * (ai - 1) / 2.0) AS sa FROM (SELECT sum(nij) AS ai FROM ct GROUP BY a) t),
sb AS (SELECT sum(bj * (bj - 1) / 2.0) AS sb FROM (SELECT sum(nij) AS bj FROM ct GROUP BY b) t)
SELECT {R('(sij - sa * sb / (n * (n - 1) / 2.0)) / ((sa + sb) / 2.0 - sa * sb / (n * (n - 1) / 2.0))')} AS ari
FROM s, sa, sb""")
def q_adjusted_rand(spark, sf):
    pts, _, lab = _assigned(spark, sf)
    return rounded(cl.adjusted_rand(lab, _truth(pts), "key"))


@query("normalised_mutual_info", sql=BASE + f""", {_CONT},
n AS (SELECT sum(nij) AS n FROM ct),
ma AS (SELECT a, sum(nij) AS ai FROM ct GROUP BY a), mb AS (SELECT b, sum(nij) AS bj FROM ct GROUP BY b),
mi AS (SELECT sum(nij / n * ln(n * nij / (ai * bj))) AS mi FROM ct JOIN ma USING (a) JOIN mb USING (b), n),
ha AS (SELECT -sum(ai / n * ln(ai / n)) AS ha FROM ma, n), hb AS (SELECT -sum(bj / n * ln(bj / n)) AS hb FROM mb, n)
SELECT {R('greatest(mi, 0) / ((ha + hb) / 2)')} AS nmi FROM mi, ha, hb""")
def q_normalised_mutual_info(spark, sf):
    pts, _, lab = _assigned(spark, sf)
    return rounded(cl.normalised_mutual_info(lab, _truth(pts), "key"))


@query("silhouette", sql=BASE + f""",
p AS (SELECT a.key, x.cluster AS ca, y.cluster AS cb,
             (a.z0 - b.z0) * (a.z0 - b.z0) + (a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2) AS d2
      FROM rz a JOIN asg x ON a.key = x.key, rz b JOIN asg y ON b.key = y.key WHERE a.key <> b.key),
own AS (SELECT key, avg(d2) AS a, count(*) AS m FROM p WHERE ca = cb GROUP BY key),
oth AS (SELECT key, min(md) AS b FROM (SELECT key, cb, avg(d2) AS md FROM p WHERE ca <> cb GROUP BY key, cb) t GROUP BY key),
s AS (SELECT asg.key, CASE WHEN own.key IS NULL THEN 0.0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END AS s
      FROM asg LEFT JOIN own ON asg.key = own.key LEFT JOIN oth ON asg.key = oth.key)
SELECT {R('avg(s)')} AS silhouette FROM s""")
def q_silhouette(spark, sf):
    pts, _, lab = _assigned(spark, sf)
    return rounded(cl.silhouette(pts, lab, "key"))


@query("silhouette_euclidean", sql=BASE + f""",
sm AS (SELECT key FROM rz ORDER BY {hash_unit_sql('key', 42)}, key LIMIT 500),
p AS (SELECT a.key, x.cluster AS ca, y.cluster AS cb,
             sqrt((a.z0 - b.z0) * (a.z0 - b.z0) + (a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2)) AS d
      FROM sm JOIN rz a ON a.key = sm.key JOIN asg x ON a.key = x.key, rz b JOIN asg y ON b.key = y.key WHERE a.key <> b.key),
own AS (SELECT key, avg(d) AS a FROM p WHERE ca = cb GROUP BY key),
oth AS (SELECT key, min(md) AS b FROM (SELECT key, cb, avg(d) AS md FROM p WHERE ca <> cb GROUP BY key, cb) t GROUP BY key)
SELECT {R('avg(CASE WHEN own.key IS NULL THEN 0.0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END)')} AS silhouette, count(*) AS n
FROM sm LEFT JOIN own ON own.key = sm.key LEFT JOIN oth ON oth.key = sm.key""")
def q_silhouette_euclidean(spark, sf):
    """500 points by hash against all points."""
    pts, _, lab = _assigned(spark, sf)
    return rounded(cl.silhouette_sample(pts, lab, "key", m=500))


@query("davies_bouldin", sql=BASE + f""",
cen AS (SELECT cluster, avg(z0) AS c0, avg(z1) AS c1, avg(z2) AS c2 FROM rz JOIN asg ON rz.key = asg.key GROUP BY cluster),
sc AS (SELECT cen.cluster, avg(sqrt((z0 - c0) * (z0 - c0) + (z1 - c1) * (z1 - c1) + (z2 - c2) * (z2 - c2))) AS s
       FROM rz JOIN asg ON rz.key = asg.key JOIN cen ON asg.cluster = cen.cluster GROUP BY cen.cluster),
pr AS (SELECT i.cluster, max((si.s + sj.s) / sqrt((i.c0 - j.c0) * (i.c0 - j.c0) + (i.c1 - j.c1) * (i.c1 - j.c1)
                                             + (i.c2 - j.c2) * (i.c2 - j.c2))) AS r
       FROM cen i JOIN cen j ON i.cluster <> j.cluster JOIN sc si ON si.cluster = i.cluster JOIN sc sj ON sj.cluster = j.cluster
       GROUP BY i.cluster)
SELECT {R('avg(r)')} AS davies_bouldin FROM pr""")
def q_davies_bouldin(spark, sf):
    pts, _, lab = _assigned(spark, sf)
    return rounded(cl.davies_bouldin(pts, lab, "key"))


_P = 2.0 / (M - 1.0)
FUZZY = BASE + f""",
dist AS (SELECT key, sid, sqrt(d2) AS d FROM dd),
mn AS (SELECT key, min(d) AS dmin FROM dist GROUP BY key),
inv AS (SELECT dist.key, sid, CASE WHEN dmin = 0 THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END
                                   ELSE pow(dmin / d, {_P!r}) END AS v FROM dist JOIN mn ON dist.key = mn.key),
u AS (SELECT key, sid, v / sum(v) OVER (PARTITION BY key) AS u FROM inv),
uw AS (SELECT key, {', '.join(f'max(CASE WHEN sid = {j} THEN u END) AS u{j}' for j in range(5))},
              max(u) AS max_u, CAST(arg_max(sid, u) AS INTEGER) AS cluster, sum(u * u) AS su2 FROM u GROUP BY key)"""


def _fuzzy(spark, sf):
    pts = rfm_points(spark, sf)
    centres = segment_centres(pts)
    u = cl.memberships(F.col("x"), centres, M)
    return pts.select("key", u.alias("u")).select("key", "u", *cl.hard_from_soft(F.col("u")))


@query("fuzzy_memberships", sql=FUZZY + f"""
SELECT key, {', '.join(f"{R(f'u{j}')} AS u{j}" for j in range(5))}, {R('max_u')} AS max_u, cluster FROM uw""")
def q_fuzzy_memberships(spark, sf):
    s = _fuzzy(spark, sf)
    return rounded(s.select("key", *[F.col("u")[j].alias(f"u{j}") for j in range(5)], "max_u", "cluster"))


@query("fpc", sql=FUZZY + f" SELECT {R('avg(su2)')} AS fpc FROM uw")
def q_fpc(spark, sf):
    return rounded(cl.fpc(_fuzzy(spark, sf)))


@query("hard_from_soft", sql=FUZZY + f"""
SELECT cluster, count(*) AS n, {R('min(max_u)')} AS min_max_u, {R('avg(max_u)')} AS mean_max_u, {R('max(max_u)')} AS max_max_u
FROM uw GROUP BY cluster""")
def q_hard_from_soft(spark, sf):
    s = _fuzzy(spark, sf)
    return rounded(s.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min("max_u").alias("min_max_u"),
                                            F.avg("max_u").alias("mean_max_u"), F.max("max_u").alias("max_max_u")))


PAIRS = f"""WITH {rfm_cte('duck')},
pairs AS (SELECT a.key, b.key AS nbr,
                 sqrt((a.z0 - b.z0) * (a.z0 - b.z0) + (a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2)) AS dist
          FROM rz a, rz b)"""


@query("knn", sql=PAIRS + f"""
SELECT key, nbr, rank, {R('dist')} AS dist FROM (
  SELECT key, nbr, dist, CAST(row_number() OVER (PARTITION BY key ORDER BY dist, nbr) AS INTEGER) AS rank FROM pairs) t
WHERE rank <= {K_NN}""")
def q_knn(spark, sf):
    pts = rfm_points(spark, sf).select("key", "x")
    return rounded(knn(pts, "key", K_NN))


@query("knn_projected")
def q_knn_projected(spark, sf):
    """Ten nearest of every embedding (64 columns) by projection trees, or of all where those find too few; tests hold them against all pairs."""
    emb = load(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    return rounded(knn_projected(emb, "vec_id", 10, or_all=True)[0])


@query("kdist_eps", sql=PAIRS + f"""
SELECT {R('quantile_cont(dist, 0.95)')} AS eps FROM (
  SELECT key, dist, row_number() OVER (PARTITION BY key ORDER BY dist, nbr) AS rank FROM pairs) t
WHERE rank = {MIN_SAMPLES}""")
def q_kdist_eps(spark, sf):
    from ..operators.distance import kdist
    pts = rfm_points(spark, sf).select("key", "x")
    kd = kdist(knn(pts, "key", MIN_SAMPLES), "key", MIN_SAMPLES)
    return rounded(quantile_table(kd, ["kdist"], [0.95]).select(F.col("q0").alias("eps")))


DBKIND = PAIRS + f""",
deg AS (SELECT key, count(*) AS deg FROM pairs WHERE dist <= {EPS} GROUP BY key),
core AS (SELECT key FROM deg WHERE deg >= {MIN_SAMPLES}),
bord AS (SELECT DISTINCT p.key FROM pairs p JOIN core c ON p.nbr = c.key WHERE p.dist <= {EPS}
         AND p.key NOT IN (SELECT key FROM core)),
kind AS (SELECT rz.key, CASE WHEN rz.key IN (SELECT key FROM core) THEN 'core'
                             WHEN rz.key IN (SELECT key FROM bord) THEN 'border' ELSE 'noise' END AS kind FROM rz)"""


@query("dbscan_kind", sql=DBKIND + " SELECT key, kind FROM kind")
def q_dbscan_kind(spark, sf):
    pts = rfm_points(spark, sf).select("key", "x")
    return cl.dbscan(pts, "key", EPS, MIN_SAMPLES).select("key", "kind")


@query("dbscan", sql=DBKIND.replace("WITH ", "WITH RECURSIVE ", 1) + f""",
cp AS (SELECT p.key, p.nbr FROM pairs p WHERE p.dist <= {EPS} AND p.key IN (SELECT key FROM core) AND p.nbr IN (SELECT key FROM core)),
r(a, b) AS (SELECT key, key FROM core UNION SELECT r.a, cp.nbr FROM r JOIN cp ON r.b = cp.key),
c AS (SELECT a AS key, min(b) AS root FROM r GROUP BY a),
ids AS (SELECT root, CAST(row_number() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT root FROM c) t),
lab AS (SELECT c.key, ids.cluster FROM c JOIN ids ON c.root = ids.root),
bl AS (SELECT p.key, min(lab.cluster) AS cluster FROM pairs p JOIN lab ON p.nbr = lab.key WHERE p.dist <= {EPS} AND p.key NOT IN (SELECT key FROM core) GROUP BY p.key)
SELECT kind.key, coalesce(lab.cluster, bl.cluster, -1) AS cluster, kind.kind FROM kind LEFT JOIN lab ON kind.key = lab.key LEFT JOIN bl ON kind.key = bl.key""")
def q_dbscan(spark, sf):
    pts = rfm_points(spark, sf).select("key", "x")
    return cl.dbscan(pts, "key", EPS, MIN_SAMPLES)


@query("kmeans")
def q_kmeans(spark, sf):
    pts = rfm_points(spark, sf).select("key", "x")
    return cl.kmeans(pts, "key", 3, n_init=15, seed=42)[0]


STEPS = 5


def _lloyd_sql() -> str:
    """``STEPS`` rounds of Lloyd's algorithm from the segments' means, one pair of tables a round, and the last assignment."""
    parts = ["cen0 AS (SELECT sid AS cluster, c0, c1, c2 FROM segs)"]
    for i in range(STEPS + 1):
        d2 = " + ".join(f"(rz.z{j} - c.c{j}) * (rz.z{j} - c.c{j})" for j in range(3))
        parts.append(f"as{i} AS (SELECT key, arg_min(cluster, d2) AS cluster, min(d2) AS d2 FROM (SELECT rz.key, c.cluster, {d2} AS d2 FROM rz, cen{i} c) t GROUP BY key)")
        if i < STEPS:
            means = ", ".join(f"coalesce(avg(rz.z{j}), c.c{j}) AS c{j}" for j in range(3))
            parts.append(f"cen{i + 1} AS (SELECT c.cluster, {means} FROM cen{i} c LEFT JOIN as{i} a ON a.cluster = c.cluster LEFT JOIN rz ON rz.key = a.key "
                         "GROUP BY c.cluster, c.c0, c.c1, c.c2)")
    return ", ".join(parts)


@query("lloyd_steps", sql=BASE + f""", {_lloyd_sql()}
SELECT cluster, {R('c0')} AS c0, {R('c1')} AS c1, {R('c2')} AS c2, (SELECT {R('sum(d2)')} FROM as{STEPS}) AS inertia FROM cen{STEPS}""")
def q_lloyd_steps(spark, sf):
    """Five rounds of the k-means solver from given centres: what its rounds do, step for step."""
    import numpy as np
    pts = rfm_points(spark, sf)
    centres, cost, _ = lloyd(pts.select("key", "x"), [np.array(segment_centres(pts))], rounds=STEPS)[0]
    rows = [(i, *map(float, c), cost) for i, c in enumerate(centres)]
    return rounded(spark.createDataFrame(rows, "cluster int, c0 double, c1 double, c2 double, inertia double"))


@query("elbow_sweep")
def q_elbow_sweep(spark, sf):
    pts = rfm_points(spark, sf).select("key", "x")
    return cl.elbow_sweep(pts, "key", range(1, 9), n_init=15)


@query("fuzzy_cmeans")
def q_fuzzy_cmeans(spark, sf):
    pts = rfm_points(spark, sf).select("key", "x")
    return cl.fuzzy_cmeans(pts, "key", 3, m=M, tol=1e-5, max_iter=1000)[0]


def _fuzzy_sql() -> str:
    """``STEPS`` rounds of fuzzy c-means from the segments' means."""
    parts = ["fc0 AS (SELECT sid AS cluster, c0, c1, c2 FROM segs)"]
    for i in range(STEPS):
        d = " + ".join(f"(rz.z{j} - c.c{j}) * (rz.z{j} - c.c{j})" for j in range(3))
        parts.append(f"fd{i} AS (SELECT rz.key, c.cluster, rz.z0, rz.z1, rz.z2, sqrt({d}) AS d FROM rz, fc{i} c)")
        parts.append(f"fv{i} AS (SELECT *, CASE WHEN min(d) OVER (PARTITION BY key) = 0 THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END "
                     f"ELSE pow(min(d) OVER (PARTITION BY key) / d, {_P!r}) END AS v FROM fd{i})")
        parts.append(f"fu{i} AS (SELECT *, pow(v / sum(v) OVER (PARTITION BY key), {M}) AS w FROM fv{i})")
        parts.append(f"fc{i + 1} AS (SELECT cluster, {', '.join(f'sum(w * z{j}) / sum(w) AS c{j}' for j in range(3))} FROM fu{i} GROUP BY cluster)")
    return ", ".join(parts)


@query("fuzzy_steps", sql=BASE + f""", {_fuzzy_sql()}
SELECT cluster, {R('c0')} AS c0, {R('c1')} AS c1, {R('c2')} AS c2 FROM fc{STEPS}""")
def q_fuzzy_steps(spark, sf):
    """Five rounds of the fuzzy c-means solver from given centres."""
    pts = rfm_points(spark, sf)
    _, centres, _ = cl.fuzzy_cmeans(pts.select("key", "x"), "key", len(SEGMENTS), m=M, init=segment_centres(pts), rounds=STEPS)
    return rounded(spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centres)], "cluster int, c0 double, c1 double, c2 double"))


@query("subtractive")
def q_subtractive(spark, sf):
    pts = rfm_points(spark, sf).select("key", "x")
    return cl.subtractive(pts, "key", ra=1.0, accept=0.4, reject=0.15, max_centres=10)[0]


def _subtractive_sql(ra: float, accept: float, centres: int) -> str:
    """Potentials over all pairs; each round's highest point leads if it reaches the accept level, and takes its share from all."""
    d2 = "(a.z0 - b.z0) * (a.z0 - b.z0) + (a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2)"
    parts = [f"pt0 AS (SELECT a.key, a.z0, a.z1, a.z2, sum(exp({-4 / ra ** 2!r} * ({d2}))) AS p FROM rz a, rz b GROUP BY a.key, a.z0, a.z1, a.z2)"]
    for i in range(centres):
        level = f" WHERE p > {accept} * (SELECT p FROM top0)" if i else ""
        parts.append(f"top{i} AS (SELECT {i} AS place, key, z0, z1, z2, p FROM (SELECT * FROM pt{i} ORDER BY p DESC, key LIMIT 1) t{level})")
        parts.append(f"pt{i + 1} AS (SELECT a.key, a.z0, a.z1, a.z2, greatest(a.p - coalesce(b.p * exp({-4 / (1.5 * ra) ** 2!r} * ({d2})), 0), 0) AS p "
                     f"FROM pt{i} a LEFT JOIN top{i} b ON true)")
    return ", ".join(parts)


@query("subtractive_centres", sql=f"WITH {rfm_cte('duck')}, {_subtractive_sql(1.0, 0.4, 10)} " + " UNION ALL ".join(
    f"SELECT place, {R('z0')} AS c0, {R('z1')} AS c1, {R('z2')} AS c2 FROM top{i}" for i in range(10)))
def q_subtractive_centres(spark, sf):
    """The centres in the order they were found."""
    pts = rfm_points(spark, sf).select("key", "x")
    centres = cl.subtractive(pts, "key", ra=1.0, accept=0.4, reject=0.15, max_centres=10)[1]
    return rounded(spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centres)], "place int, c0 double, c1 double, c2 double"))


@query("ward")
def q_ward(spark, sf):
    pts = rfm_points(spark, sf).select("key", "x")
    return cl.ward(pts, "key", 3)


def _methods(spark, sf):
    pts = cut_lineage(rfm_points(spark, sf).select("key", "x", "label"))
    p = pts.select("key", "x")
    labels = {"kmeans": cl.kmeans(p, "key", 3, n_init=15)[0],
              "fuzzy_cmeans": cl.fuzzy_cmeans(p, "key", 3, m=M, tol=1e-5, max_iter=1000)[0].select("key", "cluster"),
              "dbscan": cl.dbscan(p, "key", EPS, MIN_SAMPLES).select("key", "cluster"),
              "ward": cl.ward(p, "key", 3)}
    return pts, p, labels


@query("compare_clusterings")
def q_compare_clusterings(spark, sf):
    pts, p, labels = _methods(spark, sf)
    truth = pts.select("key", "label")
    return cl.compare_clusterings(labels, truth, p, "key")


@query("label_table")
def q_label_table(spark, sf):
    _, _, labels = _methods(spark, sf)
    return cl.label_table(labels, "key")
