"""Label validation queries (L1-L18) with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels as lb
from ..session import cut_lineage
from ..sources.tables import rfm_cte, rfm_points
from .common import R, rounded
from .label_audit import (AMBIGUITY, CLASSES, CONTAMINATION, CUTOFF, EPS, FLAGS, LOF_K, M, MIN_SAMPLES, diagnosis,
                          relabelled)
from .registry import query

_D2 = "(rz.z0 - s.c0) * (rz.z0 - s.c0) + (rz.z1 - s.c1) * (rz.z1 - s.c1) + (rz.z2 - s.c2) * (rz.z2 - s.c2)"
_P = 2.0 / (M - 1.0)
DIAG = f"""WITH {rfm_cte('duck')},
cen AS (SELECT t.label, CAST(row_number() OVER (ORDER BY t.label) - 1 AS INTEGER) AS sid,
               avg(z0) AS c0, avg(z1) AS c1, avg(z2) AS c2 FROM rz JOIN truth t ON rz.key = t.key GROUP BY t.label),
dd AS (SELECT rz.key, s.sid, {_D2} AS d2 FROM rz, cen s),
asg AS (SELECT key, CAST(arg_min(sid, d2) AS INTEGER) AS cluster FROM dd GROUP BY key),
lab AS (SELECT asg.key, asg.cluster, t.label FROM asg JOIN truth t ON asg.key = t.key),
maj AS (SELECT cluster, label AS majority FROM (
          SELECT cluster, label, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, label) AS r
          FROM lab GROUP BY cluster, label) x WHERE r = 1),
dist AS (SELECT key, sid, sqrt(d2) AS d FROM dd),
mn AS (SELECT key, min(d) AS dmin FROM dist GROUP BY key),
inv AS (SELECT dist.key, sid, CASE WHEN dmin = 0 THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END
                                   ELSE pow(dmin / d, {_P!r}) END AS v FROM dist JOIN mn ON dist.key = mn.key),
mu AS (SELECT key, max(v) / sum(v) AS max_u FROM inv GROUP BY key),
pairs AS (SELECT a.key, b.key AS nbr,
                 sqrt((a.z0 - b.z0) * (a.z0 - b.z0) + (a.z1 - b.z1) * (a.z1 - b.z1) + (a.z2 - b.z2) * (a.z2 - b.z2)) AS dist
          FROM rz a, rz b),
deg AS (SELECT key, count(*) AS deg FROM pairs WHERE dist <= {EPS} GROUP BY key),
core AS (SELECT key FROM deg WHERE deg >= {MIN_SAMPLES}),
reach AS (SELECT DISTINCT p.key FROM pairs p JOIN core c ON p.nbr = c.key WHERE p.dist <= {EPS}),
nb AS (SELECT * FROM (SELECT key, nbr, dist, row_number() OVER (PARTITION BY key ORDER BY dist, nbr) AS rk
                      FROM pairs WHERE key <> nbr) t WHERE rk <= {LOF_K}),
kd AS (SELECT key AS nbr, dist AS kd FROM nb WHERE rk = {LOF_K}),
rd AS (SELECT nb.key, nb.nbr, greatest(kd.kd, nb.dist) AS rd FROM nb JOIN kd ON nb.nbr = kd.nbr),
lrd AS (SELECT key, 1.0 / (avg(rd) + 1e-10) AS lrd FROM rd GROUP BY key),
lofs AS (SELECT nb.key, avg(l2.lrd) / any_value(l1.lrd) AS lof_score
         FROM nb JOIN lrd l2 ON nb.nbr = l2.key JOIN lrd l1 ON nb.key = l1.key GROUP BY nb.key),
thr AS (SELECT quantile_cont(lof_score, {1.0 - CONTAMINATION!r}) AS t FROM lofs),
diag AS (SELECT lab.key, lab.label, lab.cluster, maj.majority, CAST(lab.label <> maj.majority AS INTEGER) AS flag_discord,
                mu.max_u, CAST(mu.max_u < {AMBIGUITY} AS INTEGER) AS flag_ambiguous,
                CAST(lab.key NOT IN (SELECT key FROM reach) AS INTEGER) AS flag_noise,
                lofs.lof_score, CAST(lofs.lof_score > thr.t AS INTEGER) AS flag_lof
         FROM lab JOIN maj ON lab.cluster = maj.cluster JOIN mu ON lab.key = mu.key JOIN lofs ON lab.key = lofs.key, thr),
susp AS (SELECT *, flag_discord + flag_ambiguous + flag_noise AS suspicion_score,
                CAST(flag_discord + flag_ambiguous + flag_noise >= {CUTOFF} AS INTEGER) AS is_suspect FROM diag),
rel AS (SELECT key, label AS original, CASE WHEN is_suspect = 1 THEN majority ELSE label END AS corrected, is_suspect,
               CAST((CASE WHEN is_suspect = 1 THEN majority ELSE label END) <> label AS INTEGER) AS was_changed FROM susp)
"""


@query("cluster_majority", sql=DIAG + "SELECT cluster, majority FROM maj")
def q_cluster_majority(spark, sf):
    d = diagnosis(spark, sf)
    return lb.cluster_majority(d.select("key", "cluster"), d.select("key", "label"), "key")


@query("flag_discord", sql=DIAG + "SELECT key, cluster, majority, flag_discord FROM diag")
def q_flag_discord(spark, sf):
    return diagnosis(spark, sf).select("key", "cluster", "majority", "flag_discord")


@query("lof", sql=DIAG + f"SELECT key, {R('lof_score')} AS lof_score, flag_lof FROM diag")
def q_lof(spark, sf):
    return rounded(diagnosis(spark, sf).select("key", "lof_score", "flag_lof"))


@query("flag_noise", sql=DIAG + "SELECT key, flag_noise FROM diag")
def q_flag_noise(spark, sf):
    return diagnosis(spark, sf).select("key", "flag_noise")


@query("flag_ambiguous", sql=DIAG + f"SELECT key, {R('max_u')} AS max_u, flag_ambiguous FROM diag")
def q_flag_ambiguous(spark, sf):
    return rounded(diagnosis(spark, sf).select("key", "max_u", "flag_ambiguous"))


@query("suspicion_score", sql=DIAG + "SELECT key, suspicion_score, is_suspect FROM susp")
def q_suspicion_score(spark, sf):
    return diagnosis(spark, sf).select("key", "suspicion_score", "is_suspect")


@query("score_distribution", sql=DIAG + f"""
, sc(score) AS (VALUES (0), (1), (2), (3)),
c AS (SELECT sc.score, CAST(count(susp.key) AS BIGINT) AS n FROM sc LEFT JOIN susp ON susp.suspicion_score = sc.score GROUP BY sc.score)
SELECT CAST(score AS INTEGER) AS score, n, {R('n * 100.0 / sum(n) OVER ()')} AS pct FROM c""")
def q_score_distribution(spark, sf):
    return rounded(lb.score_distribution(diagnosis(spark, sf)))


@query("relabel", sql=DIAG + "SELECT * FROM rel")
def q_relabel(spark, sf):
    return relabelled(spark, sf)


@query("transition_matrix", sql=DIAG + f"""
, cls(original) AS (VALUES {', '.join(f"('{c}')" for c in CLASSES)})
SELECT cls.original, {', '.join(f"CAST(count(CASE WHEN rel.corrected = '{c}' THEN 1 END) AS BIGINT) AS {c}" for c in CLASSES)}
FROM cls LEFT JOIN rel ON rel.original = cls.original GROUP BY cls.original""")
def q_transition_matrix(spark, sf):
    return lb.transition_matrix(relabelled(spark, sf), CLASSES)


@query("suspicion_report", sql=DIAG + f"""
SELECT susp.key, flag_discord, flag_ambiguous, flag_noise, flag_lof, suspicion_score, {R('max_u')} AS max_u,
       cluster, majority, rel.original, rel.corrected, rel.was_changed
FROM susp JOIN rel ON susp.key = rel.key""")
def q_suspicion_report(spark, sf):
    d = diagnosis(spark, sf)
    r = relabelled(spark, sf).select("key", "original", "corrected", "was_changed")
    return rounded(d.select("key", *FLAGS, "flag_lof", "suspicion_score", "max_u", "cluster", "majority").join(r, "key"))


_FR = [*FLAGS, "flag_lof", "is_suspect"]


@query("flag_rates", sql=DIAG + f"""
SELECT label, count(*) AS n, {', '.join(f"CAST(sum({c}) AS BIGINT) AS n_{c}, {R(f'avg({c}) * 100.0')} AS pct_{c}" for c in _FR)}
FROM susp GROUP BY label""")
def q_flag_rates(spark, sf):
    return rounded(lb.flag_rates(diagnosis(spark, sf), "label", [*FLAGS, "flag_lof"]))


_TRI = {"clearly_ok": "label = majority AND is_suspect = 0", "possibly_other": "label <> majority",
        "borderline": "is_suspect = 1"}


@query("triage", sql=DIAG + f"""
SELECT label, count(*) AS n, {', '.join(f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS n_{k}, "
                                        f"{R(f'avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END) * 100.0')} AS pct_{k}"
                                        for k, c in _TRI.items())}
FROM susp GROUP BY label""")
def q_triage(spark, sf):
    return rounded(lb.triage(diagnosis(spark, sf), "label"))


def _only(c):
    return " AND ".join([f"{c} = 1"] + [f"{o} = 0" for o in FLAGS if o != c])


_ONLY = ", ".join(f"CAST(sum(CASE WHEN {_only(c)} THEN 1 ELSE 0 END) AS BIGINT) AS only_{c}" for c in FLAGS)
_ONLY_SUM = " + ".join(f"only_{c}" for c in FLAGS)


@query("suspicion_reasons", sql=DIAG + f"""
, r AS (SELECT 'suspects' AS scope, count(*) AS n, {_ONLY} FROM susp WHERE is_suspect = 1
        UNION ALL
        SELECT 'flagged', count(*), {_ONLY} FROM susp WHERE {' + '.join(FLAGS)} >= 1)
SELECT scope, n, {', '.join(f'only_{c}' for c in FLAGS)}, CAST(n - ({_ONLY_SUM}) AS BIGINT) AS combined FROM r""")
def q_suspicion_reasons(spark, sf):
    return lb.suspicion_reasons(diagnosis(spark, sf), FLAGS)


@query("p_class_given_cluster", sql=DIAG + f"""
SELECT cluster, label, count(*) AS n, {R('count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY cluster)')} AS p
FROM lab GROUP BY cluster, label""")
def q_p_class_given_cluster(spark, sf):
    d = diagnosis(spark, sf)
    return rounded(lb.p_class_given_cluster(d.select("key", "cluster"), d.select("key", "label"), "key"))


@query("cluster_confusion", sql=DIAG + f"""
, cls(c) AS (VALUES {', '.join(f"('{c}')" for c in CLASSES)}),
pairs2 AS (SELECT a.c AS actual, b.c AS predicted FROM cls a, cls b),
cnt AS (SELECT label AS actual, majority AS predicted, count(*) AS n FROM diag GROUP BY 1, 2)
SELECT pairs2.actual, pairs2.predicted, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM pairs2 LEFT JOIN cnt ON pairs2.actual = cnt.actual AND pairs2.predicted = cnt.predicted""")
def q_cluster_confusion(spark, sf):
    d = diagnosis(spark, sf)
    return lb.cluster_confusion(d.select("key", "cluster"), d.select("key", "label"), "key", CLASSES)


@query("label_quality_verdict", sql=DIAG + f"""
, v AS (SELECT avg(is_suspect) * 100.0 AS avg_pct,
               coalesce(avg(CASE WHEN label = 'high' THEN flag_discord END) * 100.0, 0.0) AS pd FROM susp)
SELECT {R('avg_pct')} AS avg_pct, CASE WHEN avg_pct < 10 THEN 'promote' WHEN avg_pct < 25 THEN 'retrain'
       ELSE 'question_process' END AS tier, {R('pd')} AS pct_discord_pos_0 FROM v""")
def q_label_quality_verdict(spark, sf):
    return rounded(lb.verdict([diagnosis(spark, sf)], "label", positive="high"))


@query("class_shift", sql=DIAG + """
, b AS (SELECT original AS label, count(*) AS before FROM rel GROUP BY 1),
a AS (SELECT corrected AS label, count(*) AS after FROM rel GROUP BY 1)
SELECT coalesce(b.label, a.label) AS label, CAST(coalesce(before, 0) AS BIGINT) AS before,
       CAST(coalesce(after, 0) AS BIGINT) AS after, CAST(coalesce(after, 0) - coalesce(before, 0) AS BIGINT) AS delta
FROM b FULL JOIN a ON b.label = a.label""")
def q_class_shift(spark, sf):
    return lb.class_shift(relabelled(spark, sf))


@query("relabel_summary", sql=DIAG + f""",
lbs(label) AS (VALUES {', '.join(f"('{c}')" for c in CLASSES)}),
tr AS (SELECT a.label AS o, b.label AS c, count(rel.key) AS n FROM lbs a CROSS JOIN lbs b LEFT JOIN rel ON rel.original = a.label AND rel.corrected = b.label GROUP BY 1, 2),
s AS (SELECT count(*) AS n_total, {', '.join(f'CAST(sum({f}) AS BIGINT) AS {f}' for f in FLAGS)},
             {', '.join(f'count(*) FILTER (suspicion_score = {k}) AS score_{k}' for k in range(len(FLAGS) + 1))}, CAST(sum(is_suspect) AS BIGINT) AS n_suspect FROM susp),
c AS (SELECT CAST(sum(was_changed) AS BIGINT) AS relabeled_total, {R('avg(was_changed)')} AS relabeled_fraction FROM rel)
SELECT {CUTOFF} AS cutoff, {R(AMBIGUITY)} AS ambiguity_threshold, s.*, c.*,
       (SELECT string_agg(o || '>' || c || ':' || n, ',' ORDER BY o, c) FROM tr) AS transitions FROM s, c
""")
def q_relabel_summary(spark, sf):
    """The JSON row, parsed again."""
    d = diagnosis(spark, sf)
    j = lb.relabel_summary(d, relabelled(spark, sf), CLASSES, FLAGS, CUTOFF, AMBIGUITY)
    longs = ", ".join(f"{c} bigint" for c in ["n_total", *FLAGS, *[f"score_{k}" for k in range(len(FLAGS) + 1)], "n_suspect", "relabeled_total"])
    row = j.select(F.from_json("json", f"cutoff int, ambiguity_threshold double, {longs}, relabeled_fraction double, "
                                       "transitions array<struct<original: string, corrected: string, n: bigint>>").alias("j")).select("j.*")
    listed = F.array_join(F.transform("transitions", lambda t: F.concat(t["original"], F.lit(">"), t["corrected"], F.lit(":"), t["n"].cast("string"))), ",")
    return rounded(row.withColumn("transitions", listed))


@query("audit_without_label")
def q_audit_without_label(spark, sf):
    """L1-L6 over clusterings made from the points alone."""
    return rounded(lb.audit(cut_lineage(rfm_points(spark, sf).select("key", "x", "label")), "key", "label", len(CLASSES), EPS, MIN_SAMPLES))
