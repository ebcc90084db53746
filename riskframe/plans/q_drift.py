"""Drift between the two periods of the event view."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import drift as d
from riskframe.plans.registry import query
from riskframe.plans.views import staged, table

FEATURES = ["f_num", "f_shift", "f_flag", "f_user"]


def sides(spark, sf):
    both = staged(spark, sf, "v_ref_cur")
    return both.where("split = 'reference'"), both.where("split = 'current'")


def psi_sql(x, edges):
    return f"""SELECT '{x}' AS feature, sum((c - r) * ln(c / r)) AS psi FROM (
 SELECT CASE WHEN nr = 0 THEN 1e-4::DOUBLE ELSE nr / sum(nr) OVER () END AS r, CASE WHEN nc = 0 THEN 1e-4::DOUBLE ELSE nc / sum(nc) OVER () END AS c FROM (
 SELECT len(list_filter(e, lambda q: q <= {x})) AS bin, count_if(split = 'reference') AS nr, count_if(split = 'current') AS nc
 FROM v_ref_cur, ({edges}) GROUP BY bin))"""


def q_edges(x, n=10):
    qs = ", ".join(f"{i}/{n}.0::DOUBLE" for i in range(n + 1))
    return f"SELECT (list_sort(list_distinct(quantile_cont({x}, [{qs}]))))[2:-2] AS e FROM v_ref_cur WHERE split = 'reference'"


def w_edges(x, n=10):
    return f"SELECT list_transform(range(1, {n}), lambda i: lo + i * ((hi - lo) / {n})) AS e FROM (SELECT min({x})::DOUBLE AS lo, max({x})::DOUBLE AS hi FROM v_ref_cur WHERE split = 'reference')"


PSI = "psi AS (" + " UNION ALL ".join(psi_sql(x, q_edges(x)) for x in FEATURES) + ")"
LEVEL = "CASE WHEN psi IS NULL THEN 'undefined' WHEN psi < 0.10 THEN 'none' WHEN psi < 0.25 THEN 'small' ELSE 'major' END"


@query("psi_quantile", f"WITH {PSI} SELECT * FROM psi", ["v_ref_cur"], doubles="psi")
def psi_quantile(spark, sf):
    return d.psi(*sides(spark, sf), FEATURES)


@query("psi_equal_width", " UNION ALL ".join(psi_sql(x, w_edges(x)) for x in FEATURES), ["v_ref_cur"], doubles="psi")
def psi_equal_width(spark, sf):
    return d.psi(*sides(spark, sf), FEATURES, bucket_type="bins")


@query("psi_categorical", """SELECT 'f_flag' AS feature, sum((c - r) * ln(c / r)) AS psi FROM (SELECT count_if(split = 'reference') / sum(count_if(split = 'reference')) OVER () AS r,
 count_if(split = 'current') / sum(count_if(split = 'current')) OVER () AS c FROM v_ref_cur GROUP BY f_flag)""", ["v_ref_cur"], doubles="psi", digits=9)
def psi_categorical(spark, sf):
    return d.psi(*sides(spark, sf), ["f_flag"], bucket_type="categorical")


@query("drift_level", "SELECT id, p, CASE WHEN p < 0.10 THEN 'none' WHEN p < 0.25 THEN 'small' ELSE 'major' END AS level FROM v_scored", ["v_scored"], doubles="p")
def drift_level(spark, sf):
    from riskframe.plans.views import view
    return view(spark, sf, "v_scored").select("id", "p", d.drift_level(F.col("p")).alias("level"))


@query("drift_table", f"WITH {PSI} SELECT feature, psi, {LEVEL} AS drift_level FROM psi", ["v_ref_cur"], doubles="psi")
def drift_table(spark, sf):
    return d.drift_table(*sides(spark, sf), skip=["id"])


@query("drift_alert", f"""WITH {PSI}, t AS (SELECT feature, psi, {LEVEL} AS lv FROM psi), a AS (SELECT count_if(lv IN ('small', 'major'))::BIGINT AS s, count_if(lv = 'major')::BIGINT AS m, count(*) AS n FROM t)
SELECT CASE WHEN m > 0 OR s / n >= 0.3 THEN 'critical' WHEN s > 0 THEN 'warning' ELSE 'ok' END AS status, s AS drifted_features_count, m AS major_drift_features_count, s / n AS drifted_share,
 (SELECT string_agg(feature, ',' ORDER BY feature) FROM t WHERE lv IN ('small', 'major')) AS drifted_features FROM a""", ["v_ref_cur"], doubles="drifted_share")
def drift_alert(spark, sf):
    t = d.drift_alert(d.drift_table(*sides(spark, sf), skip=["id"]), stamp=False)
    return t.select("status", "drifted_features_count", "major_drift_features_count", "drifted_share", F.array_join("drifted_features.feature", ",").alias("drifted_features"))


@query("drift_counts", f"WITH {PSI} SELECT {LEVEL} AS drift_level, count(*) AS n_features FROM psi GROUP BY 1", ["v_ref_cur"])
def drift_counts(spark, sf):
    return d.level_counts(d.drift_table(*sides(spark, sf), skip=["id"]))


def gap_sql(x):
    return f"""SELECT x, lead(x) OVER (ORDER BY x) - x AS step, abs(sum(c) OVER (ORDER BY x) / sum(c) OVER () - sum(r) OVER (ORDER BY x) / sum(r) OVER ()) AS gap, sum(r) OVER () AS nr, sum(c) OVER () AS nc FROM (
 SELECT {x} AS x, count_if(split = 'reference') AS r, count_if(split = 'current') AS c FROM v_ref_cur WHERE {x} IS NOT NULL GROUP BY 1)"""


KS = "ks AS (" + " UNION ALL ".join(f"SELECT '{x}' AS feature, max(gap) AS ks, any_value(nr)::BIGINT AS n_ref, any_value(nc)::BIGINT AS n_cur FROM ({gap_sql(x)})" for x in FEATURES) + """),
kp AS (SELECT *, nr2 * ks * ks AS l2 FROM (SELECT *, n_ref::DOUBLE * n_cur / (n_ref + n_cur) AS nr2 FROM ks)),
kt AS (SELECT feature, ks, n_ref, n_cur, CASE WHEN l2 < 0.04 THEN 1.0 ELSE least(greatest(list_sum(list_transform(range(1, 101), lambda j: 2.0::DOUBLE * (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0::DOUBLE * j * j * l2))), 0), 1) END AS p_value FROM kp)"""


@query("drift_ks", f"WITH {KS} SELECT *, p_value < 0.05 AS drifted FROM kt", ["v_ref_cur"], doubles="ks p_value")
def drift_ks(spark, sf):
    return d.drift_ks(*sides(spark, sf), FEATURES)


@query("drift_wasserstein", "SELECT *, normed >= 0.1 AS drifted FROM (" + " UNION ALL ".join(
    f"SELECT '{x}' AS feature, distance, s AS ref_std, distance / greatest(s, 0.001) AS normed FROM (SELECT sum(gap * coalesce(step, 0)) AS distance FROM ({gap_sql(x)})), (SELECT stddev_pop({x}) AS s FROM v_ref_cur WHERE split = 'reference')"
    for x in FEATURES) + ")", ["v_ref_cur"], doubles="distance ref_std normed")
def drift_wasserstein(spark, sf):
    return d.drift_wasserstein(*sides(spark, sf), FEATURES)


EV = "ev AS (SELECT event_type, substr(event_type, 1, 1) AS initial, ts < TIMESTAMP '2024-01-16' AS ref FROM events)"


@query("drift_chi2", f"WITH {EV} " + " UNION ALL ".join(f"""SELECT '{x}' AS feature, sum(power(r - row * tr / n, 2) / (row * tr / n) + power(c - row * tc / n, 2) / (row * tc / n)) AS chi2, count(*) - 1 AS dof FROM (
 SELECT count_if(ref) AS r, count_if(NOT ref) AS c, count(*)::DOUBLE AS row, sum(count_if(ref)) OVER () AS tr, sum(count_if(NOT ref)) OVER () AS tc, sum(count(*)) OVER ()::DOUBLE AS n FROM ev GROUP BY {x})"""
    for x in ("event_type", "initial")), doubles="chi2")
def drift_chi2(spark, sf):
    ev = table(spark, sf, "events").select("event_type", F.substring("event_type", 1, 1).alias("initial"), "ts")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return d.drift_chi2(ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut), ["event_type", "initial"]).select("feature", "chi2", "dof")


@query("drift_dataset_share", f"""WITH {KS} SELECT count(*) AS n_columns, count_if(p_value < 0.05)::BIGINT AS n_drifted, count_if(p_value < 0.05) / count(*) AS drifted_share,
 count_if(p_value < 0.05) / count(*) >= 0.5 AS dataset_drift FROM kt""", ["v_ref_cur"], doubles="drifted_share")
def drift_dataset_share(spark, sf):
    return d.dataset_share(d.drift_ks(*sides(spark, sf), FEATURES))


@query("drift_distributions", " UNION ALL ".join(f"""SELECT '{x}' AS feature, side, bin, any_value(lo) + bin * any_value(w) AS left_edge, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY side) / any_value(w) AS density FROM (
 SELECT split AS side, lo, w, len(list_filter(list_transform(range(1, 20), lambda i: lo + i * w), lambda q: q <= v))::INTEGER AS bin FROM (
 SELECT split, least(greatest({x}, lo), hi) AS v, lo, (hi - lo) / 20 AS w FROM v_ref_cur, (SELECT quantile_cont({x}, 0.01) AS lo, quantile_cont({x}, 0.99) AS hi FROM v_ref_cur))) GROUP BY side, bin"""
    for x in ("f_num", "f_shift")), ["v_ref_cur"], doubles="left_edge density")
def drift_distributions(spark, sf):
    return d.drift_distributions(*sides(spark, sf), ["f_num", "f_shift"], bins=20)
