"""Feature selection on the applicant view."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.frames import small_table
from riskframe.operators import select as s
from riskframe.plans.registry import query
from riskframe.plans.settings import APP_NUMERIC
from riskframe.plans.views import staged, view

TARGET_CORR = "tc AS (" + " UNION ALL ".join(
    f"SELECT '{x}' AS feature, CASE WHEN isnan(corr({x}, target)) THEN NULL ELSE corr({x}, target) END AS corr FROM v_app" for x in APP_NUMERIC) + ")"


@query("select_rfe")
def select_rfe(spark, sf):
    app = staged(spark, sf, "v_app")
    kept = s.recursive_elimination(app, APP_NUMERIC, "target", 4, step=2, num_trees=10, max_depth=4)
    return small_table(spark, list(enumerate(kept)), "pos int, feature string")


@query("select_apply", """SELECT id, amt_a, cnt_a, CASE WHEN id % 4 = 0 THEN NULL ELSE target END::INTEGER AS target,
 CASE WHEN id % 4 > 1 THEN 'train' WHEN id % 4 = 1 THEN 'validation' ELSE 'test' END AS split FROM v_app""", ["v_app"], doubles="amt_a")
def select_apply(spark, sf):
    app = view(spark, sf, "v_app")
    out = s.apply_selection({"train": app.where("id % 4 > 1"), "validation": app.where("id % 4 = 1"), "test": app.where("id % 4 = 0").drop("target")},
                            ["amt_a", "cnt_a"], "id", "target")
    from riskframe.operators.relate import union_splits
    return union_splits(out)


@query("select_nzv", """WITH w AS (SELECT id, 7.0::DOUBLE AS flat, 1e6 + id % 7 AS steady, near_const, amt_a, target FROM v_app)
SELECT * FROM (""" + " UNION ALL ".join(f"""SELECT '{x}' AS feature, stddev_samp({x}) AS std, stddev_samp({x}) / (abs(avg({x})) + 1e-8) AS ratio_to_mean,
 CASE WHEN stddev_samp({x}) < 1e-8 THEN 'flat' ELSE 'low_ratio' END AS reason, count(DISTINCT {x}) AS u FROM w""" for x in ("flat", "steady", "near_const", "amt_a", "target"))
       + ") WHERE std < 1e-8 OR (ratio_to_mean < 0.001 AND u > 2)", ["v_app"], doubles="std ratio_to_mean", digits=9)
def select_nzv(spark, sf):
    app = staged(spark, sf, "v_app").withColumns({"flat": F.lit(7.0), "steady": F.lit(1e6) + F.col("id") % 7})
    cols = ["flat", "steady", "near_const", "amt_a", "target"]
    out = s.near_zero_variance(app, cols)
    uniq = s.small_domains(app, cols, 20)
    from riskframe.operators.encode import cardinality
    return out.join(cardinality(app, uniq).select(F.col("column_name").alias("feature"), F.col("n_unique").alias("u")), "feature")


_P = [(a, b) for j, b in enumerate(APP_NUMERIC) for a in APP_NUMERIC[:j]]


@query("select_corr_prune", f"""WITH {TARGET_CORR}, p AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS r FROM v_app" for a, b in _P) + """)
SELECT CASE WHEN abs(y.corr) >= abs(x.corr) THEN p.a ELSE p.b END AS feature, CASE WHEN abs(y.corr) >= abs(x.corr) THEN abs(x.corr) ELSE abs(y.corr) END AS abs_corr
FROM p JOIN tc x ON x.feature = p.a JOIN tc y ON y.feature = p.b WHERE r > 0.97 AND NOT isnan(r)""", ["v_app"], doubles="abs_corr")
def select_corr_prune(spark, sf):
    app = staged(spark, sf, "v_app")
    dropped = s.corr_prune(app, APP_NUMERIC, "target", 0.97)
    return s.target_corr(app, APP_NUMERIC, "target").where(F.col("feature").isin(dropped)).select("feature", "abs_corr")


@query("select_leak_suspects", f"""WITH w AS (SELECT *, target + near_const * 0.01 AS leak FROM v_app),
{TARGET_CORR.replace('v_app', 'w')}, l AS (SELECT 'leak' AS feature, corr(leak, target) AS corr FROM w)
SELECT feature, corr, abs(corr) AS abs_corr FROM (SELECT * FROM tc UNION ALL SELECT * FROM l) WHERE abs(corr) > 0.5""", ["v_app"], doubles="corr abs_corr")
def select_leak_suspects(spark, sf):
    app = view(spark, sf, "v_app").withColumn("leak", F.col("target") + F.col("near_const") * 0.01)
    return s.leak_suspects(app, [*APP_NUMERIC, "leak"], "target", 0.5)


@query("rank_target_corr", f"WITH {TARGET_CORR} SELECT feature, corr, abs(corr) AS abs_corr FROM tc WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 5",
       ["v_app"], doubles="corr abs_corr")
def rank_target_corr(spark, sf):
    return s.rank_by_target(view(spark, sf, "v_app"), APP_NUMERIC, "target", 5)


@query("select_guard", "SELECT 50 AS asked, 8 AS available, 8 AS kept, count(*) AS n_rows FROM v_app UNION ALL SELECT 3, 8, 3, count(*) FROM v_app", ["v_app"])
def select_guard(spark, sf):
    app = view(spark, sf, "v_app").select(*APP_NUMERIC)
    out = None
    for asked in (50, 3):
        row = app.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(asked).alias("asked"), F.lit(len(app.columns)).alias("available"), F.lit(s.wanted_count(asked, len(app.columns))).alias("kept"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out
