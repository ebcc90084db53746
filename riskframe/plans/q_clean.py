"""Cleaning: single steps, fit, replay and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.scalars import clamp, to_whole
from riskframe.operators import clean as c
from riskframe.plans.registry import query
from riskframe.plans.settings import APP_NUMERIC, APP_TEXT, CLEANING, SENTINEL
from riskframe.plans.views import staged, view
from riskframe.sources.staging import fresh_path
from riskframe.sources.tables import write_artifact

TRAIN = "id % 5 <> 0 OR id % 10 = 0"
ALL = [*APP_NUMERIC, *APP_TEXT]
SENT = "a AS (SELECT * REPLACE (nullif(days_emp, 365243) AS days_emp), (days_emp = 365243)::BIGINT AS days_emp_anom FROM v_app)"


@query("clean_sentinel", "SELECT id, nullif(days_emp, 365243) AS days_emp, (days_emp = 365243)::BIGINT AS days_emp_anom FROM v_app", ["v_app"])
def clean_sentinel(spark, sf):
    df = view(spark, sf, "v_app").select("id", "days_emp")
    return c.split_sentinel(df, "days_emp", "days_emp_anom", SENTINEL)


@query("fit_high_missing", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{x}' AS column_name, count_if({x} IS NULL) / count(*) AS missing_share FROM v_app" for x in ALL)
    + ") WHERE missing_share > 0.45", ["v_app"], doubles="missing_share")
def fit_high_missing(spark, sf):
    return c.high_missing(view(spark, sf, "v_app"), 0.45, {"id", "target"})


_P = [(a, b) for j, b in enumerate(APP_NUMERIC) for a in APP_NUMERIC[:j]]


@query("fit_high_corr", "WITH p AS (" + " UNION ALL ".join(
    f"SELECT '{b}' AS column_name, abs(corr({a}, {b})) AS r FROM v_app" for a, b in _P)
    + ") SELECT column_name, max(r) AS max_abs_corr FROM p WHERE r > 0.9 AND NOT isnan(r) GROUP BY column_name", ["v_app"], doubles="max_abs_corr")
def fit_high_corr(spark, sf):
    return c.high_correlation(staged(spark, sf, "v_app"), 0.9, {"id", "target"})


@query("fit_near_constant", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{x}' AS column_name, max(n) / sum(n) AS top_share FROM (SELECT count(*) AS n FROM v_app WHERE {x} IS NOT NULL GROUP BY {x})" for x in ALL)
    + ") WHERE top_share >= 0.95", ["v_app"], doubles="top_share")
def fit_near_constant(spark, sf):
    return c.near_constant(staged(spark, sf, "v_app"), 0.95, {"id", "target"})


@query("fit_medians", " UNION ALL ".join(f"SELECT '{x}' AS column_name, median({x}) AS median_value FROM v_app" for x in APP_NUMERIC),
       ["v_app"], doubles="median_value")
def fit_medians(spark, sf):
    app = staged(spark, sf, "v_app")
    return spark.createDataFrame(list(c.medians(app, APP_NUMERIC).items()), "column_name string, median_value double")


def _mode(x, src="v_app"):
    return (f"SELECT '{x}' AS column_name, arg_min(v, struct_pack(n := -n, v := v)) AS mode_value, max(n) AS n FROM "
            f"(SELECT {x} AS v, count(*) AS n FROM {src} WHERE {x} IS NOT NULL GROUP BY {x})")


@query("fit_modes", " UNION ALL ".join(_mode(x) for x in APP_TEXT), ["v_app"])
def fit_modes(spark, sf):
    return c.modes(view(spark, sf, "v_app"), APP_TEXT)


@query("fit_bounds", """
SELECT 'bound_min' AS kind, 'amt_b' AS column_name, 60000.0::DOUBLE AS value, (SELECT count(*) FROM v_app WHERE amt_b < 60000) AS rows_outside
UNION ALL SELECT 'bound_max', 'amt_b', 400000.0, (SELECT count(*) FROM v_app WHERE amt_b > 400000)
UNION ALL SELECT 'bound_min', 'cnt_a', 0.0, (SELECT count(*) FROM v_app WHERE cnt_a < 0)""", ["v_app"], doubles="value")
def fit_bounds(spark, sf):
    app = view(spark, sf, "v_app")
    art = c.CleaningArtifact(bounds={k: v for k, v in {**CLEANING.bounds, "not_there": (0, 1)}.items() if k in app.columns})
    hits = app.agg(F.count_if(F.col("amt_b") < 60000).alias("bound_min|amt_b"),
                   F.count_if(F.col("amt_b") > 400000).alias("bound_max|amt_b"),
                   F.count_if(F.col("cnt_a") < 0).alias("bound_min|cnt_a")).unpivot(
        [], ["bound_min|amt_b", "bound_max|amt_b", "bound_min|cnt_a"], "k", "rows_outside")
    hits = hits.select(F.split("k", r"\|")[0].alias("kind"), F.split("k", r"\|")[1].alias("column_name"), "rows_outside")
    return art.table(spark).select("kind", "column_name", F.col("value_double").alias("value")).join(hits, ["kind", "column_name"])


FIT = f"""WITH {SENT}, f AS (SELECT * FROM a WHERE {TRAIN})
SELECT 'drop_missing' AS kind, 'half_missing' AS column_name, NULL::DOUBLE AS value_double, NULL AS value_string FROM f HAVING count_if(half_missing IS NULL) / count(*) > 0.45
UNION ALL SELECT 'drop_corr', 'amt_a_dup', NULL, NULL FROM f HAVING abs(corr(amt_a, amt_a_dup)) > 0.9
UNION ALL SELECT 'drop_near_constant', 'near_const', NULL, NULL FROM f HAVING count_if(near_const = 0) / count(*) >= 0.95
""" + "".join(f"UNION ALL SELECT 'median', '{x}', median({x}), NULL FROM f " for x in ["days_emp", "days_emp_anom", "cnt_a", "amt_a", "amt_b", "amt_c"]) \
    + "".join(f"UNION ALL SELECT 'mode', column_name, NULL, mode_value FROM ({_mode(x, 'f')}) " for x in APP_TEXT) \
    + """UNION ALL SELECT 'bound_min', 'amt_b', 60000.0, NULL UNION ALL SELECT 'bound_max', 'amt_b', 400000.0, NULL
UNION ALL SELECT 'bound_min', 'cnt_a', 0.0, NULL"""


@query("fit_cleaning", FIT, ["v_app"], doubles="value_double")
def fit_cleaning(spark, sf):
    train = staged(spark, sf, "v_app").where(TRAIN)
    return write_artifact(c.fit_cleaning(train, CLEANING).table(spark), fresh_path(spark, "artifact"))


@query("clean_drop_columns", "SELECT id, target, segment, amt_b FROM v_app", ["v_app"], doubles="amt_b")
def clean_drop_columns(spark, sf):
    df = view(spark, sf, "v_app").select("id", "target", "segment", "amt_b", "near_const", "half_missing")
    return df.drop("near_const", "half_missing", "never_there")


@query("impute_zero", "SELECT id, coalesce(cnt_a, 0)::BIGINT AS cnt_a, coalesce(half_missing, 0) AS half_missing FROM v_app", ["v_app"], doubles="half_missing")
def impute_zero(spark, sf):
    return c.clean_child_table(view(spark, sf, "v_app").select("id", "cnt_a", "half_missing"), ["cnt_a", "half_missing"])


@query("impute_constant", "SELECT id, coalesce(nation, 'Unknown') AS nation FROM v_app", ["v_app"])
def impute_constant(spark, sf):
    return c.relabel(view(spark, sf, "v_app").select("id", "nation"), null_label={"nation": "Unknown"})


@query("impute_median_int", "SELECT id, round_even(coalesce(amt_c, round_even((SELECT median(amt_c) FROM v_app), 0)), 0)::BIGINT AS amt_c FROM v_app", ["v_app"])
def impute_median_int(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "amt_c")
    m = c.medians(app, ["amt_c"])["amt_c"]
    return app.select("id", to_whole(F.coalesce("amt_c", F.lit(float(round(m))))).alias("amt_c"))


@query("impute_fallback", f"""WITH f AS (SELECT * FROM v_app WHERE {TRAIN}), m AS ({_mode('nation', 'f')})
SELECT id, coalesce(half_missing, (SELECT median(half_missing) FROM f)) AS half_missing,
 coalesce(amt_c, (SELECT median(amt_c) FROM f)) AS amt_c, coalesce(nation, m.mode_value) AS nation FROM v_app, m""", ["v_app"], doubles="half_missing amt_c")
def impute_fallback(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "half_missing", "amt_c", "nation")
    cfg = c.CleaningConfig(("id",), "target", missing_threshold=1.0, corr_threshold=1.0, near_constant_threshold=1.01)
    return c.apply_cleaning(app, c.fit_cleaning(app.where(TRAIN), cfg), cfg)


@query("clip_bounds", """
SELECT id, CASE WHEN amt_b < 60000 THEN 60000 WHEN amt_b > 400000 THEN 400000 ELSE amt_b END AS both_sides,
 CASE WHEN amt_c > 300000 THEN 300000 ELSE amt_c END AS upper_only FROM v_app""", ["v_app"], doubles="both_sides upper_only")
def clip_bounds(spark, sf):
    return view(spark, sf, "v_app").select("id", clamp(F.col("amt_b"), 60000.0, 400000.0).alias("both_sides"),
                                           clamp(F.col("amt_c"), None, 300000.0).alias("upper_only"))


@query("cast_int_columns", "SELECT child_id, step, round_even(qty / 2, 0)::BIGINT AS half_qty, round_even(due, 0)::BIGINT AS due FROM v_hist", ["v_hist"])
def cast_int_columns(spark, sf):
    return view(spark, sf, "v_hist").select("child_id", "step", to_whole(F.col("qty") / 2).alias("half_qty"), to_whole(F.col("due")).alias("due"))


@query("clean_null_audit", "SELECT (" + " + ".join(f"count_if({x} IS NULL)" for x in ALL) + ")::BIGINT AS null_cells, ("
       + " + ".join(f"(count_if({x} IS NULL) > 0)::INT" for x in ALL) + ")::BIGINT AS columns_with_nulls FROM v_app", ["v_app"])
def clean_null_audit(spark, sf):
    return c.null_audit(view(spark, sf, "v_app"))


CLEANED = f"""WITH {SENT}, f AS (SELECT * FROM a WHERE {TRAIN}), {', '.join(f'm_{x} AS ({_mode(x, "f")})' for x in APP_TEXT)},
s AS (SELECT median(days_emp) AS d, median(amt_a) AS aa, median(amt_b) AS ab, median(amt_c) AS ac FROM f),
clean AS (SELECT id, target, coalesce(segment, m_segment.mode_value) AS segment, coalesce(nation, 'Unknown') AS nation,
 coalesce(region, m_region.mode_value) AS region, coalesce(flag_yn, m_flag_yn.mode_value) AS flag_yn,
 round_even(coalesce(days_emp, s.d), 0)::BIGINT AS days_emp, greatest(coalesce(cnt_a, 0), 0)::DOUBLE AS cnt_a, coalesce(amt_a, s.aa) AS amt_a,
 least(greatest(coalesce(amt_b, s.ab), 60000), 400000)::DOUBLE AS amt_b,
 round_even(coalesce(amt_c, round_even(s.ac, 0)), 0)::BIGINT AS amt_c, days_emp_anom FROM a, s, m_segment, m_region, m_flag_yn)"""


@query("apply_cleaning", CLEANED + " SELECT * FROM clean", ["v_app"], doubles="cnt_a amt_a amt_b")
def apply_cleaning(spark, sf):
    app = staged(spark, sf, "v_app")
    out = c.apply_cleaning(app, c.fit_cleaning(app.where(TRAIN), CLEANING), CLEANING)
    return out.withColumn("cnt_a", F.col("cnt_a").cast("double"))


def _outlier_sql(x):
    return f"""SELECT '{x}' AS column_name, q1, q3, p99, q3 - q1 AS iqr, q1 - 3 * (q3 - q1) AS low_fence, q3 + 3 * (q3 - q1) AS high_fence,
 (SELECT max({x}) FROM v_app)::DOUBLE AS max_value,
 (SELECT count(*) FROM v_app WHERE {x} < q1 - 3 * (q3 - q1) OR {x} > q3 + 3 * (q3 - q1)) AS n_outliers,
 100.0 * (SELECT count(*) FROM v_app WHERE {x} < q1 - 3 * (q3 - q1) OR {x} > q3 + 3 * (q3 - q1)) / n AS outlier_percent
 FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3, quantile_cont({x}, 0.99) AS p99, count({x}) AS n FROM v_app)"""


@query("outlier_iqr_stats", " UNION ALL ".join(_outlier_sql(x) for x in ["days_emp", "amt_a", "amt_b", "cnt_a"]), ["v_app"],
       doubles="q1 q3 p99 iqr low_fence high_fence max_value outlier_percent")
def outlier_iqr_stats(spark, sf):
    return c.outlier_stats(staged(spark, sf, "v_app"), ["days_emp", "amt_a", "amt_b", "cnt_a"])


@query("winsorize_p99", f"""WITH k AS (SELECT quantile_cont(amt_a, 0.99) AS a, quantile_cont(amt_c, 0.99) AS c FROM v_app WHERE {TRAIN})
SELECT id, CASE WHEN amt_a > k.a THEN k.a ELSE amt_a END AS amt_a, CASE WHEN amt_c > k.c THEN k.c ELSE amt_c END AS amt_c,
 count_if(amt_a > k.a) OVER ()::BIGINT AS capped_a, count_if(amt_c > k.c) OVER ()::BIGINT AS capped_c FROM v_app, k""", ["v_app"], doubles="amt_a amt_c")
def winsorize_p99(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "amt_a", "amt_c")
    caps = c.fit_caps(app.where(TRAIN), ["amt_a", "amt_c"])
    n = {r.column_name: r.rows_capped for r in c.cap_audit({"all": app}, caps).collect()}
    return c.winsorize(app, caps).select("id", "amt_a", "amt_c", F.lit(n["amt_a"]).cast("long").alias("capped_a"), F.lit(n["amt_c"]).cast("long").alias("capped_c"))


@query("relabel_categories", """
SELECT id, CASE WHEN segment = 'FURNITURE' THEN NULL ELSE segment END AS segment,
 CASE WHEN region = 'ASIA' THEN 'Unknown_Org' ELSE region END AS region, coalesce(nation, 'Unknown_Occ') AS nation FROM v_app""", ["v_app"])
def relabel_categories(spark, sf):
    return c.relabel(view(spark, sf, "v_app").select("id", "segment", "region", "nation"), {"segment": ["FURNITURE"]},
                     {"region": {"ASIA": "Unknown_Org"}}, {"nation": "Unknown_Occ"})


@query("drop_fixed_columns", "SELECT id, segment, nation, region, flag_yn, days_emp, half_missing, cnt_a, amt_a FROM v_app", ["v_app"], doubles="half_missing amt_a")
def drop_fixed_columns(spark, sf):
    return c.drop_fixed(view(spark, sf, "v_app"), ["amt_", "amt_a_"], ["b", "c", "dup", "zz"], ["near_const", "target"])


@query("detect_binary_flags", " UNION ALL ".join(
    f"SELECT '{x}' AS column_name, coalesce(bool_and({x} IN (0, 1)), TRUE) AS is_flag FROM v_app" for x in ["target", *APP_NUMERIC]), ["v_app"])
def detect_binary_flags(spark, sf):
    return c.binary_flags(view(spark, sf, "v_app"), ["target", *APP_NUMERIC])


@query("impute_flag_mode", f"""WITH f AS (SELECT * FROM v_app WHERE {TRAIN}), m AS ({_mode('nation', 'f')})
SELECT id, coalesce(amt_c, (SELECT median(amt_c) FROM f)) AS amt_c,
 coalesce(CASE WHEN id % 9 = 0 THEN NULL ELSE near_const END, 0)::INTEGER AS near_const, coalesce(nation, m.mode_value) AS nation FROM v_app, m""",
       ["v_app"], doubles="amt_c")
def impute_flag_mode(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "amt_c", F.when(F.col("id") % 9 != 0, F.col("near_const")).alias("near_const"), "nation")
    return c.impute_by_kind(app.where(TRAIN), app, skip=["id"])


@query("cleaning_audit_log", """
SELECT 'drop high missing' AS step, 'structure' AS phase, 'more than 45 % null' AS description, 0::BIGINT AS rows_affected, 1::BIGINT AS columns_affected FROM v_app HAVING count(*) > 0
UNION ALL SELECT 'sentinel', 'sentinel', 'placeholder to null', count_if(days_emp = 365243)::BIGINT, (count_if(days_emp = 365243) > 0)::BIGINT FROM v_app
UNION ALL SELECT 'fill', 'imputation', 'median or label', (count_if(amt_c IS NULL) + count_if(nation IS NULL) + count_if(region IS NULL))::BIGINT,
 (count_if(amt_c IS NULL) > 0)::BIGINT + (count_if(nation IS NULL) > 0)::BIGINT + (count_if(region IS NULL) > 0)::BIGINT FROM v_app""", ["v_app"])
def cleaning_audit_log(spark, sf):
    return c.audit_log(view(spark, sf, "v_app"), [
        ("drop high missing", "structure", "more than 45 % null", {"half_missing": None}),
        ("sentinel", "sentinel", "placeholder to null", {"days_emp": F.col("days_emp") == SENTINEL}),
        ("fill", "imputation", "median or label", {x: F.col(x).isNull() for x in ("amt_c", "nation", "region")})])


@query("clean_secondary_tables", """
SELECT child_id, step, coalesce(disc, 0) AS disc, nullif(qty, 50) AS qty FROM v_hist""", ["v_hist"], doubles="disc qty")
def clean_secondary_tables(spark, sf):
    return c.clean_child_table(view(spark, sf, "v_hist").select("child_id", "step", "disc", "qty"), ["disc"], ["qty"], 50.0)


PROTECTED = ["amt_c", "cnt_a", "days_emp", "id", "nation", "target"]


@query("clean_protected_set", " UNION ALL ".join(f"SELECT '{x}' AS column_name, count({x}) AS n_present FROM v_app" for x in PROTECTED), ["v_app"])
def clean_protected_set(spark, sf):
    from riskframe.functions.frames import spread
    app = view(spark, sf, "v_app")
    keep = CLEANING.protected()
    return spread(app, [x for x in app.columns if x in keep], {"n_present": F.count}, name="column_name")
