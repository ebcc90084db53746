"""Profiles, registry and baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import profile as p
from riskframe.operators.correlate import corr_matrix, strong_pairs
from riskframe.plans.q_select import TARGET_CORR, _P
from riskframe.plans.registry import query
from riskframe.plans.settings import APP_NUMERIC, APP_TEXT, SENTINEL
from riskframe.plans.views import staged, table, view
from riskframe.sources.staging import fresh_path
from riskframe.sources.tables import write_record

COLS = ["id", "target", "segment", "nation", "region", "flag_yn", *APP_NUMERIC]
TYPES = {"id": "bigint", "target": "int", **{c: "string" for c in APP_TEXT}, "days_emp": "bigint", "half_missing": "double", "cnt_a": "bigint",
         "amt_a": "double", "amt_a_dup": "double", "amt_b": "double", "amt_c": "double", "near_const": "int"}
NUM = ["id", "target", *APP_NUMERIC]


def union(parts):
    return " UNION ALL ".join(parts)


@query("profile_schema", union(f"SELECT '{c}' AS column_name, '{TYPES[c]}' AS data_type, '{'categorical' if c in APP_TEXT else 'numeric'}' AS kind, count({c}) AS n_present FROM v_app" for c in COLS), ["v_app"])
def profile_schema(spark, sf):
    return p.profile_schema(view(spark, sf, "v_app"))


@query("profile_missing", "SELECT *, CASE WHEN null_percent < 10 THEN 'low' WHEN null_percent < 50 THEN 'medium' ELSE 'high' END AS band FROM ("
       + union(f"SELECT '{c}' AS column_name, count_if({c} IS NULL)::BIGINT AS null_count, 100.0 * count_if({c} IS NULL) / count(*) AS null_percent FROM v_app" for c in COLS)
       + ") WHERE null_count > 0", ["v_app"], doubles="null_percent")
def profile_missing(spark, sf):
    return p.profile_missing(view(spark, sf, "v_app"))


@query("profile_describe", union(f"""SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value,
 skewness({c}) AS skewness, kurtosis({c}) AS kurtosis, quantile_cont({c}, 0.25) AS q25, median({c}) AS q50, quantile_cont({c}, 0.75) AS q75 FROM v_app""" for c in APP_NUMERIC),
       ["v_app"], doubles="mean std min_value max_value skewness kurtosis q25 q50 q75")
def profile_describe(spark, sf):
    return p.profile_describe(staged(spark, sf, "v_app"), APP_NUMERIC)


@query("profile_cardinality", union(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique, CASE WHEN count(DISTINCT {c}) <= 10 THEN 'low' ELSE 'high' END AS band FROM v_app" for c in APP_TEXT), ["v_app"])
def profile_cardinality(spark, sf):
    return p.profile_cardinality(view(spark, sf, "v_app"), APP_TEXT)


@query("profile_target_balance", """WITH c AS (SELECT target, count(*) AS n FROM v_app GROUP BY target)
SELECT target, n, 100.0 * n / sum(n) OVER () AS percent, max(n) OVER () / min(n) OVER () AS imbalance_ratio FROM c""", ["v_app"], doubles="percent imbalance_ratio")
def profile_target_balance(spark, sf):
    return p.target_balance(view(spark, sf, "v_app"), "target")


@query("profile_placeholders", """
SELECT 'nation' AS column_name, trim(nation) AS token, count(*) AS n_rows FROM v_app WHERE trim(nation) IN ('NATION_0', 'ASIA', 'XNA') GROUP BY 2
UNION ALL SELECT 'region', trim(region), count(*) FROM v_app WHERE trim(region) IN ('NATION_0', 'ASIA', 'XNA') GROUP BY 2""", ["v_app"])
def profile_placeholders(spark, sf):
    app = view(spark, sf, "v_app").withColumn("region", F.concat(F.col("region"), F.lit(" ")))
    return p.placeholders(app, APP_TEXT, ["NATION_0", "ASIA", "XNA"])


@query("profile_target_rate", """WITH g AS (SELECT avg(target) AS g FROM v_app)
SELECT nation AS category, count(*) AS n, avg(target) AS rate, any_value(g) AS global_rate, avg(target) > any_value(g) AS above_global FROM v_app, g WHERE nation IS NOT NULL GROUP BY nation""",
       ["v_app"], doubles="rate global_rate")
def profile_target_rate(spark, sf):
    return p.target_rate(view(spark, sf, "v_app"), "nation", "target")


CORR_ALL = "pr AS (" + union(f"SELECT '{a}' AS a, '{b}' AS b, CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END AS r, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n FROM v_app"
                             for a, b in [(a, b) for j, b in enumerate(["target", *APP_NUMERIC]) for a in ["target", *APP_NUMERIC][:j]]) + ")"


@query("profile_corr_matrix", f"""WITH {CORR_ALL} SELECT a AS feature, b AS other, r FROM pr UNION ALL SELECT b, a, r FROM pr UNION ALL """
       + union(f"SELECT '{c}', '{c}', 1.0 FROM v_app HAVING count(*) > 0" for c in ["target", *APP_NUMERIC]), ["v_app"], doubles="r")
def profile_corr_matrix(spark, sf):
    return corr_matrix(staged(spark, sf, "v_app"), ["target", *APP_NUMERIC])


@query("profile_corr_pairs", f"WITH {CORR_ALL} SELECT a AS left_feature, b AS right_feature, n, r FROM pr WHERE abs(r) > 0.5", ["v_app"], doubles="r")
def profile_corr_pairs(spark, sf):
    return strong_pairs(staged(spark, sf, "v_app"), ["target", *APP_NUMERIC], 0.5).select("left_feature", "right_feature", "n", "r")


@query("profile_schema_parity", """
SELECT 'disc' AS column_name, count(disc) AS n_present, 'history' AS only_in FROM v_hist UNION ALL SELECT 'due', count(due), 'history' FROM v_hist
UNION ALL SELECT 'paid', count(paid), 'history' FROM v_hist UNION ALL SELECT 'qty', count(qty), 'history' FROM v_hist UNION ALL SELECT 'step', count(step), 'history' FROM v_hist
UNION ALL SELECT 'id', count(id), 'child' FROM v_child UNION ALL SELECT 'kind', count(kind), 'child' FROM v_child
UNION ALL SELECT 'amt', count(amt), 'child' FROM v_child UNION ALL SELECT 'days', count(days), 'child' FROM v_child""", ["v_child", "v_hist"])
def profile_schema_parity(spark, sf):
    return p.schema_parity(view(spark, sf, "v_child"), view(spark, sf, "v_hist"), "child", "history")


def hist_sql(src, x, cls, bins, lo, hi):
    return f"""WITH r AS (SELECT {lo} AS lo, {hi} AS hi FROM {src}), v AS (SELECT CAST({cls} AS VARCHAR) AS class, least(greatest({x}, lo), hi) AS v, lo, hi, (hi - lo) / {bins} AS w FROM {src}, r WHERE {x} IS NOT NULL),
 b AS (SELECT class, least({bins} - 1, len(list_filter(list_transform(range(1, {bins} + 1), lambda i: lo + i * w), lambda q: q <= v)))::INTEGER AS bin, lo, w FROM v)
SELECT class, bin, any_value(lo) + bin * any_value(w) AS left_edge, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY class) / any_value(w) AS density FROM b GROUP BY class, bin"""


@query("profile_histogram_by_class", hist_sql("v_app", "amt_b", "target", 40, "quantile_cont(amt_b, 0.01)", "quantile_cont(amt_b, 0.99)"), ["v_app"], doubles="left_edge density", digits=9)
def profile_histogram_by_class(spark, sf):
    return p.histogram_by_class(staged(spark, sf, "v_app"), "amt_b", "target", 40)


@query("profile_boxplot", """WITH r AS (SELECT quantile_cont(amt_b, 0.01) AS lo, quantile_cont(amt_b, 0.99) AS hi FROM v_app),
v AS (SELECT target, CASE WHEN amt_b < lo THEN lo WHEN amt_b > hi THEN hi ELSE amt_b END AS v FROM v_app, r)
SELECT CAST(target AS VARCHAR) AS class, min(v) AS low, quantile_cont(v, 0.25) AS q25, median(v) AS median, quantile_cont(v, 0.75) AS q75, max(v) AS high FROM v GROUP BY target""",
       ["v_app"], doubles="low q25 median q75 high")
def profile_boxplot(spark, sf):
    return p.boxplot_by_class(staged(spark, sf, "v_app"), "amt_b", "target", [0, 1])


@query("profile_domain", union([f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value, NULL::BIGINT AS n_levels, count_if({c} IS NULL)::BIGINT AS null_count FROM v_app" for c in ("amt_b", "days_emp")]
       + [f"SELECT '{c}', NULL, NULL, count(DISTINCT {c}), count_if({c} IS NULL)::BIGINT FROM v_app" for c in ("segment", "nation", "near_const")]),
       ["v_app"], doubles="min_value max_value")
def profile_domain(spark, sf):
    return p.profile_domain(view(spark, sf, "v_app"), ["amt_b", "days_emp"], ["segment", "nation", "near_const"])


@query("profile_levels", union([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM customer WHERE {c} IS NOT NULL GROUP BY {c}"
                                for c in ("c_name", "c_mktsegment", "c_nationkey")]))
def profile_levels(spark, sf):
    return p.profile_levels(table(spark, sf, "customer"), ["c_name", "c_mktsegment", "c_nationkey"])


@query("profile_duplicates", """
SELECT 'v_hist.child_id' AS key_name, count(child_id) - count(DISTINCT child_id) AS duplicated_rows, count_if(child_id IS NULL)::BIGINT AS null_keys FROM v_hist
UNION ALL SELECT 'v_app.nation', count(nation) - count(DISTINCT nation), count_if(nation IS NULL)::BIGINT FROM v_app""", ["v_hist", "v_app"])
def profile_duplicates(spark, sf):
    return (p.duplicates(view(spark, sf, "v_hist"), "child_id").withColumn("key_name", F.lit("v_hist.child_id"))
            .unionByName(p.duplicates(view(spark, sf, "v_app"), "nation").withColumn("key_name", F.lit("v_app.nation"))))


@query("profile_auto", union(f"""SELECT '{c}' AS column_name, count(*) AS n, count_if({c} IS NULL)::BIGINT AS n_null, {f'count_if({c} = 0)::BIGINT' if c in NUM else '0'} AS n_zero,
 {f'avg({c})' if c in NUM else 'NULL'} AS mean, {f'stddev_samp({c})' if c in NUM else 'NULL'} AS std, {f'min({c})::DOUBLE' if c in NUM else 'NULL'} AS min_value, {f'max({c})::DOUBLE' if c in NUM else 'NULL'} AS max_value,
 {f'quantile_cont({c}, 0.25)' if c in NUM else 'NULL'} AS q25, {f'median({c})' if c in NUM else 'NULL'} AS q50, {f'quantile_cont({c}, 0.75)' if c in NUM else 'NULL'} AS q75,
 count(DISTINCT {c}) AS n_unique, (SELECT max(m) FROM (SELECT count(*) AS m FROM v_app WHERE {c} IS NOT NULL GROUP BY {c})) AS top_count FROM v_app""" for c in COLS),
       ["v_app"], doubles="mean std min_value max_value q25 q50 q75", digits=5)
def profile_auto(spark, sf):
    # the most frequent value is text whose float format is engine specific; its count is compared
    return p.profile_auto(staged(spark, sf, "v_app")).drop("top_value")


@query("feature_registry", f"WITH {TARGET_CORR} " + union(f"""SELECT '{c}' AS feature_name, '{ {'amt': 'orders', 'cnt': 'orders'}.get(c[:3], 'application') }' AS feature_group,
 '{ 'duplicate' if c.endswith('_dup') else 'count' if c == 'cnt_a' else 'amount' if c.startswith('amt_') else 'raw_or_cleaned' }' AS engineering_method, '{TYPES[c]}' AS dtype,
 count(DISTINCT {c}) AS n_unique, count_if({c} IS NULL)::BIGINT AS null_count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value,
 (SELECT coalesce(corr, 0) FROM tc WHERE feature = '{c}') AS corr_with_target, (SELECT abs(coalesce(corr, 0)) FROM tc WHERE feature = '{c}') AS abs_corr_with_target FROM v_app""" for c in APP_NUMERIC),
       ["v_app"], doubles="mean std min_value max_value corr_with_target abs_corr_with_target")
def feature_registry(spark, sf):
    return p.feature_registry(staged(spark, sf, "v_app"), APP_NUMERIC, "target", {"amt_": "orders", "cnt_": "orders"},
                              [("duplicate", [], [], ["_dup"]), ("count", ["cnt_a"], [], []), ("amount", [], ["amt_"], [])])


@query("reference_baseline", union(f"""SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value,
 count_if({c} IS NULL) / count(*) AS null_share, quantile_cont({c}, 0.01) AS q01, quantile_cont({c}, 0.25) AS q25, median({c}) AS q50, quantile_cont({c}, 0.75) AS q75,
 quantile_cont({c}, 0.99) AS q99 FROM v_app""" for c in APP_NUMERIC), ["v_app"], doubles="mean std min_value max_value null_share q01 q25 q50 q75 q99")
def reference_baseline(spark, sf):
    return p.reference_baseline(staged(spark, sf, "v_app"), APP_NUMERIC)


@query("profile_value_share", "SELECT kind AS value, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM v_child GROUP BY kind", ["v_child"], doubles="share")
def profile_value_share(spark, sf):
    return p.value_share(view(spark, sf, "v_child"), "kind")


@query("profile_decisions", """SELECT count(*) AS n_rows, 14 AS n_columns, count_if(days_emp = 365243)::BIGINT AS sentinel_days_emp, count_if(region = 'ASIA')::BIGINT AS placeholder_region,
 count_if(target = 0) / count_if(target = 1) AS imbalance_ratio, CASE WHEN count_if(half_missing IS NULL) / count(*) > 0.45 THEN 'half_missing' ELSE '' END AS columns_over_limit,
 'amt_a_dup' AS redundant_columns, concat_ws(',', CASE WHEN count(amt_a) < count(*) THEN 'amt_a=' || count_if(amt_a IS NULL) || ',amt_a_dup=' || count_if(amt_a_dup IS NULL) || ',amt_b=' || count_if(amt_b IS NULL) END,
 'amt_c=' || count_if(amt_c IS NULL), CASE WHEN count(cnt_a) < count(*) THEN 'cnt_a=' || count_if(cnt_a IS NULL) END, 'half_missing=' || count_if(half_missing IS NULL), 'nation=' || count_if(nation IS NULL)) AS null_counts FROM v_app""",
       ["v_app"], doubles="imbalance_ratio")
def profile_decisions(spark, sf):
    rec = write_record(p.decision_record(staged(spark, sf, "v_app"), "target", 45.0, {"days_emp": SENTINEL}, {"region": "ASIA"}, ["amt_a_dup"]), fresh_path(spark, "decisions"))
    pairs = F.transform("null_counts", lambda s: F.concat(s["column_name"], F.lit("="), s["null_count"].cast("string")))
    return rec.withColumns({"columns_over_limit": F.concat_ws(",", "columns_over_limit"), "redundant_columns": F.concat_ws(",", "redundant_columns"),
                            "null_counts": F.array_join(pairs, ",")})
