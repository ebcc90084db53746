"""Encoders on the applicant view."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import clean, encode as e
from riskframe.plans.q_clean import TRAIN, _mode
from riskframe.plans.q_sources import h
from riskframe.plans.registry import query
from riskframe.plans.settings import APP_NUMERIC, APP_TEXT, BINARY, REGION_RULES, SEED
from riskframe.plans.views import staged, view

VAL = f"NOT ({TRAIN})"


@query("encode_binary_map", """SELECT id, CASE flag_yn WHEN 'N' THEN 0 WHEN 'Y' THEN 1 END AS flag_yn,
 CASE region WHEN 'ASIA' THEN 1 WHEN 'EUROPE' THEN 0 END AS region FROM v_app""", ["v_app"])
def encode_binary_map(spark, sf):
    return e.binary_map(view(spark, sf, "v_app").select("id", "flag_yn", "region"), {**BINARY, "region": {"ASIA": 1, "EUROPE": 0}})


@query("encode_binary_map_filled", f"""WITH m AS ({_mode('nation')}) SELECT id,
 CASE coalesce(nation, m.mode_value) WHEN 'NATION_1' THEN 1 WHEN 'NATION_2' THEN 0 ELSE -1 END AS nation,
 CASE flag_yn WHEN 'N' THEN 0 WHEN 'Y' THEN 1 ELSE -1 END AS flag_yn FROM v_app, m""", ["v_app"])
def encode_binary_map_filled(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "nation", "flag_yn")
    fill = {r.column_name: r.mode_value for r in clean.modes(app, ["nation", "flag_yn"]).collect()}
    return e.binary_map_filled(app, {"nation": {"NATION_1": 1, "NATION_2": 0}, **BINARY}, fill)


@query("encode_cardinality_gate", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_unique, CASE WHEN count(DISTINCT {c}) <= 10 THEN 'one_hot' ELSE 'target' END AS encoder FROM v_app"
    for c in APP_TEXT), ["v_app"])
def encode_cardinality_gate(spark, sf):
    return e.cardinality_gate(view(spark, sf, "v_app"), 10)


@query("encode_onehot_fit", " UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS column_name, {c} AS value, '{c}_' || {c} AS feature FROM v_app WHERE {c} IS NOT NULL AND ({TRAIN})"
    for c in ("segment", "region", "flag_yn")), ["v_app"])
def encode_onehot_fit(spark, sf):
    train = staged(spark, sf, "v_app").where(TRAIN)
    cols = e.small_domains(train, APP_TEXT, 10)
    return e.onehot_vocabulary(train, cols)


def _hot(col, values):
    return ", ".join(f'coalesce({col} = \'{v}\', FALSE)::INT AS "{col}_{v}"' for v in values)


@query("encode_onehot_apply", f"""SELECT id, nation, {_hot('segment', ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])},
 {_hot('region', ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'])}, {_hot('flag_yn', ['N', 'Y'])} FROM v_app WHERE {VAL}""", ["v_app"])
def encode_onehot_apply(spark, sf):
    app = staged(spark, sf, "v_app").select("id", *APP_TEXT)
    train, val = app.where(TRAIN), app.where(VAL)
    return e.onehot_fit_apply(train, {"validation": val}, 10)["validation"]


@query("encode_target_oof", f"""
WITH t AS (SELECT id, nation, segment, target, {h()} % 5 AS fold FROM v_app WHERE {TRAIN}), g AS (SELECT avg(target) AS g FROM t),
cn AS (SELECT a.fold, b.nation AS c, (sum(b.target) + 10 * any_value(g.g)) / (count(*) + 10) AS enc FROM (SELECT DISTINCT fold FROM t) a JOIN t b ON a.fold <> b.fold, g WHERE b.nation IS NOT NULL GROUP BY a.fold, b.nation),
cs AS (SELECT a.fold, b.segment AS c, (sum(b.target) + 10 * any_value(g.g)) / (count(*) + 10) AS enc FROM (SELECT DISTINCT fold FROM t) a JOIN t b ON a.fold <> b.fold, g GROUP BY a.fold, b.segment)
SELECT t.id, t.target, t.nation, t.segment, coalesce(cn.enc, g.g) AS "nation_TE", coalesce(cs.enc, g.g) AS "segment_TE"
FROM t JOIN g ON TRUE LEFT JOIN cn ON cn.fold = t.fold AND cn.c = t.nation LEFT JOIN cs ON cs.fold = t.fold AND cs.c = t.segment""", ["v_app"],
       doubles='nation_TE segment_TE')
def encode_target_oof(spark, sf):
    train = staged(spark, sf, "v_app").where(TRAIN).select("id", "target", "nation", "segment")
    return e.target_encode_oof(train, "id", ["nation", "segment", "not_there"], "target", 5, 10, SEED)


TMAP = f"""g AS (SELECT avg(target) AS g FROM v_app WHERE {TRAIN}),
m AS (SELECT nation AS c, count(*) AS n, (sum(target) + 10 * any_value(g.g)) / (count(*) + 10) AS enc FROM v_app, g WHERE ({TRAIN}) AND nation IS NOT NULL GROUP BY nation)"""


@query("encode_target_apply", f"""WITH {TMAP} SELECT id, nation, coalesce(enc, g.g) AS "nation_TE" FROM v_app JOIN g ON TRUE LEFT JOIN m ON m.c = nation WHERE {VAL}""",
       ["v_app"], doubles="nation_TE")
def encode_target_apply(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "target", "nation")
    train = app.where(TRAIN)
    g = e.target_mean(train, "target")
    return e.target_encode_apply(app.where(VAL).select("id", "nation"), "nation", e.target_map(train, "nation", "target", 10, g), g)


@query("encode_target_artifact", f"""WITH g AS (SELECT avg(target) AS g FROM v_app WHERE {TRAIN})
""" + " UNION ALL ".join(f"""SELECT '{c}' AS column_name, {c} AS category, (sum(target) + 10 * any_value(g.g)) / (count(*) + 10) AS encoding, any_value(g.g) AS global_mean,
 10 AS smoothing, 5 AS n_folds FROM v_app, g WHERE ({TRAIN}) AND {c} IS NOT NULL GROUP BY {c}""" for c in ("nation", "segment")), ["v_app"], doubles="encoding global_mean")
def encode_target_artifact(spark, sf):
    return e.target_artifact(staged(spark, sf, "v_app").where(TRAIN), ["nation", "segment"], "target")


@query("encode_drop_residual", "SELECT id, target, days_emp, half_missing, cnt_a, amt_a, amt_a_dup, amt_b, amt_c, near_const FROM v_app", ["v_app"],
       doubles="half_missing amt_a amt_a_dup amt_b amt_c")
def encode_drop_residual(spark, sf):
    return e.drop_text(view(spark, sf, "v_app"))


def edges_sql(x, n=10, src="v_app"):
    """Inner quantile edges (a sorted distinct list without its ends)."""
    qs = ", ".join(f"{i}/{n}.0::DOUBLE" for i in range(n + 1))
    return f"(SELECT (list_sort(list_distinct(quantile_cont({x}, [{qs}]))))[2:-2] AS e FROM {src})"


@query("woe_fit_numeric", " UNION ALL ".join(f"""SELECT '{x}' AS feature, code AS bin, count(*) AS n, min(v) AS low, max(v) AS high FROM
 (SELECT {x}::DOUBLE AS v, CASE WHEN {x} IS NULL THEN -1 ELSE len(list_filter(e, lambda q: q <= {x})) END::VARCHAR AS code FROM v_app, {edges_sql(x)}) GROUP BY code"""
    for x in ("amt_a", "amt_b", "half_missing", "days_emp")), ["v_app"], doubles="low high")
def woe_fit_numeric(spark, sf):
    app = staged(spark, sf, "v_app")
    out = None
    for x, inner in e.woe_edges(app, ["amt_a", "amt_b", "half_missing", "days_emp"], 10).items():
        part = app.select(F.lit(x).alias("feature"), e.numeric_bin(F.col(x), inner).alias("bin"), F.col(x).cast("double").alias("v"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("feature", "bin").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


@query("woe_fit_categorical", " UNION ALL ".join(
    f"SELECT '{x}' AS feature, coalesce(CAST({x} AS VARCHAR), '__nan__') AS bin, count(*) AS n FROM v_app GROUP BY 2" for x in ("segment", "nation", "near_const")), ["v_app"])
def woe_fit_categorical(spark, sf):
    app = staged(spark, sf, "v_app")
    _, levels = e.split_feature_kinds(app, ["segment", "nation", "near_const", "amt_a"], 20)
    bins = e.woe_bins(app, {}, levels)
    return e.long_form(app, bins, value="bin").groupBy("feature", "bin").agg(F.count("*").alias("n"))


WOE_FEATURES = ["amt_a", "half_missing", "segment", "nation", "near_const"]
WOE = "WITH b AS (" + " UNION ALL ".join(
    [f"SELECT id, target, '{x}' AS feature, CASE WHEN {x} IS NULL THEN -1 ELSE len(list_filter(e, lambda q: q <= {x})) END::VARCHAR AS bin FROM v_app, {edges_sql(x)}" for x in ("amt_a", "half_missing")]
    + [f"SELECT id, target, '{x}', coalesce(CAST({x} AS VARCHAR), '__nan__') FROM v_app" for x in ("segment", "nation", "near_const")]) + """),
t AS (SELECT sum(target)::DOUBLE AS bt, (count(*) - sum(target))::DOUBLE AS gt FROM v_app),
c AS (SELECT feature, bin, (count(*) - sum(target))::DOUBLE AS good, sum(target)::DOUBLE AS bad FROM b GROUP BY feature, bin),
w AS (SELECT feature, bin, good, bad, (good + 0.5) / (gt + 1) AS dg, (bad + 0.5) / (bt + 1) AS db FROM c, t),
woe AS (SELECT feature, bin, good, bad, ln(dg / db) AS woe, (dg - db) * ln(dg / db) AS iv FROM w)"""


def _woe(spark, sf):
    app = staged(spark, sf, "v_app")
    binned, levels = e.split_feature_kinds(app, WOE_FEATURES, 20)
    return e.woe_table(app, "target", e.woe_edges(app, binned, 10), levels)


@query("woe_table", WOE + " SELECT * FROM woe", ["v_app"], doubles="good bad woe iv")
def woe_table(spark, sf):
    return _woe(spark, sf)


@query("woe_apply", WOE + " SELECT id, " + ", ".join(f"""max(CASE WHEN b.feature = '{x}' THEN woe END) AS "{x}_WOE" """ for x in WOE_FEATURES)
       + ' FROM b JOIN woe ON woe.feature = b.feature AND woe.bin = b.bin GROUP BY id', ["v_app"], doubles=" ".join(f"{x}_WOE" for x in WOE_FEATURES))
def woe_apply(spark, sf):
    app = staged(spark, sf, "v_app")
    model = e.fit_woe(app, "target", WOE_FEATURES, 10)
    return e.woe_apply(app, model).select("id", *[f"{x}_WOE" for x in WOE_FEATURES])


@query("information_value", WOE + " SELECT feature, sum(iv) AS information_value FROM woe GROUP BY feature", ["v_app"], doubles="information_value")
def information_value(spark, sf):
    return e.information_value(_woe(spark, sf))


@query("standardize", "SELECT id, " + ", ".join(f"({x} - (SELECT avg({x}) FROM v_app)) / (SELECT stddev_pop({x}) FROM v_app) AS {x}_z" for x in ("amt_a", "amt_b", "cnt_a"))
       + " FROM v_app", ["v_app"], doubles="amt_a_z amt_b_z cnt_a_z")
def standardize(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "amt_a", "amt_b", "cnt_a")
    return e.standardize(app, e.fit_scaler(app, ["amt_a", "amt_b", "cnt_a"]), "_z").select("id", "amt_a_z", "amt_b_z", "cnt_a_z")


@query("encode_rule_onehot", """SELECT id, coalesce(region = 'ASIA', FALSE)::INT AS "region_ASIA", coalesce(region = 'EUROPE', FALSE)::INT AS "region_EUROPE",
 coalesce(segment = 'BUILDING', FALSE)::INT AS "segment_BUILDING", 0 AS "other_X" FROM v_app""", ["v_app"])
def encode_rule_onehot(spark, sf):
    return e.rule_onehot(view(spark, sf, "v_app"), REGION_RULES).select("id", *REGION_RULES)
