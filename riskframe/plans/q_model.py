"""Training, search and calibration on the applicant view (small forests; the settings scale with the cluster)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from riskframe.functions.frames import small_table
from riskframe.operators import evaluate as ev, explain as x, model as m, score as sc
from riskframe.operators.split import stratified_split
from riskframe.plans.registry import query
from riskframe.plans.settings import SEED
from riskframe.plans.views import staged
from riskframe.sources.staging import fresh_path

FEATURES = ["days_emp", "cnt_a", "amt_a", "amt_b", "amt_c", "near_const"]


def data(spark, sf):
    """Weighted training split and plain validation split."""
    app = m.prepare(staged(spark, sf, "v_app"), FEATURES, "target", ["id"])
    parts = stratified_split(app, "id", "target", 0.25, SEED)
    train, val = parts.where("split = 'train'").drop("split"), parts.where("split = 'validation'").drop("split")
    return train, val


def panel(model, train, val):
    out = None
    for name, t in (("train", train), ("validation", val)):
        row = ev.ranking_metrics(m.probability(model, t, "p").select("p", "target"), "p", "target").withColumn("split", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out.drop("feature")


@query("train_random_forest")
def train_random_forest(spark, sf):
    train, val = data(spark, sf)
    est = m.build_estimator(m.RANDOM_FOREST, {"n_estimators": 10, "max_depth": 4}, FEATURES, "target")
    return panel(est.fit(m.with_weights(train, "target")), train, val)


@query("train_gbt")
def train_gbt(spark, sf):
    train, val = data(spark, sf)
    out = None
    for kind, hp in ((m.HIST_BOOSTING, {"max_iter": 4, "max_depth": 3}), (m.LEAFWISE_BOOSTING, {"n_estimators": 4, "num_leaves": 7}),
                     (m.CLASSIC_BOOSTING, {"n_estimators": 4, "max_depth": 2})):
        model = m.build_estimator(kind, hp, FEATURES, "target").fit(m.with_weights(train, "target"))
        row = panel(model, train, val).withColumn("model_type", F.lit(kind))
        out = row if out is None else out.unionByName(row)
    return out


@query("train_woe_scorecard")
def train_woe_scorecard(spark, sf):
    app = staged(spark, sf, "v_app")
    feats = [*FEATURES, "segment", "nation"]
    parts = stratified_split(m.prepare(app, feats, "target", ["id"], ["segment", "nation"], fill=False), "id", "target", 0.25, SEED)
    train = m.with_weights(parts.where("split = 'train'"), "target")
    model = m.build_estimator(m.WOE_SCORECARD, {"woe__n_bins": 5, "clf__C": 0.1}, feats, "target").fit(train)
    return panel(model, train.drop(m.WEIGHT), parts.where("split = 'validation'"))


@query("search_grid")
def search_grid(spark, sf):
    train, _ = data(spark, sf)
    best, trials = m.grid_search(train, "id", "target", FEATURES, {
        m.RANDOM_FOREST: {"n_estimators": [5], "max_depth": [2, 4]}, m.CLASSIC_BOOSTING: {"n_estimators": [3], "max_depth": [2]}}, folds=3)
    return trials.withColumn("is_best", F.col("params") == json.dumps({k: v for k, v in best.items() if k not in m.METADATA_KEYS}, sort_keys=True))


@query("search_grid_repeated")
def search_grid_repeated(spark, sf):
    """Two foldings per candidate; a setting MLlib lacks does not make a second trial."""
    train, _ = data(spark, sf)
    _, trials = m.grid_search(train, "id", "target", FEATURES, {
        m.HIST_BOOSTING: {"max_iter": [2], "max_depth": [2, 3], "l2_regularization": [0.0, 1.0]}}, folds=3, repeats=2)
    return trials


@query("search_random")
def search_random(spark, sf):
    train, _ = data(spark, sf)
    spaces = {m.RANDOM_FOREST: {"n_estimators": ("int", 4, 8, 2), "max_depth": ("int", 2, 4), "max_features": ("choice", ["sqrt", "log2"])},
              m.CLASSIC_BOOSTING: {"n_estimators": ("int", 2, 4), "learning_rate": ("log", 0.03, 0.2), "max_depth": ("int", 2, 3)}}
    _, trials = m.random_search(train, "id", "target", FEATURES, n_trials=3, families=list(spaces), spaces=spaces, folds=3)
    return trials


def _calibrated(spark, sf, method):
    train, val = data(spark, sf)
    model = m.calibrate(m.with_weights(train, "target"), "id", "target", m.RANDOM_FOREST, {"n_estimators": 5, "max_depth": 3}, FEATURES, method, 3)
    return ev.calibration_curve(m.probability(model, val, "p"), "p", "target", 5).withColumn("method", F.lit(method))


@query("calibrate_isotonic")
def calibrate_isotonic(spark, sf):
    return _calibrated(spark, sf, "isotonic")


@query("calibrate_sigmoid")
def calibrate_sigmoid(spark, sf):
    return _calibrated(spark, sf, "sigmoid")


@query("train_final")
def train_final(spark, sf):
    train, val = data(spark, sf)
    best = {"model_type": m.RANDOM_FOREST, "n_estimators": 5, "max_depth": 3, "cv_score": 0.5, "search_strategy": "grid"}
    return panel(m.train_final(train, "id", "target", best, FEATURES, calibration="isotonic"), train, val)


@query("explain_model_importance")
def explain_model_importance(spark, sf):
    train, _ = data(spark, sf)
    fitted = m.build_estimator(m.RANDOM_FOREST, {"n_estimators": 10, "max_depth": 4}, FEATURES, "target").fit(m.with_weights(train, "target"))
    return x.model_importance(fitted.stages[-1], FEATURES, spark)


@query("predict_stored", "SELECT count(*)::BIGINT AS n_rows, count(DISTINCT id) AS n_ids, 0::BIGINT AS n_changed, 0::BIGINT AS n_class_wrong FROM v_app", ["v_app"])
def predict_stored(spark, sf):
    """Fit, store, load afresh, score every row: rows, ids, probabilities that changed by storing, classes off the threshold."""
    train, _ = data(spark, sf)
    best = {"model_type": m.RANDOM_FOREST, "n_estimators": 5, "max_depth": 3, "cv_score": 0.5, "search_strategy": "grid"}
    fitted, path = m.train_final(train, "id", "target", best, FEATURES, calibration="isotonic"), fresh_path(spark, "model")
    m.save_model(fitted, path, spark)
    rows = m.prepare(staged(spark, sf, "v_app"), FEATURES, None, ["id"])
    both = m.probability(m.load_model(path, spark), m.probability(fitted, rows, "p0"), "p1").withColumn("c", sc.decide(F.col("p1"), 0.1))
    return both.agg(F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.count_if(F.col("p0") != F.col("p1")).alias("n_changed"),
                    F.count_if(F.col("c") != (F.col("p1") >= 0.1).cast("int")).alias("n_class_wrong"))
