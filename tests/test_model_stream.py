"""MLlib families, search, the whole workflow, and streaming parity."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import evaluate as ev, model, model as m, quality as q, score as sc
from riskframe.plans import credit, workflow
from riskframe.streaming import jobs

FEATS = ["f0", "f1", "f2"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 200
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=n) > 0.8).astype(int)
    pdf = pd.DataFrame(x, columns=FEATS).assign(id=range(n), y=y)
    return m.with_weights(m.prepare(spark.createDataFrame(pdf), FEATS, "y", ["id"]), "y")


@pytest.mark.parametrize("kind, hp", [
    (m.RANDOM_FOREST, {"n_estimators": 5, "max_depth": 3}), (m.HIST_BOOSTING, {"max_iter": 3, "max_depth": 2}),
    (m.LEAFWISE_BOOSTING, {"n_estimators": 3, "num_leaves": 4}), (m.CLASSIC_BOOSTING, {"n_estimators": 3, "max_depth": 2, "random_state": 1}),
    (m.WOE_SCORECARD, {"woe__n_bins": 4, "clf__C": 0.5})])
def test_every_family_fits_and_scores(data, kind, hp):
    fitted = m.build_estimator(kind, hp, FEATS, "y").fit(data)
    out = m.probability(fitted, data)
    lo, hi, n = out.agg(F.min("probability"), F.max("probability"), F.count("probability")).first()
    assert 0 <= lo < hi <= 1 and n == 200
    assert ev.roc_auc(out, "probability", "y").first().roc_auc > 0.6


def test_unknown_family_and_missing_type(data):
    with pytest.raises(ValueError):
        m.build_estimator("Oracle", {}, FEATS, "y")
    with pytest.raises(KeyError):
        m.train_final(data, "id", "y", {"n_estimators": 3}, FEATS)


@pytest.mark.parametrize("method", ["isotonic", "sigmoid"])
def test_calibrated_scores_are_probabilities(data, method):
    c = m.calibrate(data, "id", "y", m.RANDOM_FOREST, {"n_estimators": 4, "max_depth": 3}, FEATS, method, 3)
    out = m.probability(c, data).select("probability").toPandas().probability
    assert len(c.members) == 3 and out.between(0, 1).all() and out.nunique() > 3


def test_weights_balance_the_classes(data):
    per = data.groupBy("y").agg(F.sum(m.WEIGHT).alias("w")).toPandas().w
    assert per.iloc[0] == pytest.approx(per.iloc[1])


def test_winner_rules():
    g, s = {"cv_score": 0.7, "model_type": "a"}, {"cv_score": 0.7, "model_type": "b"}
    assert m.choose_best(g, s)["model_type"] == "a"
    assert m.choose_best(g, {**s, "cv_score": 0.71})["model_type"] == "b"
    assert m.choose_best({}, {"model_type": "b"})["model_type"] == "b"


def test_draws_are_seeded():
    import random
    a = [m.draw_params(random.Random(3), m.SEARCH_SPACES[k]) for k in m.FAMILIES]
    assert a == [m.draw_params(random.Random(3), m.SEARCH_SPACES[k]) for k in m.FAMILIES]
    assert 0.01 <= a[4]["clf__C"] <= 2.0 and a[0]["n_estimators"] % 50 == 0


def applications(spark, n=400, labelled=True):
    rng = np.random.default_rng(9 if labelled else 10)
    cols = {credit.ID: np.arange(n) + (0 if labelled else 10_000)}
    for c, b in credit.NUMERIC_RULES.items():
        lo, hi = b.get("min_value"), b.get("max_value")
        if hi is not None and lo is None:
            cols[c] = -rng.integers(1, 15000, n).astype(float) if hi <= 0 else np.where(rng.random(n) < 0.18, float(credit.SENTINEL), -rng.integers(1, 9000, n))
        elif hi is not None:
            cols[c] = rng.uniform(lo, hi, n)
        else:
            cols[c] = lo + np.round(rng.gamma(2.0, 3.0 if c.startswith("CNT") else 50_000.0 if c.startswith("AMT_") and "BUREAU" not in c else 1.0, n))
    for c, values in credit.VALUE_SETS.items():
        cols[c] = rng.choice(values, n)
    cols["OCCUPATION_TYPE"] = np.where(rng.random(n) < 0.3, None, cols["OCCUPATION_TYPE"])
    cols["EXT_SOURCE_3"] = np.where(rng.random(n) < 0.2, np.nan, cols["EXT_SOURCE_3"])
    cols["EXT_SOURCE_1"] = np.where(rng.random(n) < 0.56, np.nan, rng.random(n))
    if labelled:
        cols[credit.TARGET] = (rng.random(n) < 0.5 * (1 - cols["EXT_SOURCE_2"])).astype(int)
    return spark.createDataFrame(pd.DataFrame(cols))


def test_workflow_end_to_end(spark, tmp_path):
    cfg = workflow.Settings(n_features=8, rfe_step=60, rfe_trees=3, n_trials=0, folds=2, calibration_folds=2,
                            grids={m.RANDOM_FOREST: {"n_estimators": [3], "max_depth": [3]}})
    root = str(tmp_path)
    res = workflow.train(applications(spark), applications(spark, 100, labelled=False), root, cfg)
    assert len(res["features"]) == 8 and "sk_id_curr" not in res["features"] and 0 <= res["threshold"] <= 1
    row = res["metrics"].first()
    assert row.test_gini == pytest.approx(2 * row.test_roc_auc - 1)
    assert spark.read.parquet(f"{root}/08_reporting/train_quality").where("not success").count() == 0
    assert "EXT_SOURCE_1" in res["cleaning"].drop_missing
    alert = workflow.monitor(res["inputs"]["train"], res["inputs"]["train"], root).first()
    assert alert.status == "ok" and alert.generated_at is not None


def test_bad_applications_stop_the_workflow(spark, tmp_path):
    bad = applications(spark, 60).withColumn("AMT_CREDIT", F.lit(0.0))
    with pytest.raises(q.QualityGateError):
        workflow.validate(bad, str(tmp_path), "train")
    assert spark.read.parquet(f"{tmp_path}/08_reporting/train_quality").where("not success").count() == 1


def test_child_tables_join_to_one_row_per_applicant(spark):
    app = spark.createDataFrame([(1, 1000.0, 500.0, 2.0), (2, 1000.0, 500.0, 3.0)], f"{credit.ID} long, AMT_INCOME_TOTAL double, AMT_CREDIT double, CREDIT_INCOME_RATIO double")
    pos = spark.createDataFrame([(1, 7, -1, 10.0, 5.0, "Active", 0, 0), (1, 7, -2, 10.0, 6.0, "Completed", 3, 0), (1, 8, -1, 4.0, 1.0, "Active", 0, 0)],
                                f"{credit.ID} long, SK_ID_PREV long, MONTHS_BALANCE int, CNT_INSTALMENT double, CNT_INSTALMENT_FUTURE double, NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int")
    inst = spark.createDataFrame([(1, 7, -10.0, -12.0, 100.0, 100.0), (1, 7, -5.0, None, 100.0, None)],
                                 f"{credit.ID} long, SK_ID_PREV long, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double")
    rows = {r[credit.ID]: r for r in credit.with_child_features(app, {"pos_cash_balance": pos, "installments_payments": inst}).collect()}
    assert len(rows) == 2
    a, b = rows[1], rows[2]
    assert (a.pos_n_contracts, a.pos_n_months, a.pos_last_month, a.pos_n_dpd_months) == (2, 3, -1, 1)
    assert a.inst_on_time_ratio == 0.5 and a.inst_underpayment == 0.5 and a.PAYMENT_RELIABILITY == pytest.approx(0.5 * (1 - 1 / 3))
    assert b.pos_n_months == 0 and b.inst_underpayment == 0.0 and "TOTAL_DEBT_TO_INCOME" not in b.asDict()


def test_stream_equals_batch(spark, tmp_path):
    df = spark.range(300).select("id", (F.col("id") % 7).cast("double").alias("x"))
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    run = lambda d: sc.linear_score({"x": 0.3}, -1.0)(d).select("id", "probability")
    stream = jobs.file_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    got = jobs.stream_score(stream, run, str(tmp_path / "out"), str(tmp_path / "chk"))
    assert got.orderBy("id").collect() == run(df).orderBy("id").collect()


def test_window_counts_equal_on_stream_and_table(spark, tmp_path):
    df = spark.range(200).select((F.timestamp_seconds(F.col("id") * 600)).alias("ts"), (F.col("id") % 11).cast("double").alias("x"))
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    batch = jobs.windowed_bin_counts(df, "ts", {"x": [3.0, 6.0]}, "6 hours")
    live = jobs.run_latest(jobs.windowed_bin_counts(jobs.file_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1), "ts", {"x": [3.0, 6.0]}, "6 hours"),
                           str(tmp_path / "out"), str(tmp_path / "chk"))
    key = lambda t: sorted(tuple(r) for r in t.collect())
    assert key(live) == key(batch) and batch.agg(F.sum("n")).first()[0] == 200


def test_late_windows_close_and_append(spark, tmp_path):
    df = spark.range(100).select(F.timestamp_seconds(F.col("id") * 3600).alias("ts"), F.col("id").cast("double").alias("x"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    counts = jobs.windowed_bin_counts(jobs.file_stream(spark, str(tmp_path / "in"), df.schema), "ts", {"x": [50.0]}, "1 day")
    out = jobs.run_to_table(counts, str(tmp_path / "out"), str(tmp_path / "chk"))
    assert out.agg(F.sum("n")).first()[0] == 96  # the last, unfinished day stays open


def test_closed_windows_are_emitted_once(spark, tmp_path):
    from datetime import datetime, timedelta
    start, schema = datetime(2024, 5, 1), "ts timestamp, x double, y double"
    rows = lambda lo, hi: [(start + timedelta(hours=i), float(i % 10), None if i % 3 else float(i)) for i in range(lo, hi)]
    ref = spark.createDataFrame([("x", "0", 5), ("x", "1", 3), ("x", "2", 2), ("y", "0", 1), ("y", "1", 1)], "feature string, bin string, n_ref long")
    edges = {"x": [5.0, 8.0], "y": [50.0]}
    late = [(start, 1.0, 1.0)]  # comes when its window is closed
    seen, dropped = [], 0
    for i, part in enumerate([rows(0, 30), rows(30, 60), late, rows(60, 100)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = jobs.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, files_per_batch=1)
        out, n = jobs.run_closed(jobs.closed_window_psi(stream, "ts", edges, ref, "1 day"), str(tmp_path / "out"), str(tmp_path / "chk"))
        dropped += n
        seen.append(out.select("start").distinct().count())
    assert seen == [1, 2, 2, 4] and dropped == 2  # both features of the late row
    got = {(r.start, r.feature): r for r in out.collect()}
    assert len(got) == out.count() == 8
    whole = spark.createDataFrame(rows(0, 96), schema)
    want = jobs.window_psi(jobs.windowed_bin_counts(whole, "ts", edges, "1 day").withColumn("bin", F.col("bin").cast("string")), ref).collect()
    for r in want:
        assert got[r.start, r.feature].psi == pytest.approx(r.psi, abs=1e-12) and got[r.start, r.feature].drift_level == r.drift_level
    assert {r.n for k, r in got.items() if k[1] == "x"} == {24} and {r.n for k, r in got.items() if k[1] == "y"} == {8}


@pytest.mark.parametrize("kind", ["card", "forest", "line"])
def test_importance_of_every_kind_of_model(spark, data, kind):
    from riskframe.operators import explain
    if kind == "card":
        fitted = m.WoeScorecard(FEATS, "y", n_bins=4, max_iter=50).fit(data)
        want = {f: abs(w) for f, w in fitted.coefficients.items()}
    else:
        fitted = m.calibrate(data, "id", "y", m.RANDOM_FOREST if kind == "forest" else m.WOE_SCORECARD,
                             {"n_estimators": 5} if kind == "forest" else {"woe__n_bins": 4}, FEATS, "sigmoid", 2)
        want = None
    got = {r.feature: r.importance for r in explain.model_importance(fitted, FEATS, spark).collect()}
    assert set(got) == set(FEATS) and max(got, key=got.get) == "f0"
    assert got == pytest.approx(want) if want else sum(got.values()) == pytest.approx(1.0)
    with pytest.raises(ValueError, match="permutation"):
        explain.model_importance(object(), FEATS, spark)


def test_replayed_quarantine_leaves_no_duplicates(spark, tmp_path):
    df = spark.range(50).select("id", (F.col("id") - 10).alias("v"))
    df.write.parquet(str(tmp_path / "in"))
    args = ([q.between("v", 0)], str(tmp_path / "good"), str(tmp_path / "bad"))
    for chk in ("c1", "c2"):  # the second run starts without a checkpoint and replays batch 0
        good, bad = jobs.stream_quarantine(jobs.file_stream(spark, str(tmp_path / "in"), df.schema), *args, str(tmp_path / chk))
    assert (good.count(), bad.count()) == (40, 10)


def test_models_are_stored_and_loaded(spark, tmp_path):
    rows = [(i, i % 2, float(i % 7) + i % 2, f"v{i % 5}") for i in range(120)]
    df = model.with_weights(spark.createDataFrame(rows, "id long, y int, a double, c string"), "y")
    kinds = {"forest": model.calibrate(df, "id", "y", model.RANDOM_FOREST, {"n_estimators": 3, "max_depth": 2}, ["a"], "isotonic", 2),
             "line": model.calibrate(df, "id", "y", model.RANDOM_FOREST, {"n_estimators": 3, "max_depth": 2}, ["a"], "sigmoid", 2),
             "card": model.WoeScorecard(["a", "c"], "y", max_iter=20, max_levels=3).fit(df)}
    for name, fitted in kinds.items():
        model.save_model(fitted, f"{tmp_path}/{name}", spark)
        again = model.load_model(f"{tmp_path}/{name}", spark)
        both = model.probability(again, model.probability(fitted, df, "p0"), "p1")
        assert both.where("p0 != p1 OR p0 IS NULL OR p1 IS NULL").count() == 0, name


def test_search_fits_once_per_fold(spark, monkeypatch):
    fits, build = [], model.build_estimator

    class Counted:
        def __init__(self, inner, hp):
            self.inner, self.hp = inner, hp

        def fit(self, df):
            fits.append(self.hp["max_depth"])
            return self.inner.fit(df)

    monkeypatch.setattr(model, "build_estimator", lambda kind, hp, *a, **k: Counted(build(kind, hp, *a, **k), hp))
    rows = [(i, i % 2, float(i % 7) + i % 2) for i in range(120)]
    best, trials = model.grid_search(spark.createDataFrame(rows, "id long, y int, a double"), "id", "y", ["a"],
                                     {model.RANDOM_FOREST: {"n_estimators": [2], "max_depth": [1, 2]}}, folds=3)
    assert sorted(fits) == [1] * 3 + [2] * 3 and trials.count() == 2 and best["search_strategy"] == "grid"


def test_search_repeats_and_tries_every_model_once(spark, monkeypatch):
    rows = spark.createDataFrame([(i, i % 2, float(i % 7) + i % 2) for i in range(120)], "id long, y int, a double")
    seen, scores = [], model._cv_scores
    monkeypatch.setattr(model, "_cv_scores", lambda data, label, features, combos, *a: (seen.append((data, combos)), scores(data, label, features, combos, *a))[1])
    grids = {model.HIST_BOOSTING: {"max_iter": [1], "max_depth": [1, 2], "l2_regularization": [0.0, 1.0]}}
    best, trials = model.grid_search(rows, "id", "y", ["a"], grids, folds=3, repeats=2)
    assert trials.count() == 2 and "l2_regularization" not in best and 0.5 < best["cv_score"] <= 1
    folds = seen[0][0].select("id", "y", "__folds").collect()
    for r in (0, 1):
        sizes = {(y, f): sum(x.y == y and x["__folds"][r] == f for x in folds) for y in (0, 1) for f in range(3)}
        assert set(sizes.values()) == {20}
    assert sum(x["__folds"][0] != x["__folds"][1] for x in folds) > 40  # the repeats are foldings of their own
    one = model._cv_scores(seen[0][0], "y", ["a"], seen[0][1], 3, 1, 42, 2)
    assert len(one) == 2 and all(0 <= s <= 1 for s in one)
    space = {model.RANDOM_FOREST: {"n_estimators": ("int", 1, 2), "max_depth": ("int", 1, 1)}}
    _, trials = model.random_search(rows, "id", "y", ["a"], n_trials=5, families=list(space), spaces=space, folds=2)
    assert trials.select("params").distinct().count() == trials.count() == 2  # the space has two points


def test_settings_without_effect_are_refused():
    for kind, hp in ((model.HIST_BOOSTING, {"l2_regularization": 1.0}), (model.LEAFWISE_BOOSTING, {"reg_lambda": 2.0}),
                     (model.RANDOM_FOREST, {"n_estimator": 3}), (model.CLASSIC_BOOSTING, {"max_features": "sqrt"})):
        with pytest.raises(ValueError, match="cannot honour"):
            model.build_estimator(kind, hp, ["a"], "y")
    depth = lambda kind, **hp: model.build_estimator(kind, hp, ["a"], "y").getStages()[-1].getMaxDepth()
    assert depth(model.HIST_BOOSTING, l2_regularization=0.0, max_depth=6) == 6 and depth(model.HIST_BOOSTING) == 5
    assert depth(model.HIST_BOOSTING, max_depth=9, max_leaf_nodes=15) == 4 and depth(model.HIST_BOOSTING, max_depth=3, max_leaf_nodes=60) == 3
    assert depth(model.LEAFWISE_BOOSTING, num_leaves=7) == 3 and depth(model.LEAFWISE_BOOSTING, num_leaves=64, max_depth=-1) == 6
    kept = {k: {p for p in model.SEARCH_SPACES[k] if p not in model.HONOURED[k]} for k in model.FAMILIES}
    assert {p for v in kept.values() for p in v} == {"l2_regularization", "reg_lambda"}  # all else in the spaces has an effect


def test_unique_rules_hold_across_batches_and_restarts(spark, tmp_path):
    from riskframe.operators.quality import unique
    rules = [q.between("v", 0), unique("id"), unique("code")]
    parts = [[(1, "a", 1), (2, "b", -1), (None, "c", 1), (5, "e", 1)], [(1, "f", 2), (3, None, 1), (None, "g", 1)], [(3, None, -1), (4, "c", 1), (5, "h", 2)]]
    schema, paths = "id long, code string, v int", [str(tmp_path / n) for n in ("good", "bad", "chk")]
    rows = []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        rows += part
        stream = jobs.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, files_per_batch=1)
        got = jobs.stream_quarantine(stream, rules, *paths)  # each run goes on from the one before
        want = q.quarantine(spark.createDataFrame(rows, schema), rules)
        for a, b in zip(got, want):
            assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert got[0].count() == 1  # (4, c) shares its code with an earlier row; (None, g) is alone


def test_counts_of_old_keys_are_forgotten(spark, tmp_path):
    from datetime import datetime
    at = [datetime(2024, 1, d, h) for d, h in ((1, 0), (1, 1), (2, 0), (9, 0), (9, 2), (20, 0))]
    keys = ["a", "a", "b", "b", "c", "a"]
    for i, (t, k) in enumerate(zip(at, keys)):
        spark.createDataFrame([(k, t)], "k string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], "k string, ts timestamp").schema, files_per_batch=1)
    found = jobs.stream_repeated_keys(stream, "k", str(tmp_path / "out"), str(tmp_path / "chk"), "ts", 86_400)
    assert [r.key for r in found.collect()] == ["a"]  # b comes again after a week
