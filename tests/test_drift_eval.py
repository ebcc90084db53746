import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import drift, evaluate as ev, explain, score


@pytest.fixture(scope="module")
def ref(spark):
    rng = np.random.default_rng(2)
    n = 1000
    return spark.createDataFrame(pd.DataFrame({"id": range(n), "a": rng.normal(size=n), "b": rng.uniform(0, 100, n), "const": 4.0, "flag": rng.integers(0, 2, n)}))


def test_same_data_has_no_drift(ref):
    rows = drift.drift_table(ref, ref, ["id"]).collect()
    assert {r.psi for r in rows} == {0.0} and {r.drift_level for r in rows} == {"none"}
    alert = drift.drift_alert(drift.drift_table(ref, ref, ["id"])).first()
    assert alert.status == "ok" and alert.drifted_features == []


def test_a_shift_is_major_and_critical(ref):
    moved = ref.withColumn("a", F.col("a") + 3)
    t = drift.drift_table(ref, moved, ["id"])
    first = t.first()
    assert (first.feature, first.drift_level) == ("a", "major")
    assert drift.drift_alert(t).first().status == "critical"


def test_undefined_and_constant(ref):
    empty = ref.withColumn("b", F.lit(None).cast("double"))
    rows = {r.feature: r for r in drift.drift_table(ref, empty, ["id"]).collect()}
    assert rows["b"].psi is None and rows["b"].drift_level == "undefined" and rows["const"].psi == 0.0
    last = drift.drift_table(ref, empty, ["id"]).collect()[-1]
    assert last.feature == "b"


def test_flags_are_blind_in_quantile_bins_only(ref):
    flipped = ref.withColumn("flag", F.lit(1))
    assert drift.psi(ref, flipped, ["flag"]).first().psi == 0.0
    assert drift.psi(ref, flipped, ["flag"], bucket_type="categorical").first().psi > 1
    with pytest.raises(ValueError):
        drift.psi(ref, flipped, ["flag"], bucket_type="magic")


def test_psi_by_hand(spark, ref):
    cur = ref.where("a > -0.5")
    a, c = (np.array([r.a for r in t.select("a").collect()]) for t in (ref, cur))
    e = np.unique(np.quantile(a, np.linspace(0, 1, 11)))
    e[0], e[-1] = -np.inf, np.inf
    r, q = np.histogram(a, e)[0] / len(a), np.histogram(c, e)[0] / len(c)
    r, q = np.where(r == 0, 1e-4, r), np.where(q == 0, 1e-4, q)
    assert drift.psi(ref, cur, ["a"]).first().psi == pytest.approx(float(np.sum((q - r) * np.log(q / r))), abs=1e-9)


def test_exchanges_do_not_grow_with_features(ref):
    def n(feats):
        return drift.psi(ref, ref, feats)._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    assert n(["a"]) == n(["a", "b", "const", "flag"])


@pytest.mark.parametrize("chi2, dof, p", [(3.841458820694124, 1, 0.05), (11.070497693516351, 5, 0.05), (0.5, 3, 0.9189), (40.0, 10, 1.694474e-05)])
def test_chi_square_tail(chi2, dof, p):
    assert drift._upper_gamma(dof / 2, chi2 / 2) == pytest.approx(p, rel=2e-3)


def test_two_sample_distances(spark, ref):
    cur = ref.withColumn("a", F.col("a") * 1.5 + 0.2)
    x, y = (np.sort([r.a for r in t.select("a").collect()]) for t in (ref, cur))
    grid = np.concatenate([x, y])
    ks = np.max(np.abs(np.searchsorted(x, grid, "right") / len(x) - np.searchsorted(y, grid, "right") / len(y)))
    assert drift.drift_ks(ref, cur, ["a"]).first().ks == pytest.approx(ks, abs=1e-12)
    w = np.mean(np.abs(x - y))  # equal sizes: mean distance of the sorted samples
    assert drift.drift_wasserstein(ref, cur, ["a"]).first().distance == pytest.approx(w, rel=1e-9)
    same = drift.drift_ks(ref, ref, ["a"]).first()
    assert same.ks == 0.0 and same.p_value == 1.0


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(8)
    n = 600
    p = np.round(rng.random(n), 2)
    return pd.DataFrame({"id": range(n), "p": p, "y": (rng.random(n) < p).astype(int)})


def test_ranking_metrics_by_hand(spark, scored):
    got = ev.ranking_metrics(spark.createDataFrame(scored), "p", "y").first()
    pos, neg = scored[scored.y == 1].p.values, scored[scored.y == 0].p.values
    auc = np.mean((pos[:, None] > neg).astype(float) + 0.5 * (pos[:, None] == neg))
    cuts = np.unique(scored.p)
    tpr, fpr = (np.array([(v >= t).mean() for t in cuts]) for v in (pos, neg))
    tp, fp = (np.array([(v >= t).sum() for t in cuts]) for v in (pos, neg))
    ap = sum((tpr[i] - (tpr[i + 1] if i + 1 < len(cuts) else 0)) * tp[i] / (tp[i] + fp[i]) for i in range(len(cuts)))
    assert got.roc_auc == pytest.approx(auc, abs=1e-12) and got.gini == pytest.approx(2 * auc - 1, abs=1e-12)
    assert got.ks == pytest.approx(np.max(tpr - fpr), abs=1e-12) and got.pr_auc == pytest.approx(ap, abs=1e-12)


@pytest.mark.parametrize("strategy", ["cost", "f1_positive", "f1_macro", "balanced_accuracy"])
def test_threshold_is_the_lowest_of_the_best(spark, scored, strategy):
    got = ev.threshold_search(spark.createDataFrame(scored), "p", "y", strategy, 0.1, 0.9).first()

    def objective(t):
        hit = scored.p >= t
        tp, fp = (hit & (scored.y == 1)).sum(), (hit & (scored.y == 0)).sum()
        fn, tn = (~hit & (scored.y == 1)).sum(), (~hit & (scored.y == 0)).sum()
        f1, f0 = 2 * tp / (2 * tp + fp + fn), 2 * tn / (2 * tn + fp + fn)
        return {"cost": -(10 * fn + fp), "f1_positive": f1, "f1_macro": (f1 + f0) / 2, "balanced_accuracy": (tp / (tp + fn) + tn / (tn + fp)) / 2}[strategy]

    cuts = [t for t in sorted(scored.p.unique()) if 0.1 <= t <= 0.9]
    best = max(objective(t) for t in cuts)
    assert got.threshold == min(t for t in cuts if objective(t) >= best - 1e-12)


def test_no_scores_gives_one_half(spark):
    empty = spark.createDataFrame([], "p double, y int")
    assert ev.threshold_search(empty, "p", "y").first().threshold == 0.5


def test_single_class_metrics_are_defined(spark):
    one = spark.createDataFrame([(0.2, 0), (0.7, 0)], "p double, y int")
    m = ev.metrics_at_threshold(one, "p", "y", 0.5).first()
    assert (m.recall_positive, m.precision_positive, m.fp) == (0.0, 0.0, 1)
    assert ev.roc_auc(one, "p", "y").first().roc_auc is None


def test_scoring_contract(spark):
    df = spark.createDataFrame([(1, 0.2, 0.0), (2, 0.9, 0.0)], ["id", "x 1", "x2"])
    run = lambda d: d.withColumn("probability", F.col("x_1"))
    rows = score.score_features(df, ["x_1", "x2"], run, {"threshold": 0.9}, "id").orderBy("id").collect()
    assert [(r.id, r.predicted_class) for r in rows] == [(1, 0), (2, 1)]
    with pytest.raises(ValueError, match="missing"):
        score.score_features(df, ["x_1", "gone"], run, 0.5)


def test_permutation_finds_the_driver(spark, scored):
    df = spark.createDataFrame(scored).withColumn("noise", F.rand(1))
    res = explain.permutation_importance(df, "id", "y", ["p", "noise"], lambda d: d.withColumn("probability", F.col("p")), repeats=2).collect()
    assert res[0].feature == "p" and res[0].importance > 0.1 and abs(res[1].importance) < 1e-12
