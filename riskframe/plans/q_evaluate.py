"""Metrics, thresholds, calibration and explanation on the scored view."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import evaluate as ev, explain as x, model as m, score as sc
from riskframe.operators.isotonic import fit_isotonic
from riskframe.plans.registry import query
from riskframe.plans.views import staged, view

CUM = """g AS (SELECT p, sum(label)::BIGINT AS pos, (count(*) - sum(label))::BIGINT AS neg FROM v_scored GROUP BY p),
c AS (SELECT p, pos, neg, sum(pos) OVER (ORDER BY p) - pos AS pb, sum(neg) OVER (ORDER BY p) - neg AS nb, sum(pos) OVER () AS tp_all, sum(neg) OVER () AS tn_all FROM g),
rank AS (SELECT sum(pos * (nb + neg / 2)) / (max(tp_all)::DOUBLE * max(tn_all)) AS auc, max((tp_all - pb) / tp_all - (tn_all - nb) / tn_all) AS ks,
 sum(pos / tp_all * ((tp_all - pb) / ((tp_all - pb) + (tn_all - nb)))) AS ap FROM c)"""


def cm_sql(t, src="v_scored"):
    return f"SELECT count_if(p >= {t} AND label = 1)::BIGINT AS tp, count_if(p >= {t} AND label = 0)::BIGINT AS fp, count_if(p < {t} AND label = 1)::BIGINT AS fn, count_if(p < {t} AND label = 0)::BIGINT AS tn FROM {src}"


PANEL = """coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_positive,
 (coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) + coalesce(2.0 * tn / nullif(2 * tn + fp + fn, 0), 0)) / 2 AS f1_macro,
 coalesce(tp / nullif(tp + fp, 0), 0) AS precision_positive, coalesce(tp / nullif(tp + fn, 0), 0) AS recall_positive,
 (coalesce(tp / nullif(tp + fp, 0), 0) + coalesce(tn / nullif(tn + fn, 0), 0)) / 2 AS precision_macro,
 (coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2 AS recall_macro,
 (coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2 AS balanced_accuracy,
 (tp + tn) / (tp + fp + fn + tn) AS accuracy, 10.0 * fn + fp AS expected_cost, (10.0 * fn + fp) / (tp + fp + fn + tn) AS cost_per_decision"""
PANEL_D = "f1_positive f1_macro precision_positive recall_positive precision_macro recall_macro balanced_accuracy accuracy expected_cost cost_per_decision"


def scored(spark, sf):
    return staged(spark, sf, "v_scored")


@query("evaluate_predictions", f"""WITH {CUM}, cm AS ({cm_sql(0.6)}) SELECT auc AS roc_auc, ap AS pr_auc, (tp + tn) / (tp + fp + fn + tn) AS accuracy_at_threshold,
 tp / (tp + fp) AS precision_at_threshold, tp / (tp + fn) AS recall_at_threshold, 2.0 * tp / (2 * tp + fp + fn) AS f1_at_threshold, 0.6 AS threshold,
 (tp + fp) / (tp + fp + fn + tn) AS positive_rate_predicted, (tp + fn) / (tp + fp + fn + tn) AS positive_rate_actual, (tp + fp + fn + tn)::BIGINT AS n_rows FROM rank, cm""", ["v_scored"],
       doubles="roc_auc pr_auc accuracy_at_threshold precision_at_threshold recall_at_threshold f1_at_threshold threshold positive_rate_predicted positive_rate_actual")
def evaluate_predictions(spark, sf):
    s = scored(spark, sf)
    return ev.evaluate_predictions(s.select("id", "p"), s.select("id", "label"), "id", "p", "label", 0.6)


@query("metric_roc_auc", f"WITH {CUM} SELECT auc AS roc_auc FROM rank", ["v_scored"], doubles="roc_auc", digits=9)
def metric_roc_auc(spark, sf):
    return ev.roc_auc(scored(spark, sf), "p", "label")


@query("metric_gini", f"WITH {CUM} SELECT 2 * auc - 1 AS gini FROM rank", ["v_scored"], doubles="gini", digits=9)
def metric_gini(spark, sf):
    return ev.gini(scored(spark, sf), "p", "label")


@query("metric_ks", f"WITH {CUM} SELECT ks FROM rank", ["v_scored"], doubles="ks", digits=9)
def metric_ks(spark, sf):
    return ev.ks_statistic(scored(spark, sf), "p", "label")


@query("metric_pr_auc", f"WITH {CUM} SELECT ap AS pr_auc FROM rank", ["v_scored"], doubles="pr_auc", digits=9)
def metric_pr_auc(spark, sf):
    return ev.pr_auc(scored(spark, sf), "p", "label")


@query("metric_brier", "SELECT avg(power(p - label, 2)) AS brier FROM v_scored", ["v_scored"], doubles="brier", digits=9)
def metric_brier(spark, sf):
    return view(spark, sf, "v_scored").agg(ev.brier_expr(F.col("p"), F.col("label")).alias("brier"))


LOGLOSS = "-avg(CASE WHEN label = 1 THEN ln(greatest(least(p, 1 - 2.220446049250313e-16::DOUBLE), 2.220446049250313e-16::DOUBLE)) ELSE ln(1 - greatest(least(p, 1 - 2.220446049250313e-16::DOUBLE), 2.220446049250313e-16::DOUBLE)) END)"


@query("metric_log_loss", f"SELECT {LOGLOSS} AS log_loss FROM v_scored", ["v_scored"], doubles="log_loss", digits=9)
def metric_log_loss(spark, sf):
    return view(spark, sf, "v_scored").agg(ev.log_loss_expr(F.col("p"), F.col("label")).alias("log_loss"))


@query("confusion_matrix", cm_sql(0.3), ["v_scored"])
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(view(spark, sf, "v_scored"), "p", "label", 0.3)


@query("metrics_at_threshold", f"WITH cm AS ({cm_sql(0.3)}) SELECT *, {PANEL} FROM cm", ["v_scored"], doubles=PANEL_D, digits=9)
def metrics_at_threshold(spark, sf):
    return ev.metrics_at_threshold(view(spark, sf, "v_scored"), "p", "label", 0.3)


@query("metric_expected_cost", f"WITH cm AS ({cm_sql(0.3)}) SELECT 5.0 * fn + 2.0 * fp AS expected_cost, (5.0 * fn + 2.0 * fp) / (tp + fp + fn + tn) AS cost_per_decision FROM cm",
       ["v_scored"], doubles="expected_cost cost_per_decision")
def metric_expected_cost(spark, sf):
    return ev.metrics_at_threshold(view(spark, sf, "v_scored"), "p", "label", 0.3, 5.0, 2.0).select("expected_cost", "cost_per_decision")


STRATEGIES = {"f1_positive": "2.0::DOUBLE * precision_positive * recall_positive / (precision_positive + recall_positive + 1e-12::DOUBLE)", "f1_macro": "f1_macro",
              "balanced_accuracy": "balanced_accuracy", "cost": "-expected_cost"}


@query("threshold_search", f"""WITH {CUM}, t AS (SELECT p AS threshold, tp_all - pb AS tp, tn_all - nb AS fp, pb AS fn, nb AS tn FROM c),
m AS (SELECT threshold, {PANEL} FROM t WHERE threshold >= 0.05 AND threshold <= 0.95)
""" + " UNION ALL ".join(f"""SELECT * FROM (SELECT threshold, '{s}' AS strategy, f1_positive, f1_macro, precision_positive, recall_positive, balanced_accuracy, expected_cost
 FROM m ORDER BY round({o}, 12) DESC, threshold LIMIT 1)""" for s, o in STRATEGIES.items()), ["v_scored"],
       doubles="threshold f1_positive f1_macro precision_positive recall_positive balanced_accuracy expected_cost", digits=9)
def threshold_search(spark, sf):
    return ev.threshold_search(scored(spark, sf), "p", "label", list(STRATEGIES), 0.05, 0.95)


@query("threshold_sweep", """WITH grid AS (SELECT CASE WHEN i = 99 THEN 0.95::DOUBLE ELSE 0.05::DOUBLE + i * ((0.95::DOUBLE - 0.05::DOUBLE) / 99) END AS threshold FROM range(100) r(i)),
g AS (SELECT p, sum(label) AS pos, count(*) - sum(label) AS neg FROM v_scored GROUP BY p),
s AS (SELECT threshold, sum(CASE WHEN p >= threshold THEN pos ELSE 0 END) AS tp, sum(CASE WHEN p >= threshold THEN neg ELSE 0 END) AS fp, sum(CASE WHEN p < threshold THEN pos ELSE 0 END) AS fn FROM grid, g GROUP BY threshold),
x AS (SELECT threshold, 10.0::DOUBLE * fn + fp AS expected_cost, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM s)
SELECT *, threshold = arg_min(threshold, struct_pack(c := expected_cost, t := threshold)) OVER () AS is_best FROM x""", ["v_scored"], doubles="threshold expected_cost f1", digits=9)
def threshold_sweep(spark, sf):
    return ev.threshold_sweep(view(spark, sf, "v_scored"), "p", "label")


ISOTONIC = """WITH s AS (SELECT p, sum(label) AS pos, count(*) AS n, row_number() OVER (ORDER BY p) AS i FROM v_scored GROUP BY p),
t AS (SELECT a.i AS a, b.i AS b, sum(b.pos) OVER (PARTITION BY a.i ORDER BY b.i) / sum(b.n) OVER (PARTITION BY a.i ORDER BY b.i)::DOUBLE AS mean FROM s a JOIN s b ON b.i >= a.i),
m AS (SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM t)
SELECT p AS score, max(least) AS fitted FROM m JOIN s ON s.i = m.b GROUP BY p"""  # the largest of the smallest means of the runs around a score


@query("isotonic_fit", ISOTONIC, ["v_scored"], doubles="score fitted", digits=9)
def isotonic_fit(spark, sf):
    rows = scored(spark, sf)
    fitted = fit_isotonic(rows, "p", "label")
    return rows.select(F.col("p").alias("score")).distinct().withColumn("fitted", fitted.predict(F.col("score")))


@query("calibration_curve", """WITH e AS (SELECT (quantile_cont(p, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))[2:-2] AS e FROM v_scored)
SELECT 'quantile' AS strategy, len(list_filter(e, lambda q: q < p))::INTEGER AS bin, avg(p) AS mean_predicted, avg(label) AS observed_rate, count(*) AS n FROM v_scored, e GROUP BY 2
UNION ALL SELECT 'uniform', len(list_filter(list_transform(range(1, 10), lambda i: i * 0.1::DOUBLE), lambda q: q < p))::INTEGER, avg(p), avg(label), count(*) FROM v_scored GROUP BY 2""",
       ["v_scored"], doubles="mean_predicted observed_rate", digits=9)
def calibration_curve(spark, sf):
    s = scored(spark, sf)
    return (ev.calibration_curve(s, "p", "label", 10).withColumn("strategy", F.lit("quantile"))
            .unionByName(ev.calibration_curve(s, "p", "label", 10, "uniform").withColumn("strategy", F.lit("uniform"))))


@query("roc_points", f"WITH {CUM} SELECT p AS threshold, (tn_all - nb) / tn_all AS fpr, (tp_all - pb) / tp_all AS tpr FROM c", ["v_scored"], doubles="threshold fpr tpr", digits=9)
def roc_points(spark, sf):
    return ev.roc_points(scored(spark, sf), "p", "label")


@query("pr_points", f"WITH {CUM} SELECT p AS threshold, (tp_all - pb) / ((tp_all - pb) + (tn_all - nb)) AS precision, (tp_all - pb) / tp_all AS recall FROM c", ["v_scored"], doubles="threshold precision recall", digits=9)
def pr_points(spark, sf):
    return ev.pr_points(scored(spark, sf), "p", "label")


@query("score_histogram", """WITH r AS (SELECT min(p) AS lo, max(p) AS hi, (max(p) - min(p)) / 40 AS w FROM v_scored)
SELECT class, bin, any_value(lo) + bin * any_value(w) AS left_edge, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY class) / any_value(w) AS density FROM (
SELECT (p >= 0.4)::INT::VARCHAR AS class, lo, w, least(39, len(list_filter(list_transform(range(1, 41), lambda i: CASE WHEN i = 40 THEN hi ELSE lo + i * w END), lambda q: q <= p)))::INTEGER AS bin FROM v_scored, r) GROUP BY class, bin""",
       ["v_scored"], doubles="left_edge density")
def score_histogram(spark, sf):
    return ev.score_histogram(scored(spark, sf), "p", 0.4, 40)


def _cum_of(src):
    return CUM.replace("v_scored", src)


@query("train_test_metrics", " UNION ALL ".join(f"""SELECT * FROM (WITH {_cum_of(f'({src})')}, cm AS ({cm_sql(0.6, f'({src})')}), l AS (SELECT avg(power(p - label, 2)) AS brier, {LOGLOSS} AS log_loss FROM ({src}))
SELECT '{name}' AS split, auc AS roc_auc, 2 * auc - 1 AS gini, ks, ap AS pr_auc, brier, log_loss, {PANEL} FROM rank, cm, l)""" for name, src in
    (("train", "SELECT * FROM v_scored WHERE id % 4 <> 0"), ("test", "SELECT * FROM v_scored WHERE id % 4 = 0"))), ["v_scored"],
       doubles="roc_auc gini ks pr_auc brier log_loss " + PANEL_D)
def train_test_metrics(spark, sf):
    s = scored(spark, sf)
    return (ev.credit_panel(s.where("id % 4 <> 0"), "p", "label", 0.6).withColumn("split", F.lit("train"))
            .unionByName(ev.credit_panel(s.where("id % 4 = 0"), "p", "label", 0.6).withColumn("split", F.lit("test"))))


# --- scoring with given coefficients ---------------------------------------------------

WEIGHTS = {"cnt_a": 0.05, "amt_b": -0.000004, "near_const": 0.3}
P_SQL = "1 / (1 + exp(-(-1 + 0.05::DOUBLE * coalesce(cnt_a, 0) - 0.000004::DOUBLE * coalesce(amt_b, 0) + 0.3::DOUBLE * near_const)))"


def linear():
    return sc.linear_score(WEIGHTS, -1.0)


@query("score_features", f"SELECT id, {P_SQL} AS probability, ({P_SQL} >= 0.25)::INT AS predicted_class FROM v_app", ["v_app"], doubles="probability", digits=9)
def score_features(spark, sf):
    return sc.score_features(view(spark, sf, "v_app"), list(WEIGHTS), linear(), 0.25, "id")


@query("score_contract", """SELECT 'required' AS side, 'amt_b' AS column_name, TRUE AS supplied, count(amt_b) AS n_present FROM v_app UNION ALL SELECT 'required', 'cnt_a', TRUE, count(cnt_a) FROM v_app
UNION ALL SELECT 'required', 'not_there', FALSE, 0 UNION ALL SELECT 'extra', 'near_const', TRUE, count(near_const) FROM v_app UNION ALL SELECT 'extra', 'id', TRUE, count(id) FROM v_app""", ["v_app"])
def score_contract(spark, sf):
    from riskframe.functions.frames import small_table, spread
    app = view(spark, sf, "v_app").select("id", "amt_b", "cnt_a", "near_const")
    need = ["amt_b", "cnt_a", "not_there"]
    missing, extra = sc.contract_gaps(need, app)
    meta = small_table(spark, [("required", c, c not in missing) for c in need] + [("extra", c, True) for c in extra], "side string, column_name string, supplied boolean")
    n = spread(app, app.columns, {"n_present": F.count}, name="column_name")
    return meta.join(n, "column_name", "left").fillna(0, ["n_present"])


@query("score_batch", f"SELECT count(*) AS n_rows, 100.0 * avg(({P_SQL} >= 0.25)::INT) AS positive_percent FROM v_app", ["v_app"], doubles="positive_percent")
def score_batch(spark, sf):
    return sc.batch_summary(sc.score_features(view(spark, sf, "v_app"), list(WEIGHTS), linear(), {"threshold": 0.25}, "id"))


# --- class weights, winners, comparison ---------------------------------------------------

@query("class_weights", "SELECT target::BIGINT AS label, count(*) AS n, sum(count(*)) OVER () / (2 * count(*)) AS weight FROM v_app GROUP BY target", ["v_app"], doubles="weight")
def class_weights(spark, sf):
    return m.class_weights(view(spark, sf, "v_app"), "target")


TRIALS = "t AS (SELECT datediff('day', TIMESTAMP '2024-01-01', ts) AS trial, CASE WHEN event_type IN ('view', 'click') THEN 'grid' ELSE 'random' END AS search_strategy, round(avg(value), 1) AS cv_score FROM events GROUP BY 1, 2)"


@query("choose_best", f"WITH {TRIALS} SELECT * FROM t ORDER BY cv_score DESC, search_strategy, trial LIMIT 1", doubles="cv_score")
def choose_best(spark, sf):
    from riskframe.plans.views import table
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).cast("long")
    strategy = F.when(F.col("event_type").isin("view", "click"), "grid").otherwise("random")
    trials = table(spark, sf, "events").groupBy(day.alias("trial"), strategy.alias("search_strategy")).agg(F.round(F.avg("value"), 1).alias("cv_score"))
    return m.best_trial(trials)


@query("compare_strategies", f"""WITH s AS (SELECT 'as_is' AS strategy, label, p FROM v_scored UNION ALL SELECT 'coarse', label, round(p, 1) FROM v_scored UNION ALL SELECT 'inverted', label, 1 - p FROM v_scored),
g AS (SELECT strategy, p, sum(label) AS pos, count(*) - sum(label) AS neg FROM s GROUP BY strategy, p),
c AS (SELECT strategy, pos, neg, sum(neg) OVER (PARTITION BY strategy ORDER BY p) - neg AS nb, sum(pos) OVER (PARTITION BY strategy) AS pa, sum(neg) OVER (PARTITION BY strategy) AS na FROM g),
a AS (SELECT strategy, sum(pos * (nb + neg / 2)) / (max(pa)::DOUBLE * max(na)) AS validation_auc FROM c GROUP BY strategy)
SELECT strategy, validation_auc, validation_auc = max(validation_auc) OVER () AS winner FROM a""", ["v_scored"], doubles="validation_auc", digits=9)
def compare_strategies(spark, sf):
    s = scored(spark, sf)
    long = s.select("label", F.explode(F.array(
        *[F.struct(F.lit(n).alias("strategy"), q.alias("q")) for n, q in
          (("as_is", F.col("p")), ("coarse", F.round("p", 1)), ("inverted", 1 - F.col("p")))])).alias("x")).select("label", "x.*")
    auc = ev.ranking_metrics(long, "q", "label", "strategy").select(F.col("feature").alias("strategy"), F.col("roc_auc").alias("validation_auc"))
    return m.compare_strategies(auc)


# --- explanation ----------------------------------------------------------------------------

CONTRIB = {"cnt_a": "0.05::DOUBLE * (cnt_a - (SELECT avg(cnt_a) FROM v_app))", "amt_b": "-0.000004::DOUBLE * (amt_b - (SELECT avg(amt_b) FROM v_app))",
           "near_const": "0.3::DOUBLE * (near_const - (SELECT avg(near_const) FROM v_app))"}


def _means(app):
    from riskframe.functions.frames import wide_agg
    return wide_agg(app, {c: F.avg(c) for c in WEIGHTS})


@query("explain_linear", "SELECT id, " + ", ".join(f"{e} AS {c}_contrib" for c, e in CONTRIB.items()) + " FROM v_app", ["v_app"], doubles=" ".join(f"{c}_contrib" for c in CONTRIB), digits=9)
def explain_linear(spark, sf):
    app = staged(spark, sf, "v_app").select("id", *WEIGHTS)
    return x.linear_contributions(app, WEIGHTS, _means(app)).select("id", *[f"{c}_contrib" for c in WEIGHTS])


@query("importance_rank", " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(abs({e})) AS importance FROM v_app" for c, e in CONTRIB.items()), ["v_app"], doubles="importance", digits=9)
def importance_rank(spark, sf):
    app = staged(spark, sf, "v_app").select("id", *WEIGHTS)
    return x.importance_rank(x.linear_importance(app, WEIGHTS, _means(app)), 20)


@query("explain_permutation")
def explain_permutation(spark, sf):
    app = staged(spark, sf, "v_app").select("id", "target", *WEIGHTS)
    return x.permutation_importance(app, "id", "target", list(WEIGHTS), linear(), repeats=5)
