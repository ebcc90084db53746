"""Metrics, thresholds and calibration as aggregations; labels and scores never reach the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.scalars import at_least, clamp, col, edge_code, even_grid, flag, grid_code, safe_div
from riskframe.operators.cumulative import cumulative_by_score
from riskframe.operators.profile import histogram
from riskframe.operators.quantiles import exact_quantiles

LOG_EPS = 2.220446049250313e-16  # fixed value: double machine epsilon


# --- ranking metrics over the running counts -------------------------------------------

def auc_expr() -> Column:
    """Aggregate over running counts; a tie counts one half."""
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2.0))
    return safe_div(wins, F.max(F.col("pos_total").cast("double") * F.col("neg_total")))


def ks_expr() -> Column:
    """max(TPR - FPR) over thresholds 'score and above'."""
    tpr = safe_div(F.col("pos_total") - F.col("pos_below"), F.col("pos_total"))
    fpr = safe_div(F.col("neg_total") - F.col("neg_below"), F.col("neg_total"))
    return F.greatest(F.max(tpr - fpr), F.lit(0.0))


def average_precision_expr() -> Column:
    """Sum of recall steps times precision (no interpolation)."""
    tp = F.col("pos_total") - F.col("pos_below")
    fp = F.col("neg_total") - F.col("neg_below")
    return F.sum(safe_div(F.col("pos"), F.col("pos_total")) * safe_div(tp, tp + fp))


def ranking_metrics(df: DataFrame, score: str, label: str, feature: str | None = None) -> DataFrame:
    """``feature, roc_auc, gini, ks, pr_auc`` from one set of running counts."""
    return (cumulative_by_score(df, score, label, feature).groupBy("feature")
            .agg(auc_expr().alias("roc_auc"), ks_expr().alias("ks"), average_precision_expr().alias("pr_auc"))
            .withColumn("gini", 2.0 * F.col("roc_auc") - 1.0))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    return cumulative_by_score(df, score, label).agg(auc_expr().alias("roc_auc"))


def gini(df: DataFrame, score: str, label: str) -> DataFrame:
    return roc_auc(df, score, label).select((2.0 * F.col("roc_auc") - 1.0).alias("gini"))


def ks_statistic(df: DataFrame, score: str, label: str) -> DataFrame:
    return cumulative_by_score(df, score, label).agg(ks_expr().alias("ks"))


def pr_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    return cumulative_by_score(df, score, label).agg(average_precision_expr().alias("pr_auc"))


# --- per-row losses ---------------------------------------------------------------------

def brier_expr(score: Column, label: Column) -> Column:
    return F.avg(F.pow(score - label.cast("double"), 2))


def log_loss_expr(score: Column, label: Column) -> Column:
    p = clamp(score, LOG_EPS, 1.0 - LOG_EPS)
    return -F.avg(F.when(label == 1, F.log(p)).otherwise(F.log(F.lit(1.0) - p)))


# --- metrics at a threshold ---------------------------------------------------------------

def confusion_exprs(score: Column, label: Column, threshold: float) -> dict[str, Column]:
    hit = score >= F.lit(float(threshold))
    return {"tp": F.count_if(hit & (label == 1)), "fp": F.count_if(hit & (label == 0)),
            "fn": F.count_if(~hit & (label == 1)), "tn": F.count_if(~hit & (label == 0))}


def confusion_matrix(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    return df.agg(*[e.alias(n) for n, e in confusion_exprs(col(score), col(label), threshold).items()])


def _zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def threshold_exprs(cost_fn: float = 10.0, cost_fp: float = 1.0) -> dict[str, Column]:
    """Panel over the columns tp, fp, fn, tn; undefined ratios are 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    p1, r1 = _zero(safe_div(tp, tp + fp)), _zero(safe_div(tp, tp + fn))
    p0, r0 = _zero(safe_div(tn, tn + fn)), _zero(safe_div(tn, tn + fp))
    f1 = _zero(safe_div(2.0 * tp, 2.0 * tp + fp + fn))
    f0 = _zero(safe_div(2.0 * tn, 2.0 * tn + fp + fn))
    cost = F.lit(float(cost_fp)) * fp + F.lit(float(cost_fn)) * fn
    n = tp + fp + fn + tn
    return {
        "f1_positive": f1, "f1_macro": (f1 + f0) / 2.0,
        "precision_positive": p1, "recall_positive": r1,
        "precision_macro": (p1 + p0) / 2.0, "recall_macro": (r1 + r0) / 2.0,
        "balanced_accuracy": (r1 + r0) / 2.0, "accuracy": _zero(safe_div(tp + tn, n)),
        "expected_cost": cost, "cost_per_decision": cost / at_least(n, 1.0),
    }


def metrics_at_threshold(df: DataFrame, score: str, label: str, threshold: float,
                         cost_fn: float = 10.0, cost_fp: float = 1.0) -> DataFrame:
    cm = confusion_matrix(df, score, label, threshold)
    return cm.select("*", *[e.alias(n) for n, e in threshold_exprs(cost_fn, cost_fp).items()])


def evaluate_predictions(predictions: DataFrame, labels: DataFrame, key: str, score: str, label: str,
                         threshold: float) -> DataFrame:
    """Serving-time panel of a scored batch; scores and labels meet by key, never by position."""
    scores = predictions.select(col(key), col(score).alias("score"))
    both = scores.join(labels.select(col(key), col(label).alias("label")), key)
    rank = cumulative_by_score(both, "score", "label", sketch=scores)
    # the confusion counts follow from the running counts: no second pass over the rows
    hit = F.col("score") >= F.lit(float(threshold))
    one = rank.agg(
        auc_expr().alias("roc_auc"), average_precision_expr().alias("pr_auc"),
        F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~hit, F.col("pos"))), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(~hit, F.col("neg"))), F.lit(0)).alias("tn"))
    m = threshold_exprs()
    n = (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).cast("long")
    return one.select(
        "roc_auc", "pr_auc", m["accuracy"].alias("accuracy_at_threshold"),
        m["precision_positive"].alias("precision_at_threshold"), m["recall_positive"].alias("recall_at_threshold"),
        m["f1_positive"].alias("f1_at_threshold"), F.lit(float(threshold)).alias("threshold"),
        safe_div(F.col("tp") + F.col("fp"), n).alias("positive_rate_predicted"),
        safe_div(F.col("tp") + F.col("fn"), n).alias("positive_rate_actual"), n.alias("n_rows"))


def credit_panel(df: DataFrame, score: str, label: str, threshold: float, prefix: str = "",
                 cost_fn: float = 10.0, cost_fp: float = 1.0) -> DataFrame:
    """Ranking, loss and threshold metrics of one scored split as one row."""
    rank = ranking_metrics(df, score, label).select("roc_auc", "gini", "ks", "pr_auc")
    losses = df.agg(
        brier_expr(col(score), col(label)).alias("brier"), log_loss_expr(col(score), col(label)).alias("log_loss"),
        *[e.alias(n) for n, e in confusion_exprs(col(score), col(label), threshold).items()])
    panel = losses.select("brier", "log_loss", *[e.alias(n) for n, e in threshold_exprs(cost_fn, cost_fp).items()])
    one = lambda t: t.withColumn("__k", F.lit(1))  # two one-row tables
    out = one(rank).join(one(panel), "__k").drop("__k")
    return out.select(*[F.col(c).alias(prefix + c) for c in out.columns])


# --- choosing a threshold -------------------------------------------------------------------

def threshold_table(df: DataFrame, score: str, label: str, cost_fn: float = 10.0, cost_fp: float = 1.0) -> DataFrame:
    """Confusion counts and the panel at every distinct score."""
    c = cumulative_by_score(df, score, label).select(
        F.col("score").alias("threshold"),
        (F.col("pos_total") - F.col("pos_below")).alias("tp"), (F.col("neg_total") - F.col("neg_below")).alias("fp"),
        F.col("pos_below").alias("fn"), F.col("neg_below").alias("tn"))
    return c.select("*", *[e.alias(n) for n, e in threshold_exprs(cost_fn, cost_fp).items()])


def _objective(strategy: str) -> Column:
    if strategy == "cost":
        return -F.col("expected_cost")
    if strategy in ("f1_macro", "balanced_accuracy"):
        return F.col(strategy)
    p, r = F.col("precision_positive"), F.col("recall_positive")
    return 2.0 * p * r / (p + r + F.lit(1e-12))


STRATEGIES = ("f1_positive", "f1_macro", "balanced_accuracy", "cost")
_KEPT = ("f1_positive", "f1_macro", "precision_positive", "recall_positive", "balanced_accuracy", "expected_cost")


def threshold_search(df: DataFrame, score: str, label: str, strategy: str | Sequence[str] = "f1_positive", low: float = 0.0,
                     high: float = 1.0, cost_fn: float = 10.0, cost_fp: float = 1.0) -> DataFrame:
    """The lowest of the best thresholds with its panel, one row per strategy from one aggregation.

    Candidates are the distinct scores in [low, high], or all of them when none lies inside; without
    scores the threshold is 0.5. An unknown strategy means ``f1_positive``.
    """
    asked = [strategy] if isinstance(strategy, str) else list(strategy)
    names = list(dict.fromkeys(s if s in STRATEGIES else STRATEGIES[0] for s in asked))
    t = threshold_table(df, score, label, cost_fn, cost_fp)
    inside = flag((F.col("threshold") >= low) & (F.col("threshold") <= high))
    kept = F.struct("threshold", *_KEPT)
    best = t.agg(*[F.max_by(kept, F.struct(inside, _objective(s), -F.col("threshold"))).alias(s) for s in names])
    rows = F.array(*[F.struct(F.lit(s).alias("strategy"), F.col(s).alias("b")) for s in names])
    return best.select(F.inline(rows)).select(
        F.coalesce("b.threshold", F.lit(0.5)).alias("threshold"), "strategy", *[F.col(f"b.{c}").alias(c) for c in _KEPT])


def threshold_sweep(df: DataFrame, score: str, label: str, low: float = 0.05, high: float = 0.95, n: int = 100,
                    cost_fn: float = 10.0, cost_fp: float = 1.0) -> DataFrame:
    """Cost and F1 on an even grid from one histogram of the scores, with the cheapest threshold marked."""
    grid = even_grid(low, high, n)
    spark = df.sparkSession
    counts = (df.select(grid_code(col(score).cast("double"), grid).alias("code"), col(label).alias("y"))
              .where("code is not null and y is not null").groupBy("code")
              .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")))
    points = spark.createDataFrame([(i, g) for i, g in enumerate([float("-inf")] + grid)], "code int, threshold double")
    w = Window.partitionBy(F.lit(1)).orderBy("code")  # n + 1 rows
    above = w.rowsBetween(0, Window.unboundedFollowing)
    below = w.rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, win: F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0))).over(win), F.lit(0))
    cum = points.join(counts, "code", "left").select(
        "code", "threshold", total("pos", above).alias("tp"), total("neg", above).alias("fp"),
        total("pos", below).alias("fn"), total("neg", below).alias("tn")).where("code > 0")
    m = threshold_exprs(cost_fn, cost_fp)
    out = cum.select("threshold", m["expected_cost"].alias("expected_cost"), m["f1_positive"].alias("f1"))
    first_best = F.min(F.struct("expected_cost", "threshold")).over(Window.partitionBy(F.lit(1)))
    return out.withColumn("is_best", F.col("threshold") == first_best["threshold"])


def calibration_curve(df: DataFrame, score: str, label: str, bins: int = 10, strategy: str = "quantile") -> DataFrame:
    """Mean prediction, observed rate and rows per bin; a value on an edge belongs to the lower bin."""
    s = col(score).cast("double")
    if strategy == "quantile":
        edges = exact_quantiles(df, {"p": s}, [i / bins for i in range(bins + 1)])["p"]
        edges = [] if edges[0] is None else edges
    else:
        edges = even_grid(0.0, 1.0, bins + 1)
    code = edge_code(s, edges[1:-1], closed_left=False)
    return (df.select(code.alias("bin"), s.alias("p"), col(label).cast("double").alias("y"))
            .where("bin is not null and y is not null").groupBy("bin")
            .agg(F.avg("p").alias("mean_predicted"), F.avg("y").alias("observed_rate"), F.count("*").alias("n")))


def roc_points(df: DataFrame, score: str, label: str) -> DataFrame:
    c = cumulative_by_score(df, score, label)
    return c.select(F.col("score").alias("threshold"),
                    safe_div(F.col("neg_total") - F.col("neg_below"), F.col("neg_total")).alias("fpr"),
                    safe_div(F.col("pos_total") - F.col("pos_below"), F.col("pos_total")).alias("tpr"))


def pr_points(df: DataFrame, score: str, label: str) -> DataFrame:
    c = cumulative_by_score(df, score, label)
    tp, fp = F.col("pos_total") - F.col("pos_below"), F.col("neg_total") - F.col("neg_below")
    return c.select(F.col("score").alias("threshold"), safe_div(tp, tp + fp).alias("precision"),
                    safe_div(tp, F.col("pos_total")).alias("recall"))


def score_histogram(df: DataFrame, score: str, threshold: float, bins: int = 40) -> DataFrame:
    """Equal-width histogram of scores per predicted class."""
    s = col(score).cast("double")
    r = df.agg(F.min(s), F.max(s)).first()
    return histogram(df, s, flag(s >= F.lit(threshold)), r[0], r[1], bins)
