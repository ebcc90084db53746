"""Distribution drift between a reference table and a current table.

All features are binned in one long-form aggregation: the number of shuffles does
not depend on the number of features. Edges come from the reference only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.frames import long_form, numeric_columns, small_table, spread, value_of, wide_agg
from riskframe.functions.scalars import at_least, clamp, col, edge_code, even_grid, flag, safe_div
from riskframe.operators.cumulative import cumulative_by_score
from riskframe.operators.quantiles import exact_quantiles

EMPTY_SHARE = 1e-4
SMALL, MAJOR = 0.10, 0.25
CRITICAL_SHARE = 0.30


def shared_features(reference: DataFrame, current: DataFrame, skip: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric features on both sides, reference features missing in the current table)."""
    feats = numeric_columns(reference, skip)
    have = set(current.columns)
    return [c for c in feats if c in have], [c for c in feats if c not in have]


def quantile_edges(reference: DataFrame, features: Sequence[str], n_bins: int = 10) -> dict[str, list[float] | None]:
    """Distinct reference quantiles; None when the reference is empty."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(reference, {f: value_of(reference, f) for f in features}, probs)
    return {f: None if v[0] is None else sorted(set(v)) for f, v in q.items()}


def width_edges(reference: DataFrame, features: Sequence[str], n_bins: int = 10) -> dict[str, list[float] | None]:
    ends = wide_agg(reference, {f"{w}{f}": fn(value_of(reference, f).cast("double"))
                                for f in features for w, fn in (("lo:", F.min), ("hi:", F.max))})
    return {f: None if ends[f"lo:{f}"] is None else even_grid(ends[f"lo:{f}"], ends[f"hi:{f}"], n_bins + 1)
            for f in features}


def bin_counts(reference: DataFrame, current: DataFrame, bins: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """``feature, bin, n_ref, n_cur`` from one aggregation over both tables."""
    def side(df: DataFrame, i: int) -> DataFrame:
        return long_form(df, {f: b[i].cast("string") for f, b in bins.items()}, keep=[F.lit(i).alias("side")], value="bin")
    both = side(reference, 0).unionByName(side(current, 1)).where("bin is not null")
    return both.groupBy("feature", "bin").agg(
        F.count_if(F.col("side") == 0).alias("n_ref"), F.count_if(F.col("side") == 1).alias("n_cur"))


def _psi(counts: DataFrame) -> DataFrame:
    """PSI per feature from bin counts; an exactly empty share becomes 1e-4, shares are not rescaled."""
    totals = counts.groupBy("feature").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    shares = counts.join(totals, "feature").select(
        "feature", safe_div(F.col("n_ref"), F.col("t_ref")).alias("r"), safe_div(F.col("n_cur"), F.col("t_cur")).alias("c"))
    fix = lambda x: F.when(F.col(x) == 0, F.lit(EMPTY_SHARE)).otherwise(F.col(x))
    term = (fix("c") - fix("r")) * F.log(fix("c") / fix("r"))
    # a side without any value has null shares: the sum is null
    return shares.groupBy("feature").agg(F.sum(term).alias("psi"))


def psi(reference: DataFrame, current: DataFrame, features: Sequence[str], n_bins: int = 10,
        bucket_type: str = "quantiles") -> DataFrame:
    """``feature, psi`` for all features.

    ``quantiles``: distinct reference quantiles; ``bins``: equal width; both with open outer bins, so a
    constant reference gives 0 and a 0/1 feature has one bin (PSI 0). ``categorical`` takes every
    value as its own bin and does see shifts of flags.
    """
    feats = list(features)
    if bucket_type == "categorical":
        bins = {f: (value_of(reference, f), value_of(current, f)) for f in feats}
    else:
        make = {"quantiles": quantile_edges, "bins": width_edges}
        if bucket_type not in make:
            raise ValueError(f"unknown bucket type: {bucket_type!r}")
        edges = make[bucket_type](reference, feats, n_bins)
        bins = {}
        for f in feats:
            inner = (edges[f] or [])[1:-1]
            bins[f] = tuple(edge_code(value_of(t, f).cast("double"), inner) for t in (reference, current))
    res = _psi(bin_counts(reference, current, bins))
    names = small_table(reference.sparkSession, [(f,) for f in feats], "feature string")
    return names.join(res, "feature", "left")


def drift_level(value: Column, small: float = SMALL, major: float = MAJOR) -> Column:
    return (F.when(value.isNull() | F.isnan(value), "undefined").when(value < small, "none")
            .when(value < major, "small").otherwise("major"))


def drift_table(reference: DataFrame, current: DataFrame, skip: Sequence[str] = (), n_bins: int = 10,
                bucket_type: str = "quantiles", small: float = SMALL, major: float = MAJOR) -> DataFrame:
    """PSI and level of every shared numeric feature, most drifted first, undefined last."""
    feats, _ = shared_features(reference, current, skip)
    res = psi(reference, current, feats, n_bins, bucket_type)
    return res.withColumn("drift_level", drift_level(F.col("psi"), small, major)).orderBy(
        F.col("psi").desc_nulls_last(), "feature")


def drift_alert(table: DataFrame, critical_share: float = CRITICAL_SHARE, stamp: bool = True) -> DataFrame:
    """One row: status, reason, counts, share and the drifted features of a drift table."""
    moved = F.col("drift_level").isin("small", "major")
    record = F.struct("feature", "psi", "drift_level")
    agg = table.agg(
        F.count_if(moved).alias("drifted_features_count"),
        F.count_if(F.col("drift_level") == "major").alias("major_drift_features_count"),
        F.coalesce(F.avg(flag(moved)), F.lit(0.0)).alias("drifted_share"),
        # one entry per feature at most
        F.sort_array(F.collect_list(F.when(moved, record))).alias("drifted_features"))
    major, small, share = (F.col("major_drift_features_count"), F.col("drifted_features_count"), F.col("drifted_share"))
    status = (F.when(major > 0, "critical").when(share >= critical_share, "critical")
              .when(small > 0, "warning").otherwise("ok"))
    reason = (F.when(major > 0, F.concat(major.cast("string"), F.lit(" feature(s) with major drift")))
              .when(share >= critical_share, F.lit("share of drifted features at or above the limit"))
              .when(small > 0, F.concat(small.cast("string"), F.lit(" feature(s) with small drift")))
              .otherwise("no drift detected"))
    out = agg.select(status.alias("status"), reason.alias("reason"), *agg.columns)
    return out.withColumn("generated_at", F.current_timestamp()) if stamp else out


def level_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("drift_level").agg(F.count("*").alias("n_features"))


def _two_sample(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Running counts per feature with the current side as the positive label."""
    def side(df: DataFrame, label: int) -> DataFrame:
        vals = {f: value_of(df, f).cast("double") for f in features}
        return long_form(df, vals, keep=[F.lit(label).alias("label")])
    both = side(reference, 0).unionByName(side(current, 1)).where("value is not null")
    return cumulative_by_score(both, "value", "label", "feature")


def _gap() -> Column:
    up_c = safe_div(F.col("pos_below") + F.col("pos"), F.col("pos_total"))
    up_r = safe_div(F.col("neg_below") + F.col("neg"), F.col("neg_total"))
    return F.abs(up_c - up_r)


def drift_ks(reference: DataFrame, current: DataFrame, features: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic with the asymptotic p-value."""
    res = _two_sample(reference, current, features).groupBy("feature").agg(
        F.max(_gap()).alias("ks"), F.max("neg_total").alias("n_ref"), F.max("pos_total").alias("n_cur"))
    n = F.col("n_ref").cast("double") * F.col("n_cur") / F.nullif((F.col("n_ref") + F.col("n_cur")).cast("double"), F.lit(0.0))
    lam2 = n * F.col("ks") * F.col("ks")
    term = lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * F.col("lam2"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), term)
    res = res.withColumn("lam2", lam2)
    # below this lambda^2 the alternating series has not converged; the probability is 1 to 8 digits
    p = F.when(F.col("lam2") < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
    return res.select("feature", "ks", "n_ref", "n_cur", p.alias("p_value")).withColumn(
        "drifted", F.col("p_value") < alpha)


def drift_wasserstein(reference: DataFrame, current: DataFrame, features: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """First Wasserstein distance over the reference standard deviation."""
    step = F.coalesce(F.col("next_score") - F.col("score"), F.lit(0.0))
    dist = _two_sample(reference, current, features).groupBy("feature").agg(F.sum(_gap() * step).alias("distance"))
    std = spread(reference, list(features), {"ref_std": lambda f: F.stddev_pop(value_of(reference, f).cast("double"))})
    out = dist.join(std, "feature").withColumn(
        "normed", F.col("distance") / F.greatest(F.col("ref_std"), F.lit(0.001)))
    return out.select("feature", "distance", "ref_std", "normed", (F.col("normed") >= threshold).alias("drifted"))


def _upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-15:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * front)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        step = c * d
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return front * h


def drift_chi2(reference: DataFrame, current: DataFrame, columns: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Chi-square of category counts per column: statistic, degrees of freedom, p-value."""
    bins = {c: (value_of(reference, c), value_of(current, c)) for c in columns}
    counts = bin_counts(reference, current, bins)
    tot = counts.groupBy("feature").agg(F.sum("n_ref").alias("tr"), F.sum("n_cur").alias("tc"))
    x = counts.join(tot, "feature")
    n, row = (F.col("tr") + F.col("tc")).cast("double"), (F.col("n_ref") + F.col("n_cur")).cast("double")
    exp_r, exp_c = row * F.col("tr") / n, row * F.col("tc") / n
    part = safe_div(F.pow(F.col("n_ref") - exp_r, 2), exp_r) + safe_div(F.pow(F.col("n_cur") - exp_c, 2), exp_c)
    stat = x.groupBy("feature").agg(F.sum(part).alias("chi2"), (F.count("*") - 1).alias("dof"))

    @F.pandas_udf("double")
    def tail(chi2: pd.Series, dof: pd.Series) -> pd.Series:  # one value per feature
        return pd.Series([None if pd.isna(s) else 1.0 if d < 1 else _upper_gamma(d / 2, s / 2)
                          for s, d in zip(chi2, dof)], dtype="float64")

    return stat.withColumn("p_value", tail("chi2", F.col("dof").cast("double"))).withColumn(
        "drifted", F.col("p_value") < alpha)


def dataset_share(tested: DataFrame, limit: float = 0.5) -> DataFrame:
    """Share of drifted columns and the verdict on the dataset."""
    hit = flag(F.col("drifted"))
    return tested.agg(F.count("*").alias("n_columns"), F.sum(hit).alias("n_drifted"),
                      F.avg(hit).alias("drifted_share")).withColumn("dataset_drift", F.col("drifted_share") >= limit)


def drift_distributions(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 40) -> DataFrame:
    """Densities of both sides on shared equal-width bins between the pooled 1st and 99th percentiles."""
    both = (reference.select(*[col(f) for f in features], F.lit("reference").alias("__side"))
            .unionByName(current.select(*[col(f) for f in features], F.lit("current").alias("__side"))))
    q = exact_quantiles(both, {f: value_of(both, f) for f in features}, [0.01, 0.99])
    grids, codes = {}, {}
    for f, (lo, hi) in q.items():
        if lo is None:
            continue
        lo, hi = (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5)
        grids[f] = even_grid(lo, hi, bins + 1)
        codes[f] = edge_code(clamp(value_of(both, f).cast("double"), lo, hi), grids[f][1:-1])
    if not codes:
        return small_table(both.sparkSession, [], "feature string, side string, bin int, left_edge double, n long, density double")
    counts = (long_form(both, codes, keep=[F.col("__side").alias("side")], value="bin").where("bin is not null")
              .groupBy("feature", "side", "bin").agg(F.count("*").alias("n")))
    widths = small_table(both.sparkSession, [(f, g[0], (g[-1] - g[0]) / bins) for f, g in grids.items()],
                         "feature string, low double, width double")
    w = Window.partitionBy("feature", "side")  # at most `bins` rows
    return counts.join(widths, "feature").select(
        "feature", "side", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("left_edge"), "n",
        (F.col("n") / F.sum("n").over(w) / F.col("width")).alias("density"))
