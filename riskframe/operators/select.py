"""Feature selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from riskframe.functions.frames import spread, value_of
from riskframe.functions.scalars import col, safe_div
from riskframe.operators.correlate import corr_pairs, target_corr
from riskframe.operators.encode import small_domains


def near_zero_variance(df: DataFrame, cols: Sequence[str], floor: float = 1e-8, ratio: float = 1e-3) -> DataFrame:
    """``feature, std, ratio_to_mean, reason`` of the columns to drop; flags with two values are kept
    unless they do not vary at all."""
    stats = spread(df, list(cols), {
        "mean": lambda c: F.avg(value_of(df, c).cast("double")),
        "std": lambda c: F.stddev_samp(value_of(df, c).cast("double"))})
    rel = F.col("std") / (F.abs("mean") + F.lit(1e-8))
    weak = stats.select("feature", "std", rel.alias("ratio_to_mean")).where(
        (F.col("std") < floor) | ((F.col("ratio_to_mean") < ratio)))
    rows = weak.collect()
    doubtful = [r.feature for r in rows if r["std"] >= floor]
    two = set(small_domains(df, doubtful, 2))
    keep = [(r.feature, r["std"], r.ratio_to_mean, "flat" if r["std"] < floor else "low_ratio")
            for r in rows if r.feature not in two]
    return df.sparkSession.createDataFrame(keep, "feature string, std double, ratio_to_mean double, reason string")


def corr_prune(df: DataFrame, cols: Sequence[str], target: str, threshold: float = 0.97) -> list[str]:
    """Greedy sweep in column order over the strong pairs: the member with the weaker
    |corr(target)| goes (a tie drops the earlier one); pairs with a dropped member are passed over."""
    pairs = corr_pairs(df, cols).where(F.abs("r") > threshold).orderBy("j", "i").collect()
    strength = {r.feature: r.abs_corr or 0.0 for r in target_corr(df, cols, target).collect()}
    dropped: list[str] = []
    for p in pairs:
        a, b = p.left_feature, p.right_feature
        if a not in dropped and b not in dropped:
            dropped.append(a if strength[b] >= strength[a] else b)
    return dropped


def leak_suspects(df: DataFrame, cols: Sequence[str], target: str, threshold: float = 0.5) -> DataFrame:
    return target_corr(df, cols, target).where(F.col("abs_corr") > threshold)


def rank_by_target(df: DataFrame, cols: Sequence[str], target: str, k: int) -> DataFrame:
    return (target_corr(df, cols, target).where("abs_corr is not null")
            .orderBy(F.col("abs_corr").desc(), "feature").limit(k))


def wanted_count(n_select: int, available: int) -> int:
    """Number of features to keep: at least one is required, too many is clamped."""
    if n_select < 1:
        raise ValueError(f"number of features to keep must be >= 1, got {n_select}")
    return min(n_select, available)


def apply_selection(tables: Mapping[str, DataFrame], selected: Sequence[str], id_column: str,
                    target: str | None = None) -> dict[str, DataFrame]:
    """id + selected (+ target where present) per split; a split without a selected column is an error."""
    out = {}
    for name, t in tables.items():
        absent = [c for c in selected if c not in t.columns]
        if absent:
            raise ValueError(f"split '{name}' lacks selected column(s): {absent[:5]}")
        keep = [c for c in (id_column,) if c in t.columns] + list(selected)
        if target and target in t.columns:
            keep.append(target)
        out[name] = t.select(*[col(c) for c in keep])
    return out


def recursive_elimination(df: DataFrame, cols: Sequence[str], target: str, n_select: int, step: int = 5,
                          num_trees: int = 100, max_depth: int = 5, seed: int = 42) -> list[str]:
    """Drops the ``step`` least important features per forest until ``n_select`` remain."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler, VectorSlicer

    from riskframe.sources.staging import stage

    keep = list(range(len(cols)))
    n_select = wanted_count(n_select, len(cols))
    numbers = df.select(*[F.coalesce(value_of(df, c).cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(cols)],
                        col(target).cast("double").alias("label"))
    packed = VectorAssembler(inputCols=[f"f{i}" for i in keep], outputCol="all").transform(numbers).select("all", "label")
    packed = stage(packed, "rfe")
    while len(keep) > n_select:
        data = VectorSlicer(inputCol="all", outputCol="features", indices=keep).transform(packed)
        model = RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, seed=seed).fit(data)
        weight = model.featureImportances.toArray()
        out = min(step, len(keep) - n_select)
        worst = sorted(range(len(keep)), key=lambda i: (weight[i], -i))[:out]
        keep = [c for i, c in enumerate(keep) if i not in set(worst)]
    return [cols[i] for i in keep]
