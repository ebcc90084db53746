"""Which features drive a score."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.frames import small_table, spread, value_of
from riskframe.functions.hashing import hash60
from riskframe.functions.scalars import col
from riskframe.operators.evaluate import ranking_metrics


def linear_contributions(df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float],
                         suffix: str = "_contrib") -> DataFrame:
    """coef * (x - mean) per row and feature."""
    return df.withColumns({f + suffix: F.lit(float(w)) * (value_of(df, f).cast("double") - F.lit(float(means[f])))
                           for f, w in coefficients.items()})


def linear_importance(df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float]) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    part = lambda f: F.lit(float(coefficients[f])) * (value_of(df, f).cast("double") - F.lit(float(means[f])))
    return importance_rank(spread(df, list(coefficients), {"importance": lambda f: F.avg(F.abs(part(f)))}), len(coefficients))


def importance_rank(table: DataFrame, k: int = 20) -> DataFrame:
    return table.orderBy(F.col("importance").desc_nulls_last(), "feature").limit(k)


def permute_within_ranges(df: DataFrame, key: str, columns: Sequence[str], seed: int, ranges: int) -> DataFrame:
    """Every listed column moved to another row: rows fall into hash ranges by (seed, key), and inside a
    range the value of the previous row by a second hash is taken (cyclically)."""
    spread_key = F.pmod(hash60(col(key), seed), F.lit(ranges))
    w = Window.partitionBy("__r").orderBy("__h", col(key))
    back = Window.partitionBy("__r").orderBy(F.col("__h").desc(), col(key).desc())
    src = df.withColumn("__r", spread_key).withColumn("__h", hash60(col(key), seed + 1))
    moved = {}
    for c in columns:
        boxed = F.struct(col(c))  # a struct keeps a null value apart from a missing neighbour
        moved[f"{c}__moved"] = F.coalesce(F.lag(boxed).over(w), F.first(boxed).over(back))[c]
    return src.withColumns(moved).drop("__r", "__h")


def permutation_importance(df: DataFrame, key: str, label: str, features: Sequence[str],
                           score: Callable[[DataFrame], DataFrame], repeats: int = 5, seed: int = 42,
                           rows_per_range: int = 50_000) -> DataFrame:
    """Mean drop in AUC when one feature is shuffled.

    ``score`` adds a ``probability`` column. All shuffled copies are scored by one job and their
    AUCs come from one grouped pass.
    """
    keep = df.select(col(key), col(label), *[col(f) for f in features])
    ranges = 1 + keep.count() // rows_per_range
    base = keep.withColumn("__case", F.lit("base"))
    copies = base
    for r in range(repeats):
        moved = permute_within_ranges(keep, key, features, seed + 10 * r, ranges)
        # one pass per repeat: each row becomes one copy per feature, only that feature replaced
        cases = [F.struct(F.lit(f"{f}|{r}").alias("__case"),
                          *[(F.col(f"{g}__moved") if g == f else col(g)).alias(g) for g in features]) for f in features]
        copies = copies.unionByName(
            moved.select(col(key), col(label), F.explode(F.array(*cases)).alias("__c"))
            .select(col(key), col(label), "__c.*"))
    scored = score(copies).select("__case", F.col("probability").alias("__p"), col(label).alias("__y"))
    auc = ranking_metrics(scored, "__p", "__y", "__case").select(F.col("feature").alias("case"), "roc_auc")
    rows = {r.case: r.roc_auc for r in auc.collect()}  # features x repeats numbers
    out = [(f, float(sum(rows["base"] - rows[f"{f}|{r}"] for r in range(repeats)) / repeats)) for f in features]
    return importance_rank(small_table(df.sparkSession, out, "feature string, importance double"), len(features))


def _weights(model, features: Sequence[str]) -> dict[str, float]:
    if hasattr(model, "members"):  # calibrated: each member's shares of its own total count the same
        parts = [_weights(base, features) for base, _ in model.members]
        shares = [{f: w / (sum(p.values()) or 1.0) for f, w in p.items()} for p in parts]
        return {f: sum(p[f] for p in shares) / len(shares) for f in features}
    if hasattr(model, "stages"):
        return _weights(model.stages[-1], features)
    if hasattr(model, "featureImportances"):
        return dict(zip(features, model.featureImportances.toArray()))
    if hasattr(model, "coefficients"):
        found = model.coefficients
        found = found if isinstance(found, Mapping) else dict(zip(features, found.toArray()))
        return {f: abs(found.get(f, 0.0)) for f in features}
    raise ValueError(f"{type(model).__name__} tells no importances; use permutation_importance")


def model_importance(model, features: Sequence[str], spark) -> DataFrame:
    """Impurity importances or absolute coefficients (of z-scores in the scorecard), averaged over a calibrated model's members."""
    rows = [(f, float(w)) for f, w in _weights(model, features).items()]
    return importance_rank(small_table(spark, rows, "feature string, importance double"), len(features))
