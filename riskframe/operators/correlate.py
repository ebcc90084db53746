"""Pearson correlation over pairwise-complete rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.functions.frames import small_table, spread, value_of, wide_agg
from riskframe.functions.scalars import safe_div

_NARROW = 3  # up to this many columns the pairs are plain JVM aggregates; more pairs outgrow generated code


def corr_expr(x: Column, y: Column) -> Column:
    """Aggregate expression; null (not an error) for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread_xy = F.sqrt(F.var_pop(xs)) * F.sqrt(F.var_pop(ys))
    return safe_div(F.covar_pop(xs, ys), spread_xy)


def moment_exprs(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Mean and population deviation per column, as ``m:{c}`` and ``s:{c}``."""
    return {f"{w}:{c}": fn(value_of(df, c).cast("double")) for c in cols for w, fn in (("m", F.avg), ("s", F.stddev_pop))}


def corr_pairs(df: DataFrame, cols: Sequence[str], moments: dict | None = None) -> DataFrame:
    """One row per column pair in column order: ``i, j, left_feature, right_feature, n, r``.

    ``moments`` may bring the values of ``moment_exprs`` from an earlier pass.
    """
    cols = list(cols)
    if len(cols) < 2:
        return small_table(df.sparkSession, [], "i int, j int, left_feature string, right_feature string, n long, r double")
    if len(cols) <= _NARROW:
        pairs = {f"{i}|{j}": (i, j) for j in range(len(cols)) for i in range(j)}
        side = [value_of(df, c) for c in cols]
        res = spread(df, list(pairs), {
            "n": lambda p: F.count(F.when(side[pairs[p][0]].isNotNull() & side[pairs[p][1]].isNotNull(), 1)),
            "r": lambda p: corr_expr(side[pairs[p][0]], side[pairs[p][1]]),
        }, name="pair").select(
            F.split("pair", r"\|")[0].cast("int").alias("i"), F.split("pair", r"\|")[1].cast("int").alias("j"), "n", "r")
    else:
        res = _gram_pairs(df, cols, moments or wide_agg(df, moment_exprs(df, cols)))
    names = F.array(*[F.lit(c) for c in cols])
    return res.select("i", "j", F.element_at(names, F.col("i") + 1).alias("left_feature"),
                      F.element_at(names, F.col("j") + 1).alias("right_feature"), "n", "r")


def _gram_pairs(df: DataFrame, cols: list[str], moments: dict) -> DataFrame:
    """Masked Gram sums per partition, added up per pair.

    Values are standardised first so that sums of squares keep their digits.
    """
    base = df.select(*[value_of(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    k = len(cols)
    mean = np.array([moments[f"m:{c}"] or 0.0 for c in cols])
    std = np.array([moments[f"s:{c}"] or 0.0 for c in cols])
    flat = std == 0.0
    scale = np.where(flat, 1.0, std)
    upper_i, upper_j = np.triu_indices(k, 1)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((k, k)); sx = np.zeros((k, k)); sxx = np.zeros((k, k)); sxy = np.zeros((k, k))
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan)
            m = (~np.isnan(x)).astype("float64")
            z = np.where(m > 0, (x - mean) / scale, 0.0)
            n += m.T @ m
            sx += z.T @ m       # sum of column a over rows where b is present
            sxx += (z * z).T @ m
            sxy += z.T @ z
        yield pd.DataFrame({
            "i": upper_i.astype("int32"), "j": upper_j.astype("int32"), "n": n[upper_i, upper_j],
            "sx": sx[upper_i, upper_j], "sy": sx[upper_j, upper_i],
            "sxx": sxx[upper_i, upper_j], "syy": sxx[upper_j, upper_i], "sxy": sxy[upper_i, upper_j]})

    sums = (base.mapInPandas(partial, "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double")
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]))
    nn = F.nullif("n", F.lit(0.0))
    vx = F.col("sxx") / nn - F.pow(F.col("sx") / nn, 2)
    vy = F.col("syy") / nn - F.pow(F.col("sy") / nn, 2)
    cov = F.col("sxy") / nn - (F.col("sx") / nn) * (F.col("sy") / nn)
    dead = [int(i) for i in np.flatnonzero(flat)]
    # what rounding leaves of the variance of a constant is about 1e-16 of its mean square
    alive = lambda v, square: v > F.greatest(F.lit(1e-20), F.lit(1e-12) * square / nn)
    usable = alive(vx, F.col("sxx")) & alive(vy, F.col("syy"))
    if dead:
        usable = usable & ~F.col("i").isin(dead) & ~F.col("j").isin(dead)
    r = F.when(usable, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(vx * vy))))
    return sums.select("i", "j", F.col("n").cast("long").alias("n"), r.alias("r"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long-form symmetric matrix with a unit diagonal."""
    p = corr_pairs(df, cols)
    half = p.select(F.col("left_feature").alias("feature"), F.col("right_feature").alias("other"), "r")
    mirror = p.select(F.col("right_feature").alias("feature"), F.col("left_feature").alias("other"), "r")
    side = {c: value_of(df, c) for c in cols}
    diag = spread(df, list(cols), {"r": lambda c: F.when(F.var_pop(side[c].cast("double")) > 0, F.lit(1.0))})
    return half.unionByName(mirror).unionByName(diag.select("feature", F.col("feature").alias("other"), "r"))


def strong_pairs(df: DataFrame, cols: Sequence[str], threshold: float, moments: dict | None = None) -> DataFrame:
    return corr_pairs(df, cols, moments).where(F.abs("r") > threshold)


def target_corr(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """One row per feature: ``feature, corr, abs_corr``; one pass, one aggregate per feature."""
    t = value_of(df, target)
    return (spread(df, list(cols), {"corr": lambda c: corr_expr(value_of(df, c), t)})
            .withColumn("abs_corr", F.abs("corr")))
