"""Exact running counts over a score, ties included.

The score axis is cut at sketched quantiles. Explicit cut points give every row
a range, a running sum over the short list of ranges gives each range its offset,
and a window inside one range does the rest. No window spans the whole table,
and the cut points only affect balance, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.functions.scalars import edge_code


_FEW_CUTS = 64


def default_ranges(df: DataFrame) -> int:
    """Ranges per feature; more features do not make a feature's ranges coarser."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, min(20_000, 2 * parts))


def range_code(score: Column, cuts: Column, n: int) -> Column:
    """Number of cuts <= score; ``cuts`` ascend and are at most ``n``. A binary search, so a row costs log2(n) comparisons."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])
    # past the end get() is null, which is not <= score
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= score, at + step).otherwise(at))


def cumulative_by_score(df: DataFrame, score: str, label: str, feature: str | None = None,
                        n_ranges: int | None = None, sketch: DataFrame | None = None) -> DataFrame:
    """One row per distinct (feature, score).

    Columns: ``feature, score, pos, neg`` (rows at the score), ``pos_below,
    neg_below`` (strictly below), ``pos_total, neg_total`` and ``next_score``.
    Rows with a null score or label are left out. ``sketch`` names a cheaper table with about the same
    scores for the cut points, e.g. one side of the join that made ``df``.
    """
    src = df.select(
        (F.col(feature) if feature else F.lit("score")).alias("feature"),
        F.col(score).cast("double").alias("score"),
        F.col(label).cast("int").alias("label"),
    ).where("score is not null and label is not null and not isnan(score)")
    n = max(2, n_ranges or default_ranges(df))
    probes = [i / n for i in range(1, n)]
    probe = src if sketch is None else sketch.select(
        F.lit("score").alias("feature"), F.col(score).cast("double").alias("score")).where("score is not null and not isnan(score)")
    cut_rows = (
        probe.groupBy("feature")
        .agg(F.percentile_approx("score", probes, max(10_000, 5 * n)).alias("cuts"))
        .select("feature", F.array_sort(F.array_distinct("cuts")).alias("cuts"))
    ).collect()
    cuts = df.sparkSession.createDataFrame(
        [(r.feature, r.cuts) for r in cut_rows], "feature string, cuts array<double>")

    part = [] if feature is None else ["feature"]
    counts = src.groupBy(*part, "score").agg(
        F.sum("label").alias("pos"), (F.count("*") - F.sum("label")).alias("neg"))
    if feature is None:
        only = cut_rows[0].cuts if cut_rows else []
        if len(only) <= _FEW_CUTS:  # short lists compile to plain comparisons
            code = edge_code(F.col("score"), only)
        else:
            code = range_code(F.col("score"), F.array(*[F.lit(c) for c in only]), n)
        ranged = counts.withColumn("range_id", code)
    else:
        # at most n_features x n_ranges numbers
        ranged = counts.join(F.broadcast(cuts), "feature").withColumn(
            "range_id", range_code(F.col("score"), F.col("cuts"), n)).drop("cuts")

    group = part or [F.lit(1)]
    by_range = Window.partitionBy(*group).orderBy("range_id")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = (
        ranged.groupBy(*part, "range_id")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.min("score").alias("first_score"))
        .select(
            *part, "range_id",
            F.coalesce(F.sum("p").over(earlier), F.lit(0)).alias("pos_off"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("neg_off"),
            F.lead("first_score").over(by_range).alias("next_range_score"),
            F.sum("p").over(whole).alias("pos_total"),
            F.sum("n").over(whole).alias("neg_total"),
        )
    )
    inside = Window.partitionBy(*part, "range_id").orderBy("score")
    below = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(offsets, [*part, "range_id"])
        .select(
            F.col("feature") if part else F.lit("score").alias("feature"), "score", "pos", "neg",
            (F.col("pos_off") + F.coalesce(F.sum("pos").over(below), F.lit(0))).alias("pos_below"),
            (F.col("neg_off") + F.coalesce(F.sum("neg").over(below), F.lit(0))).alias("neg_below"),
            "pos_total", "neg_total",
            F.coalesce(F.lead("score").over(inside), F.col("next_range_score")).alias("next_score"),
        )
    )
