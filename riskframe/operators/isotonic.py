"""Isotonic regression of a 0/1 label on a score, fitted without gathering the scores.

The fit is the slope of the lower convex hull of the points (rows up to a score, positives up to it). The hull of a table is the hull
of its parts' hulls, so each range of scores keeps its own hull (a task holds one range), and the hulls of ``FAN`` neighbouring
ranges are merged at a time until one is left. Coordinates are whole numbers and slopes are compared by exact products.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.operators.cumulative import cumulative_by_score, default_ranges, range_code

FAN = 16
_POINT = "bucket long, x long, y long, score double, next_score double"


@dataclass(frozen=True)
class IsotonicMap:
    """Bounds of the constant steps with their values; between two bounds the value runs on a line, outside it stays."""

    bounds: Sequence[float]
    values: Sequence[float]

    def predict(self, score: Column) -> Column:
        s = score.cast("double")
        if not self.bounds:
            return F.lit(None).cast("double")
        bounds, values = (F.array(*[F.lit(float(x)) for x in xs]) for xs in (self.bounds, self.values))
        n = len(self.bounds)
        at = range_code(s, bounds, n)  # bounds at or below the score
        low, high = (F.greatest(F.least(at + i, F.lit(n)), F.lit(1)).cast("int") for i in (0, 1))
        a, b, u, v = F.element_at(bounds, low), F.element_at(bounds, high), F.element_at(values, low), F.element_at(values, high)
        return F.when(s.isNull() | F.isnan(s), None).when((at < 1) | (a == b) | (s == a), u).otherwise(u + (v - u) * (s - a) / (b - a))


def lower_hull(points: list[tuple]) -> list[tuple]:
    """The corners of the lower hull of points (x, y, ...) sorted by x, with rising slopes; whole numbers of any size."""
    out: list[tuple] = []
    for p in points:
        while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (p[0] - out[-2][0]) * (out[-1][1] - out[-2][1]):
            out.pop()
        out.append(p)
    return out


def _merge(table: pa.Table) -> pa.Table:
    columns = ("x", "y", "score", "next_score")
    bucket = table.column("bucket")[0].as_py()
    points = sorted(zip(*[table.column(c).to_pylist() for c in columns], strict=True), key=lambda p: p[0])
    kept = list(zip(*lower_hull(points), strict=True))
    return pa.table({"bucket": pa.array([bucket] * len(kept[0]), pa.int64()), "x": pa.array(kept[0], pa.int64()), "y": pa.array(kept[1], pa.int64()),
                     "score": pa.array(kept[2], pa.float64()), "next_score": pa.array(kept[3], pa.float64())})


def hull_of_scores(df: DataFrame, score: str, label: str, n_ranges: int | None = None) -> DataFrame:
    """x, y, score, next_score: corners of the hull; x counts rows and y positives up to the score. The origin has no score."""
    n = n_ranges or default_ranges(df)
    counts = cumulative_by_score(df, score, label, n_ranges=n)
    below, total = F.col("pos_below") + F.col("neg_below"), F.col("pos_total") + F.col("neg_total")
    # ranges of equal numbers of rows; a score with many rows is one point
    points = counts.select(F.floor(below * F.lit(n) / total).cast("long").alias("bucket"), (below + F.col("pos") + F.col("neg")).alias("x"),
                           (F.col("pos_below") + F.col("pos")).alias("y"), "score", "next_score")
    start = counts.agg(F.min("score").alias("next_score")).where("next_score IS NOT NULL").select(
        F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"),
        F.lit(None).cast("double").alias("score"), "next_score")
    hulls, left = points.unionByName(start).groupBy("bucket").applyInArrow(_merge, _POINT), n
    while left > 1:
        up = hulls.withColumn("bucket", F.floor(F.col("bucket") / F.lit(FAN)).cast("long"))
        hulls, left = up.groupBy("bucket").applyInArrow(_merge, _POINT), -(-left // FAN)
    return hulls.drop("bucket")


def isotonic_steps(df: DataFrame, score: str, label: str, n_ranges: int | None = None) -> list[tuple[float, float, int, float]]:
    """(lowest score, highest score, rows, value) of every constant step; the driver gets the fitted steps only."""
    corners = sorted(hull_of_scores(df, score, label, n_ranges).collect(), key=lambda r: r["x"])
    return [(a["next_score"], b["score"], b["x"] - a["x"], (b["y"] - a["y"]) / (b["x"] - a["x"])) for a, b in zip(corners, corners[1:], strict=False)]


def fit_isotonic(df: DataFrame, score: str, label: str, n_ranges: int | None = None) -> IsotonicMap:
    """The map of score to the isotonic share of positives. Rows without score or label are left out; an empty table gives a map to null."""
    bounds, values = [], []
    for low, high, _, value in isotonic_steps(df, score, label, n_ranges):
        for x in [low] if low == high else [low, high]:
            bounds.append(x)
            values.append(value)
    return IsotonicMap(bounds, values)
