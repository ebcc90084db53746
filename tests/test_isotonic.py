"""Isotonic maps against brute force and against the library's own fit."""

import random

import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from riskframe.operators import isotonic
from riskframe.operators.isotonic import IsotonicMap, fit_isotonic


def max_min(rows):
    """score -> fitted value by the max-min formula."""
    at = sorted({s for s, _ in rows})
    pos, n = ([sum(y if k == 0 else 1 for s, y in rows if s == a) for a in at] for k in (0, 1))
    mean = lambda a, b: sum(pos[a:b + 1]) / sum(n[a:b + 1])
    return {s: max(min(mean(a, b) for b in range(i, len(at))) for a in range(i + 1)) for i, s in enumerate(at)}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    return [(round(rng.random() ** 2, 2), int(rng.random() < 0.4)) for _ in range(400)] + [(0.5, i % 2) for i in range(300)]


@pytest.mark.parametrize("n_ranges", [1, 3, 40, 700])
def test_fit_equals_the_max_min_formula(spark, rows, n_ranges):
    df = spark.createDataFrame([*rows, (None, 1), (0.3, None), (float("nan"), 1)], "p double, y int")
    fitted = fit_isotonic(df, "p", "y", n_ranges)
    want = max_min(rows)
    got = {r.p: r.v for r in df.where("p IS NOT NULL AND NOT isnan(p)").select("p", fitted.predict(F.col("p")).alias("v")).distinct().collect()}
    assert set(got) == set(want) and all(got[s] == pytest.approx(want[s], abs=1e-12) for s in want)


def test_values_between_and_outside_the_scores(spark, rows):
    df = spark.createDataFrame(rows, "p double, y int")
    own = IsotonicRegression(featuresCol="p", labelCol="y").fit(df.withColumn("y", F.col("y").cast("double")))
    fitted = fit_isotonic(df, "p", "y")
    probe = spark.createDataFrame([(x / 997 * 1.4 - 0.2,) for x in range(998)] + [(None,)], "p double")
    both = own.transform(probe.where("p IS NOT NULL")).withColumn("v", fitted.predict(F.col("p")))
    assert both.where("abs(prediction - v) > 1e-9 OR v IS NULL").count() == 0
    assert probe.where("p IS NULL").select(fitted.predict(F.col("p"))).first()[0] is None


def test_no_task_holds_more_than_a_range_or_a_few_hulls(spark, rows):
    df = spark.createDataFrame(rows, "p double, y int")
    seen = spark.sparkContext.accumulator(0)
    plain, n = isotonic._merge, 64

    def watched(table):
        if table.num_rows > 40:
            seen.add(1)
        return plain(table)

    isotonic._merge = watched
    try:
        assert isotonic.isotonic_steps(df, "p", "y", n)
    finally:
        isotonic._merge = plain
    assert seen.value == 0  # 101 scores in 64 ranges


def test_one_score_one_class_and_no_rows(spark):
    one = fit_isotonic(spark.createDataFrame([(0.5, 1), (0.5, 0)], "p double, y int"), "p", "y")
    assert (list(one.bounds), list(one.values)) == ([0.5], [0.5])
    same = fit_isotonic(spark.createDataFrame([(0.1, 0), (0.9, 0)], "p double, y int"), "p", "y")
    assert set(same.values) == {0.0}
    none = fit_isotonic(spark.createDataFrame([], "p double, y int"), "p", "y")
    assert none == IsotonicMap([], []) and spark.range(1).select(none.predict(F.lit(0.5))).first()[0] is None
