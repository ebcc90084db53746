"""Quantiles, running counts, splits and correlation against brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.operators import split
from riskframe.operators.correlate import corr_pairs, target_corr
from riskframe.operators.cumulative import cumulative_by_score, range_code
from riskframe.operators.quantiles import class_quantiles, exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


@pytest.fixture(scope="module")
def odd_columns(spark):
    rng = np.random.default_rng(3)
    n = 4000
    pdf = pd.DataFrame({
        "normal": rng.normal(size=n), "tail": np.exp(rng.normal(0, 6, n)), "ties": rng.integers(0, 4, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.random(n)), "const": np.full(n, 5.0), "one": [3.5] + [np.nan] * (n - 1),
        "none": np.full(n, np.nan), "wide": rng.choice([-1.7e308, 0.0, 1.7e308], n), "half": np.where(rng.random(n) < 0.5, np.nan, rng.random(n)),
        "label": rng.integers(0, 2, n)})
    return pdf, spark.createDataFrame(pdf).repartition(7)


def test_quantiles_are_exact(odd_columns):
    pdf, df = odd_columns
    cols = [c for c in pdf if c != "label"]
    got = exact_quantiles(df, {c: F.col(c) for c in cols}, PROBS)
    for c in cols:
        vals = pdf[c].dropna()
        if vals.empty:
            assert got[c] == [None] * len(PROBS)
        elif c == "wide":
            assert got[c][3] in (-1.7e308, 0.0, 1.7e308)
        else:
            np.testing.assert_allclose(got[c], vals.quantile(PROBS), rtol=1e-12, atol=0)


def test_quantiles_survive_a_bad_sketch(odd_columns, monkeypatch):
    from riskframe.operators import quantiles as q
    pdf, df = odd_columns
    monkeypatch.setattr(q, "_ACCURACY", 3)  # brackets far off: more passes, same answer
    got = exact_quantiles(df, {"tail": F.col("tail")}, [0.3, 0.7])
    np.testing.assert_allclose(got["tail"], pdf["tail"].quantile([0.3, 0.7]), rtol=1e-12)


def test_quantiles_per_class(odd_columns):
    pdf, df = odd_columns
    got = class_quantiles(df, F.col("label"), [0, 1], {"normal": F.col("normal")}, [0.5])
    for c in (0, 1):
        assert got[c, "normal"][0] == pytest.approx(pdf[pdf.label == c].normal.median(), rel=1e-12)


@pytest.mark.parametrize("n_ranges", [1, 2, 9, 64])
def test_running_counts(spark, n_ranges):
    rng = np.random.default_rng(n_ranges)
    n = 3000
    score = np.where(rng.random(n) < 0.34, 0.5, np.round(rng.random(n), 3))  # a third of the rows share one score
    pdf = pd.DataFrame({"f": rng.choice(["a", "b"], n), "s": score, "y": rng.integers(0, 2, n)})
    got = cumulative_by_score(spark.createDataFrame(pdf), "s", "y", "f", n_ranges).toPandas()
    for f, part in pdf.groupby("f"):
        mine = got[got.feature == f].sort_values("score").reset_index(drop=True)
        want = part.groupby("s").y.agg(["sum", "count"]).reset_index()
        pos, neg = want["sum"], want["count"] - want["sum"]
        assert mine.score.tolist() == want.s.tolist()
        assert mine.pos_below.tolist() == (pos.cumsum() - pos).tolist()
        assert mine.neg_below.tolist() == (neg.cumsum() - neg).tolist()
        assert set(mine.pos_total) == {pos.sum()} and set(mine.neg_total) == {neg.sum()}
        assert mine.next_score[:-1].tolist() == want.s[1:].tolist() and math.isnan(mine.next_score.iloc[-1])


@pytest.fixture(scope="module")
def hundred(spark):
    return spark.createDataFrame([(i, 1 if i % 13 == 0 else 0) for i in range(1, 101)], "id long, y int")


def test_split_keeps_every_row_and_the_ratio(hundred):
    a = split.stratified_split(hundred, "id", "y", 0.2, 42).toPandas()
    b = split.stratified_split(hundred.repartition(5), "id", "y", 0.2, 42).toPandas()
    assert len(a) == 100 and a.id.is_unique and (a.split == "validation").sum() == 20
    assert a.sort_values("id").split.tolist() == b.sort_values("id").split.tolist()
    rates = a.groupby("split").y.mean()
    assert abs(rates["train"] - rates["validation"]) < 0.05
    other = split.stratified_split(hundred, "id", "y", 0.2, 7).toPandas()
    assert other.sort_values("id").split.tolist() != a.sort_values("id").split.tolist()


def test_split_is_a_predicate(hundred):
    plan = split.stratified_split(hundred, "id", "y", 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_repeated_keys_still_give_exact_sizes(spark):
    df = spark.createDataFrame([(i // 40, i) for i in range(200)], "id long, v int")
    assert split.sample_exact(df, "id", 57).count() == 57


def test_sample_and_folds(hundred):
    assert split.sample_exact(hundred, "id", 17).count() == 17
    assert split.sample_exact(hundred, "id", 500).count() == 100
    assert split.sample_stratified_cap(hundred, "id", "y", 30).count() == 30
    folds = split.stratified_folds(hundred, "id", "y", 3).toPandas()
    per = folds.groupby(["y", "fold"]).size().unstack()
    assert (per.max(axis=1) - per.min(axis=1) <= 1).all()
    assert split.repeated_folds(hundred, "id", "y", 3, 2).count() == 200
    whole = split.holdout_split(hundred.where("id < 15"), "id", "y", 0.2).toPandas()
    assert set(whole.part) == {"fit"}


def test_any_number_of_strata(spark, hundred, monkeypatch):
    rows = spark.range(30_000).select("id", (F.col("id") % 7000).cast("string").alias("s"))  # 2000 strata of 5 rows, 5000 of 4
    per = split.stratified_split(rows, "id", "s", 0.25).groupBy("s").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "validation").alias("v"))
    want = split.largest_remainder({str(i): 5 if i < 2000 else 4 for i in range(7000)}, 7500)
    assert {r.s: r.v for r in per.collect()} == want
    folds = split.stratified_folds(rows, "id", "s", 3).groupBy("s", "fold").count().groupBy("s").agg(F.max("count").alias("m"), F.min("count").alias("l"))
    assert folds.where("m - l > 1").isEmpty()
    few = {r.id: r.split for r in split.stratified_split(hundred, "id", "y", 0.2).collect()}
    monkeypatch.setattr(split, "FEW", 0)  # joined cuts give what literals give
    assert {r.id: r.split for r in split.stratified_split(hundred, "id", "y", 0.2).collect()} == few


@pytest.mark.parametrize("most", [0, 256])
def test_hot_keys_and_null_strata_are_cut_exactly(spark, monkeypatch, most):
    monkeypatch.setattr(split, "FEW", most)
    rows = spark.createDataFrame([(7 if i % 3 == 0 else i, None if i % 5 == 0 else "ab"[i % 2], i) for i in range(600)], "id long, s string, row long").repartition(6)
    got = split.stratified_split(rows, "id", "s", 0.3).groupBy("s").agg(F.count_if(F.col("split") == "validation").alias("v")).collect()
    want = split.largest_remainder({None: 120, "a": 240, "b": 240}, 180)
    assert {r.s: r.v for r in got} == want
    three = split.three_way_split(rows, "id", "s", 0.2, 0.1).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in three} == {"test": 60, "validation": math.ceil((0.1 + 0.2) * 600) - 60, "train": 600 - math.ceil((0.1 + 0.2) * 600)}
    again = split.repeated_folds(rows, "id", "s", 3, 3).groupBy("repeat", "s", "fold").count().collect()
    assert {(r.repeat, r.s, r["count"]) for r in again} == {(r, s, n) for r in (1, 2, 3) for s, n in ((None, 40), ("a", 80), ("b", 80))}


def test_correlation_is_pairwise_complete(odd_columns):
    pdf, df = odd_columns
    cols = ["normal", "ties", "hot", "half", "const", "label"]
    got = {(r.left_feature, r.right_feature): r.r for r in corr_pairs(df, cols).collect()}
    want = pdf[cols].corr()
    for (a, b), r in got.items():
        if math.isnan(want.loc[a, b]):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-10)
    narrow = {(r.left_feature, r.right_feature): r.r for r in corr_pairs(df, ["normal", "half", "const"]).collect()}
    assert narrow["normal", "half"] == pytest.approx(want.loc["normal", "half"], abs=1e-10)
    assert narrow["normal", "const"] is None
    t = {r.feature: r.corr for r in target_corr(df, ["half", "const"], "label").collect()}
    assert t["half"] == pytest.approx(want.loc["half", "label"], abs=1e-10) and t["const"] is None


def test_feature_rows_are_replaced_by_key(spark, tmp_path):
    from riskframe.sources import tables as t
    rows = spark.createDataFrame([(1, "train", 1.0), (2, "test", 2.0)], "id long, split string, x double")
    t.append_features(rows, str(tmp_path), "g", 1, key="id")
    again = spark.createDataFrame([(2, "train", 5.0), (3, "train", 3.0)], "id long, split string, x double")
    assert {tuple(r) for r in t.append_features(again, str(tmp_path), "g", 1, key="id").collect()} == {("train", 2)}
    found = {(r.id, r.split, r.x) for r in t.feature_view(spark, str(tmp_path), "g", 1).collect()}
    assert found == {(1, "train", 1.0), (2, "train", 5.0), (3, "train", 3.0)}
    t.append_features(rows, str(tmp_path), "g", 2)
    assert t.feature_view(spark, str(tmp_path), "g", 2).count() == 2 and t.feature_view(spark, str(tmp_path), "g", 1).count() == 3


def test_feature_appends_are_atomic_and_earlier_states_stay(spark, tmp_path, monkeypatch):
    from riskframe.sources import tables as t
    root, schema = str(tmp_path), "id long, split string, x double"
    read = lambda **k: {(r.id, r.split, r.x) for r in t.feature_view(spark, root, "g", 1, **k).collect()}
    t.append_features(spark.createDataFrame([(i, "a b" if i % 2 else None, float(i)) for i in range(40)], schema), root, "g", 1, "id", 4)
    first = read()
    assert len(first) == 40 and {s for _, s, _ in first} == {"a b", None}
    change = spark.createDataFrame([(7, "test", -1.0)], schema)
    publish = t._publish
    monkeypatch.setattr(t, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        t.append_features(change, root, "g", 1, "id")
    assert read() == first and t.feature_commits(spark, root, "g", 1) == [1]  # the files are there, the commit is not
    monkeypatch.setattr(t, "_publish", publish)
    t.append_features(change, root, "g", 1, "id")
    second = read()
    assert second == {r for r in first if r[0] != 7} | {(7, "test", -1.0)} and read(commit=1) == first
    assert read(split="test") == {(7, "test", -1.0)}
    old, new = (t._commit(spark, f"{root}/04_feature/g", 1, n)["folders"] for n in (1, 2))
    assert len({f[1] for f in old} - {f[1] for f in new if f not in old}) == 3  # one bucket of four was written
    wider = spark.createDataFrame([(100, "train", 1.0, "new")], schema + ", y string")
    t.append_features(wider, root, "g", 1)  # without key: rows are added
    assert read() == second | {(100, "train", 1.0)} and t.feature_view(spark, root, "g", 1).where("y = 'new'").count() == 1
    t.append_features(wider.withColumn("x", F.lit(2.0)), root, "g", 1, "id")
    assert read() == second | {(100, "train", 2.0)}
    with pytest.raises(RuntimeError, match="committed first"):
        publish(spark, f"{root}/04_feature/g", 1, 4, {})
    with pytest.raises(ValueError, match="no commit"):
        t.feature_view(spark, root, "g", 3)
    t.append_features(change.limit(0), root, "g", 1, "id")
    assert read() == second | {(100, "train", 2.0)}


@pytest.mark.parametrize("case", [(3, 2), (0, 5), (60, 0), (1, 1), (0, 0)])
def test_quantiles_with_infinite_values(spark, case):
    rng = np.random.default_rng(sum(case))
    finite = [*rng.normal(size=41).round(1).tolist(), 1.7e308, -1.7e308]
    values = [-math.inf] * case[0] + finite + [math.inf] * case[1]
    df = spark.createDataFrame([(x,) for x in [*values, None, math.nan]], "v double").repartition(3)
    probs = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, {"v": F.col("v")}, probs)["v"]
    at = sorted(values)
    for p, g in zip(probs, got):
        h = p * (len(at) - 1)
        a, b, part = at[math.floor(h)], at[math.ceil(h)], h - math.floor(h)
        want = a if part == 0 or a == b else -math.inf if a == -math.inf else math.inf if b == math.inf else a + (b - a) * part
        assert g == want or g == pytest.approx(want), p
    only = spark.createDataFrame([(math.inf,), (math.inf,), (-math.inf,)], "v double")
    assert exact_quantiles(only, {"v": F.col("v")}, [0.0, 0.5, 1.0])["v"] == [-math.inf, math.inf, math.inf]


def test_medians_and_outlier_bounds_with_infinite_values(spark):
    from riskframe.operators import clean
    df = spark.createDataFrame([(math.inf,), (math.inf,), (1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    assert clean.medians(df, ["v"])["v"] == 3.5
    stats = clean.outlier_stats(df.union(spark.createDataFrame([(0.0,)] * 6, "v double")), ["v"], 1.0).first()
    assert (stats.q1, stats.q3, stats.high_fence, stats.max_value, stats.n_outliers) == (0.0, 3.25, 6.5, math.inf, 2)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 399, 400])
def test_range_code_is_a_binary_search(spark, n):
    rng = np.random.default_rng(n)
    cuts = np.sort(rng.integers(0, 50, n) / 10).tolist()
    scores = [*cuts, *(rng.integers(-10, 70, 60) / 10).tolist(), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(x, cuts) for x in scores], "s double, c array<double>")
    code = range_code(F.col("s"), F.col("c"), n)
    want = [0 if x is None else int(np.searchsorted(cuts, x, "right")) for x in scores]
    assert [r.k for r in df.select(code.alias("k")).collect()] == want
    assert "filter(" not in str(code)  # a filter would look at every cut for every row
