"""Encoders: statistics come from the training split, replay is a projection or a small join."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.functions.frames import (
    dtype_of, long_form, numeric_columns, small_table, string_columns, value_of, wide_agg,
)
from riskframe.functions.hashing import hash60
from riskframe.functions.scalars import add_all, col, edge_code, flag, safe_div
from riskframe.operators.clean import value_counts
from riskframe.operators.quantiles import exact_quantiles
from riskframe.sources.staging import lookup_side, stage

NULL_LEVEL = "__nan__"
UNLISTED = 0.0


# --- binary maps ---------------------------------------------------------------

def _mapped(c: Column, mapping: Mapping[str, int]) -> Column:
    expr = None
    for value, code in mapping.items():
        expr = F.when(c == F.lit(value), F.lit(code)) if expr is None else expr.when(c == F.lit(value), F.lit(code))
    return expr


def binary_map(df: DataFrame, maps: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """Value -> integer; anything unmapped becomes null."""
    return df.withColumns({c: _mapped(col(c), m) for c, m in maps.items() if c in df.columns})


def binary_map_filled(df: DataFrame, maps: Mapping[str, Mapping[str, int]], fill: Mapping[str, str]) -> DataFrame:
    """Nulls take the training mode first; what is still unmapped becomes -1."""
    out = {}
    for c, m in maps.items():
        if c in df.columns:
            v = F.coalesce(col(c), F.lit(fill[c])) if fill.get(c) is not None else col(c)
            out[c] = F.coalesce(_mapped(v, m), F.lit(-1))
    return df.withColumns(out)


# --- cardinality gate and one-hot ------------------------------------------------

def cardinality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_name, n_unique`` over present values, all columns in one job."""
    counts = value_counts(df, cols).groupBy("column_name").agg(F.count("*").alias("n_unique"))
    names = small_table(df.sparkSession, [(c,) for c in cols], "column_name string")
    return names.join(counts, "column_name", "left").fillna(0, ["n_unique"])


def small_domains(df: DataFrame, cols: Sequence[str], limit: int) -> list[str]:
    """Columns with at most ``limit`` distinct values.

    A sketch rules out columns far above the limit, so only short domains are counted exactly.
    """
    if not cols:
        return []
    rough = wide_agg(df, {c: F.approx_count_distinct(value_of(df, c), 0.02) for c in cols})
    near = [c for c in cols if rough[c] <= 2 * limit + 10]
    if not near:
        return []
    exact = {r.column_name: r.n_unique for r in cardinality(df, near).collect()}
    return [c for c in cols if c in exact and exact[c] <= limit]


def cardinality_gate(df: DataFrame, limit: int = 10, skip: Sequence[str] = ()) -> DataFrame:
    return cardinality(df, string_columns(df, skip)).withColumn(
        "encoder", F.when(F.col("n_unique") <= limit, "one_hot").otherwise("target"))


def onehot_vocabulary(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column_name, value, feature`` of the present training values; a short table for gated columns."""
    return value_counts(train, cols).select(
        "column_name", "value", F.concat_ws("_", "column_name", "value").alias("feature"))


def onehot_apply(df: DataFrame, vocabulary: Sequence[tuple[str, str, str]], drop: bool = True) -> DataFrame:
    """0/1 column per (column, value, feature); unseen values and nulls are all zero."""
    hot = {f: flag(col(c).cast("string") == F.lit(v)) for c, v, f in vocabulary if c in df.columns}
    hot |= {f: F.lit(0) for c, v, f in vocabulary if c not in df.columns}
    out = df.withColumns(hot)
    return out.drop(*{c for c, _, _ in vocabulary}) if drop else out


def onehot_fit_apply(train: DataFrame, tables: Mapping[str, DataFrame], limit: int = 10,
                     skip: Sequence[str] = ()) -> dict[str, DataFrame]:
    cols = small_domains(train, string_columns(train, skip), limit)
    vocab = sorted((r.column_name, r.value, r.feature) for r in onehot_vocabulary(train, cols).collect()) if cols else []
    return {n: onehot_apply(t, vocab).drop(*cols) for n, t in tables.items()}


def rule_onehot(df: DataFrame, rules: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Fixed rules: output -> (source column, exact value); null or an absent source gives 0."""
    return df.withColumns({
        out: flag(col(src) == F.lit(value)) if src in df.columns else F.lit(0)
        for out, (src, value) in rules.items()})


def drop_text(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Drops the string columns that are left after encoding."""
    return df.drop(*string_columns(df, skip))


# --- target encoding ---------------------------------------------------------------

def _smooth(total: Column, n: Column, prior: Column, smoothing: float) -> Column:
    return (total + F.lit(float(smoothing)) * prior) / (n + F.lit(float(smoothing)))


def target_mean(train: DataFrame, target: str) -> float:
    return train.agg(F.avg(col(target).cast("double"))).first()[0]


def target_map(train: DataFrame, column: str, target: str, smoothing: float = 10, prior: float | None = None) -> DataFrame:
    """``category, n, encoding`` from the full training split."""
    g = target_mean(train, target) if prior is None else prior
    return (train.where(col(column).isNotNull()).groupBy(col(column).alias("category"))
            .agg(F.count("*").alias("n"), F.sum(col(target).cast("double")).alias("total"))
            .select("category", "n", _smooth(F.col("total"), F.col("n"), F.lit(g), smoothing).alias("encoding")))


def target_encode_oof(train: DataFrame, key: str, columns: Sequence[str], target: str, folds: int = 5,
                      smoothing: float = 10, seed: int = 42) -> DataFrame:
    """Out-of-fold encoding, ``{column}_TE`` per column.

    One aggregation per column gives every category its totals and its sums per fold; the sums of the other
    folds are the total minus the own fold, so the table is not scanned once per fold.
    """
    g = target_mean(train, target)
    out = train.withColumn("__fold", F.pmod(hash60(col(key), seed), F.lit(folds)).cast("int"))
    for c in columns:
        if c not in train.columns:
            continue
        y = col(target).cast("double")
        own = [(F.count_if(F.col("__fold") == f), F.sum(F.when(F.col("__fold") == f, y))) for f in range(folds)]
        sums = out.where(col(c).isNotNull()).groupBy(col(c).alias("__cat")).agg(
            F.count("*").alias("n"), F.sum(y).alias("t"),
            *[e.alias(f"{w}{f}") for f, pair in enumerate(own) for w, e in zip("nt", pair)])
        rest = [F.struct(F.lit(f).alias("__f"), F.when(
            F.col("n") > F.col(f"n{f}"),
            _smooth(F.col("t") - F.coalesce(f"t{f}", F.lit(0.0)), F.col("n") - F.col(f"n{f}"), F.lit(g), smoothing)).alias("__enc"))
            for f in range(folds)]
        enc = lookup_side(sums.select("__cat", F.inline(F.array(*rest))), "oof")
        out = (out.join(enc, (col(c) == F.col("__cat")) & (F.col("__fold") == F.col("__f")), "left")
               .withColumn(f"{c}_TE", F.coalesce("__enc", F.lit(g))).drop("__cat", "__f", "__enc"))
    return out.drop("__fold")


def target_encode_apply(df: DataFrame, column: str, mapping: DataFrame, prior: float) -> DataFrame:
    """Full-training encoding on another split; unknown and null categories take the prior."""
    m = lookup_side(mapping.select(F.col("category").alias("__cat"), F.col("encoding").alias("__enc")), "encoding")
    return (df.join(m, col(column) == F.col("__cat"), "left")
            .withColumn(f"{column}_TE", F.coalesce("__enc", F.lit(prior))).drop("__cat", "__enc"))


def target_artifact(train: DataFrame, columns: Sequence[str], target: str, folds: int = 5, smoothing: float = 10) -> DataFrame:
    """The mapping table that serving needs: one row per (column, category)."""
    g = target_mean(train, target)
    long = long_form(train, {c: col(c).cast("string") for c in columns}, keep=[col(target).cast("double").alias("__y")],
                     name="column_name", value="category")
    return (long.where("category is not null").groupBy("column_name", "category")
            .agg(F.count("*").alias("n"), F.sum("__y").alias("total"))
            .select("column_name", "category", _smooth(F.col("total"), F.col("n"), F.lit(g), smoothing).alias("encoding"),
                    F.lit(g).alias("global_mean"), F.lit(int(smoothing)).alias("smoothing"), F.lit(int(folds)).alias("n_folds")))


# --- weight of evidence ---------------------------------------------------------------

MAX_CASE_BINS = 200  # features with more bins are looked up by a join


@dataclass
class WoeModel:
    """Fitted bins: inner edges of numeric features and the WOE of every (feature, bin).

    ``table`` holds the bins of all features. ``woe`` repeats those of features with few bins for the CASE
    look-up; ``wide`` names the features that are looked up by a join.
    """

    edges: dict[str, list[float]] = field(default_factory=dict)
    categorical: list[str] = field(default_factory=list)
    woe: dict[str, dict[str, float]] = field(default_factory=dict)
    wide: list[str] = field(default_factory=list)
    table: DataFrame | None = None

    @property
    def features(self) -> list[str]:
        return [*self.edges, *self.categorical]


def woe_edges(train: DataFrame, cols: Sequence[str], n_bins: int = 10) -> dict[str, list[float]]:
    """Inner quantile edges without duplicates."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    q = exact_quantiles(train, {c: value_of(train, c) for c in cols}, probs)
    out = {}
    for c, edges in q.items():
        distinct = sorted({e for e in edges if e is not None})
        out[c] = distinct[1:-1]
    return out


def numeric_bin(c: Column, inner: Sequence[float]) -> Column:
    """Number of inner edges <= value as text; null is its own bin -1."""
    return F.coalesce(edge_code(c.cast("double"), inner), F.lit(-1)).cast("string")


def level_bin(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(NULL_LEVEL))


def split_feature_kinds(train: DataFrame, features: Sequence[str], max_levels: int = 20) -> tuple[list[str], list[str]]:
    """(binned numeric features, per-level features)."""
    numeric = [f for f in numeric_columns(train) if f in set(features)]
    few = set(small_domains(train, numeric, max_levels))
    binned = [f for f in features if f in numeric and f not in few]
    return binned, [f for f in features if f not in binned]


def woe_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], levels: Sequence[str]) -> dict[str, Column]:
    bins = {f: numeric_bin(value_of(df, f) if f in df.columns else F.lit(None), e) for f, e in edges.items()}
    bins.update({f: level_bin(value_of(df, f) if f in df.columns else F.lit(None)) for f in levels})
    return bins


def woe_table(train: DataFrame, target: str, edges: Mapping[str, Sequence[float]], levels: Sequence[str],
              smoothing: float = 0.5) -> DataFrame:
    """``feature, bin, good, bad, woe, iv`` for all features from one aggregation."""
    s = float(smoothing)
    y = col(target).cast("double")
    totals = train.agg(F.sum(y).alias("b"), F.count(y).alias("n")).first()
    bad_all, good_all = float(totals.b or 0.0), float(totals.n - (totals.b or 0.0))
    long = long_form(train, woe_bins(train, edges, levels), keep=[y.alias("__y")], value="bin")
    counts = long.groupBy("feature", "bin").agg(
        F.sum(1.0 - F.col("__y")).alias("good"), F.sum("__y").alias("bad"))
    dg = (F.col("good") + s) / F.lit(good_all + 2 * s)
    db = (F.col("bad") + s) / F.lit(bad_all + 2 * s)
    woe = F.log(dg / db)
    return counts.select("feature", "bin", "good", "bad", woe.alias("woe"), ((dg - db) * woe).alias("iv"))


def fit_woe(train: DataFrame, target: str, features: Sequence[str], n_bins: int = 10, smoothing: float = 0.5,
            max_levels: int = 20) -> WoeModel:
    binned, levels = split_feature_kinds(train, features, max_levels)
    edges = woe_edges(train, binned, n_bins)
    model = WoeModel(edges, levels)
    fitted = woe_table(train, target, edges, levels, smoothing).select("feature", "bin", "woe")
    model.table = stage(fitted, "woe")
    sizes = {r.feature: r["n"] for r in model.table.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    model.wide = [f for f, n in sizes.items() if n > MAX_CASE_BINS]
    for r in model.table.where(~F.col("feature").isin(model.wide)).collect():  # at most MAX_CASE_BINS per feature
        model.woe.setdefault(r.feature, {})[r.bin] = r.woe
    return model


def woe_apply(df: DataFrame, model: WoeModel, suffix: str = "_WOE") -> DataFrame:
    """WOE per feature as a generated CASE, or as a join where the bins are many.

    Unseen bins are neutral, an absent column counts as null.
    """
    bins = woe_bins(df, model.edges, model.categorical)
    out, result = {}, df
    for f, b in bins.items():
        if f in model.wide:
            continue
        expr = None
        for value, w in sorted(model.woe.get(f, {}).items()):
            hit = b == F.lit(value)
            expr = F.when(hit, F.lit(w)) if expr is None else expr.when(hit, F.lit(w))
        out[f + suffix] = expr.otherwise(F.lit(UNLISTED)) if expr is not None else F.lit(UNLISTED)
    result = result.withColumns(out)
    for f in model.wide:
        m = lookup_side(model.table.where(F.col("feature") == f).select(
            F.col("bin").alias("__bin"), F.col("woe").alias("__woe")), "woe")
        result = (result.withColumn("__b", bins[f]).join(m, F.col("__b") == F.col("__bin"), "left")
                  .withColumn(f + suffix, F.coalesce("__woe", F.lit(UNLISTED))).drop("__b", "__bin", "__woe"))
    return result


def information_value(table: DataFrame) -> DataFrame:
    return (table.groupBy("feature").agg(F.sum("iv").alias("information_value"))
            .orderBy(F.col("information_value").desc(), "feature"))


# --- scaling ---------------------------------------------------------------------------

def fit_scaler(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column."""
    m = wide_agg(train, {f"{w}{c}": fn(value_of(train, c).cast("double")) for c in cols
                         for w, fn in (("m:", F.avg), ("s:", F.stddev_pop))})
    return {c: (m[f"m:{c}"] or 0.0, m[f"s:{c}"] or 0.0) for c in cols}


def standardize(df: DataFrame, scaler: Mapping[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - mean) / std; a constant column is only centred."""
    return df.withColumns({c + suffix: (value_of(df, c).cast("double") - F.lit(m)) / F.lit(s if s > 0 else 1.0)
                           for c, (m, s) in scaler.items()})
