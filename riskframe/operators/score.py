"""Scoring contract, batch scoring, and the raw-record path shared by batch and stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskframe.functions.scalars import col, flag
from riskframe.operators import clean, encode
from riskframe.sources.staging import lookup_side

TARGET_RATE_FALLBACK = 0.0807  # fixed value: default of a target encoding without a fitted map


def spaces_to_underscores(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def contract_gaps(required: Sequence[str], df: DataFrame) -> tuple[list[str], list[str]]:
    """(missing columns, columns that will be ignored)."""
    have, need = set(df.columns), set(required)
    return [c for c in required if c not in have], [c for c in df.columns if c not in need]


def check_contract(required: Sequence[str], df: DataFrame) -> None:
    missing, _ = contract_gaps(required, df)
    if missing:
        raise ValueError(f"{len(missing)} required column(s) missing from the input: {missing[:5]}")


def decide(probability: Column, threshold: float) -> Column:
    return flag(probability >= F.lit(float(threshold)))


def score_features(df: DataFrame, features: Sequence[str], score: Callable[[DataFrame], DataFrame],
                   threshold: float | Mapping, id_column: str | None = None) -> DataFrame:
    """``[id], probability, predicted_class``. ``score`` adds ``probability`` to the feature columns;
    the threshold is a number or a record with the key 'threshold'."""
    t = float(threshold["threshold"]) if isinstance(threshold, Mapping) else float(threshold)
    named = spaces_to_underscores(df)
    check_contract(features, named)
    ident = [id_column] if id_column and id_column in named.columns else []
    scored = score(named.select(*[col(c) for c in [*ident, *features]]))
    return scored.select(*[col(c) for c in ident], "probability", decide(F.col("probability"), t).alias("predicted_class"))


def linear_score(coefficients: Mapping[str, float], intercept: float = 0.0) -> Callable[[DataFrame], DataFrame]:
    """A logistic scorer from given coefficients."""
    def run(df: DataFrame) -> DataFrame:
        z = F.lit(float(intercept))
        for f, w in coefficients.items():
            z = z + F.lit(float(w)) * F.coalesce(col(f).cast("double"), F.lit(0.0))
        return df.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    return run


def batch_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("n_rows"), (100.0 * F.avg("predicted_class")).alias("positive_percent"))


def raw_to_features(df: DataFrame, art: clean.CleaningArtifact, cfg: clean.CleaningConfig,
                    build: Callable[[DataFrame], DataFrame], binary: Mapping[str, Mapping[str, int]],
                    onehot: Mapping[str, tuple[str, str]], target_encoded: Mapping[str, DataFrame | None],
                    model_columns: Sequence[str], keep: Sequence[str] = (), priors: Mapping[str, float] | None = None) -> DataFrame:
    """Raw rows -> model columns plus ``fallback_features``: one projection and a look-up per fitted map.

    ``build`` adds the stateless features. ``target_encoded`` maps an output ``{source}_TE`` to its fitted
    ``category, encoding`` table, or to None for the constant fallback. Maps are looked up with the cleaned value, as
    they are fitted in training; a category that a map lacks takes its entry of ``priors`` (default: the constant).
    One-hot rules read the raw value; model columns nobody produced become 0.0 and are reported.
    """
    raw = {src: f"__raw_{src}" for src, _ in onehot.values() if src in df.columns}
    tmp = df.select("*", *[col(c).alias(n) for c, n in raw.items()])
    out = clean.apply_cleaning(tmp, art, cfg)
    out = encode.binary_map(build(out), binary)
    fallback: list[str] = []
    extra: dict[str, Column] = {}
    for name, (src, value) in onehot.items():
        extra[name] = flag(F.col(raw[src]) == F.lit(value)) if src in raw else F.lit(0)
    for name, fitted in target_encoded.items():
        src = name[:-3]
        if fitted is not None and src in out.columns:
            m = lookup_side(fitted.select(F.col("category").alias("__cat"), F.col("encoding").alias("__enc")), "encoding")
            out = out.join(m, col(src).cast("string") == F.col("__cat").cast("string"), "left").withColumn(
                name, F.coalesce("__enc", F.lit((priors or {}).get(name, TARGET_RATE_FALLBACK)))).drop("__cat", "__enc")
        else:
            extra[name] = F.lit(TARGET_RATE_FALLBACK)
            fallback.append(name)
    out = out.withColumns(extra)
    absent = [c for c in model_columns if c not in out.columns]
    fallback += absent
    if absent:
        out = out.withColumns({c: F.lit(0.0) for c in absent})
    return out.select(*[col(c) for c in keep], *[col(c) for c in model_columns],
                      F.array(*[F.lit(f) for f in fallback]).cast("array<string>").alias("fallback_features"))


def score_raw(df: DataFrame, to_features: Callable[[DataFrame], DataFrame], features: Sequence[str],
              score: Callable[[DataFrame], DataFrame], threshold: float, id_column: str) -> DataFrame:
    """Raw rows -> probability, class, threshold and fallbacks."""
    feats = to_features(df)
    check_contract(features, feats)
    scored = score(feats)
    return scored.select(col(id_column), "probability", decide(F.col("probability"), threshold).alias("predicted_class"),
                         F.lit(float(threshold)).alias("threshold"), "fallback_features")
