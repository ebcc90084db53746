"""From a raw application table to a scored, monitored model: plain calls in order, one written table per stage."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, functions as F

from riskframe.functions.frames import numeric_columns, small_table, string_columns
from riskframe.operators import clean, drift, encode, evaluate, model, quality, score, select, split
from riskframe.plans import credit
from riskframe.sources import tables as t


@dataclass
class Settings:
    test_size: float = 0.2
    seed: int = 42
    n_features: int = 50
    rfe_step: int = 5
    rfe_trees: int = 100
    grids: Mapping[str, Mapping] = field(default_factory=lambda: credit.GRIDS)
    n_trials: int = 40
    search_families: tuple = tuple(model.FAMILIES)
    search_rows: int = 50_000
    folds: int = 4
    repeats: int = 1
    calibration: str | None = "isotonic"
    calibration_folds: int = 3
    strategy: str = "cost"
    cost_false_negative: float = 10.0
    cost_false_positive: float = 1.0


def validate(raw: DataFrame, root: str, name: str, labelled: bool = True) -> DataFrame:
    """The raw table if it passes its suite; the report is kept either way."""
    report = quality.quality_report(raw, credit.application_rules(labelled))
    return quality.quality_gate(raw, report, t.layer_path(root, "08_reporting", f"{name}_quality"))


def encode_splits(train: DataFrame, others: Mapping[str, DataFrame], root: str, seed: int = 42) -> dict[str, DataFrame]:
    """Binary maps, one-hot for short domains, smoothed target encoding for the rest; fitted on train only."""
    splits = {n: encode.binary_map(d, credit.BINARY) for n, d in {"train": train, **others}.items()}
    base = splits["train"]
    short = encode.small_domains(base, string_columns(base, [credit.ID]), credit.ONE_HOT_LIMIT)
    vocab = sorted((r.column_name, r.value, r.feature) for r in encode.onehot_vocabulary(base, short).collect()) if short else []
    splits = {n: encode.onehot_apply(d, vocab).drop(*short) for n, d in splits.items()}
    base = splits["train"]
    te = [c for c in credit.TARGET_ENCODED if c in base.columns]
    if te:
        t.write_artifact(encode.target_artifact(base, te, credit.TARGET, credit.FOLDS, credit.SMOOTHING),
                         t.layer_path(root, "06_models", "target_encoding"))
        prior = encode.target_mean(base, credit.TARGET)
        maps = {c: encode.target_map(base, c, credit.TARGET, credit.SMOOTHING, prior) for c in te}
        for n, d in splits.items():
            if n == "train":
                d = encode.target_encode_oof(d, credit.ID, te, credit.TARGET, credit.FOLDS, credit.SMOOTHING, seed)
            else:
                for c in te:
                    d = encode.target_encode_apply(d, c, maps[c], prior)
            splits[n] = d.drop(*te)
    left = string_columns(splits["train"], [credit.ID])
    return {n: t.sanitize_names(d.drop(*left)) for n, d in splits.items()}


def train(raw: DataFrame, unlabelled: DataFrame, root: str, cfg: Settings = Settings()) -> dict[str, Any]:
    """Validate, split, clean, build features, select, search, train, choose a threshold, evaluate.

    The threshold is tuned on one half of the validation split and reported on the other.
    """
    spark = raw.sparkSession
    raw = validate(raw, root, "train")
    unlabelled = validate(unlabelled, root, "unlabelled", labelled=False)
    parts = t.write_layer(split.stratified_split(raw, credit.ID, credit.TARGET, cfg.test_size, cfg.seed), root, "02_intermediate", "split")
    raw_train = parts.where("split = 'train'").drop("split")
    raw_val = parts.where("split = 'validation'").drop("split")

    art = clean.fit_cleaning(raw_train, credit.CLEANING)
    t.write_artifact(art.table(spark), t.layer_path(root, "06_models", "cleaning"))
    build = lambda d: credit.application_features(clean.apply_cleaning(d, art, credit.CLEANING))
    coded = encode_splits(build(raw_train), {"validation": build(raw_val), "unlabelled": build(unlabelled)}, root, cfg.seed)
    coded = {n: t.write_layer(d, root, "04_feature", n) for n, d in coded.items()}

    key, label = t.clean_name(credit.ID), t.clean_name(credit.TARGET)
    feats = numeric_columns(coded["train"], [key, label])
    kept = select.recursive_elimination(coded["train"], feats, label, min(cfg.n_features, len(feats)), cfg.rfe_step, cfg.rfe_trees, seed=cfg.seed)
    t.write_artifact(small_table(spark, [(i, f) for i, f in enumerate(kept)], "pos int, feature string"),
                     t.layer_path(root, "06_models", "selected_features"))
    model_in = select.apply_selection(coded, kept, key, label)
    data = {n: t.write_layer(model.prepare(d, kept, label if label in d.columns else None, [key]), root, "05_model_input", n)
            for n, d in model_in.items()}

    grid, _ = model.grid_search(data["train"], key, label, kept, cfg.grids, cfg.folds, cfg.seed, cfg.search_rows, repeats=cfg.repeats)
    found = model.random_search(data["train"], key, label, kept, cfg.n_trials, cfg.search_families, folds=cfg.folds, seed=cfg.seed,
                                max_rows=cfg.search_rows, repeats=cfg.repeats)[0] if cfg.n_trials else {}
    best = model.choose_best(grid, found)
    fitted = model.train_final(data["train"], key, label, best, kept, True, cfg.calibration, cfg.calibration_folds, cfg.seed)

    model.save_model(fitted, t.layer_path(root, "06_models", "model"), spark)
    t.write_record(small_table(spark, [(json.dumps(best, sort_keys=True),)], "record string"), t.layer_path(root, "06_models", "best"))

    scored = t.write_layer(model.probability(fitted, data["validation"]).select(key, label, "probability"), root, "07_model_output", "validation")
    halves = split.stratified_split(scored, key, label, 0.5, cfg.seed, ("report", "tune"), "half")
    chosen = t.write_record(
        evaluate.threshold_search(halves.where("half = 'tune'"), "probability", label, cfg.strategy,
                                  cost_fn=cfg.cost_false_negative, cost_fp=cfg.cost_false_positive),
        t.layer_path(root, "08_reporting", "threshold"))
    threshold = chosen.first()["threshold"]
    metrics = t.write_record(
        evaluate.credit_panel(halves.where("half = 'report'"), "probability", label, threshold, "test_",
                              cfg.cost_false_negative, cfg.cost_false_positive),
        t.layer_path(root, "08_reporting", "metrics"))
    if "unlabelled" in data:
        predict(data["unlabelled"], root, key, "unlabelled")
    return {"model": fitted, "features": kept, "best": best, "threshold": threshold, "metrics": metrics, "cleaning": art, "inputs": data}


def predict(features: DataFrame, root: str, key: str, name: str) -> DataFrame:
    """Scores a table of model columns with the stored model and threshold; writes predictions and a serving record."""
    spark = features.sparkSession
    fitted = model.load_model(t.layer_path(root, "06_models", "model"), spark)
    threshold = spark.read.schema("threshold double").json(t.layer_path(root, "08_reporting", "threshold")).first()["threshold"]
    scored = model.probability(fitted, features).select(
        key, "probability", score.decide(F.col("probability"), threshold).alias("predicted_class"), F.lit(float(threshold)).alias("threshold"))
    scored = t.write_layer(scored, root, "07_model_output", f"predictions_{name}")
    t.write_record(score.batch_summary(scored), t.layer_path(root, "08_reporting", f"serving_{name}"))
    return scored


def monitor(reference: DataFrame, current: DataFrame, root: str) -> DataFrame:
    """Drift table and alert of a scoring batch against the training features; returns the alert."""
    table = t.write_layer(drift.drift_table(reference, current, skip=[credit.ID, t.clean_name(credit.ID), t.clean_name(credit.TARGET)]),
                          root, "08_reporting", "drift")
    return t.write_record(drift.drift_alert(table), t.layer_path(root, "08_reporting", "drift_alert"))
