"""Whole jobs driven by one configuration mapping with the sections ``kafka``, ``data`` and ``models``."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.operators.models import layered
from ledgerlark.operators.normalise import normalise, parse_payload
from ledgerlark.operators.sampling import HashOrder, most_recent
from ledgerlark.operators.scoring import ScoringModel
from ledgerlark.plans.search import best, candidates_for, search
from ledgerlark.plans.training import ROW_ID, Trained, train
from ledgerlark.schema import raw_csv_schema
from ledgerlark.session import materialise
from ledgerlark.sources.files import read_csv, read_with_fallback
from ledgerlark.sources.messages import read_messages
from ledgerlark.sources.runs import append_run
from ledgerlark.streaming.scoring import start_scoring

# --- Fixed values: configuration names and the settings they stand for ------------------------
_SHARES = {"subsample": "row_share", "colsample_bytree": "column_share"}
_TREES = {"n_estimators": "trees", "max_depth": "max_depth", "min_samples_leaf": "min_rows",
          "max_features": "max_features", "bootstrap": "bootstrap"}
PARAM_NAMES = {
    "xgboost": {"n_estimators": "iterations", "learning_rate": "learning_rate", "max_depth": "max_depth",
                "min_child_weight": "min_rows", "scale_pos_weight": "scale_pos_weight", "gamma": "min_gain", **_SHARES},
    "catboost": {"iterations": "iterations", "learning_rate": "learning_rate", "depth": "max_depth",
                 "subsample": "row_share", "rsm": "column_share", "min_data_in_leaf": "min_rows"},
    "lightgbm": {"n_estimators": "iterations", "learning_rate": "learning_rate", **_SHARES},
    "tabnet": {"max_iter": "iterations", "learning_rate": "learning_rate", "min_samples_leaf": "min_rows"},
    "logistic": {"C": "C", "max_iter": "max_iter", "penalty": "penalty", "l1_ratio": "l1_ratio",
                 "class_weight": "class_weight"},
    "decision_tree": {"criterion": "criterion", "max_depth": "max_depth", "min_samples_leaf": "min_rows"},
    "extra_tree": _TREES,
    "random_forest": _TREES,
    "mlp": {"hidden_layer_sizes": "hidden_layers", "max_iter": "max_iter", "tol": "tol"},
    "behaviour": {"n_estimators": "iterations"},
}
SETTING_NAMES = {
    "test_size": "test_size", "validation_size": "validation_size", "n_folds": "n_folds", "seed": "seed",
    "threshold_recall_target": "recall_target", "negative_downsample_ratio": "negative_ratio",
    "use_feature_selection": "select_features", "feature_selection_threshold": "importance_threshold",
    "max_features": "max_features", "noise_level": "fold_noise",
}
# --- end of fixed values ---------------------------------------------------------------------


def load_config(path: str) -> dict:
    try:
        import yaml
    except ImportError as missing:
        raise ImportError("reading a YAML configuration needs PyYAML; pass a mapping instead") from missing
    with open(path, encoding="utf-8") as text:
        return yaml.safe_load(text)


def model_section(config: Mapping, name: str) -> Mapping:
    section = (config.get("models") or {}).get(name)
    if not section:
        raise ValueError(f"no section models.{name} in the configuration")
    return section


def configured_params(config: Mapping, name: str) -> dict:
    """Parameters of the section under our names; names without a counterpart are left out."""
    given = model_section(config, name).get("params") or {}
    return {ours: given[theirs] for theirs, ours in PARAM_NAMES[name].items() if theirs in given}


def configured_settings(config: Mapping, name: str) -> dict:
    section = model_section(config, name)
    settings = {ours: section[theirs] for theirs, ours in SETTING_NAMES.items() if theirs in section}
    if "early_stopping_rounds" in section:
        settings["patience"] = int(section["early_stopping_rounds"])
    if "high_risk_merchants" in config:
        settings["high_risk_merchants"] = list(config["high_risk_merchants"])
    return settings


def ingest(spark: SparkSession, config: Mapping, max_rows: int | None = None) -> DataFrame:
    """Normalised transactions from the topic, else from the training CSV; the latest ``max_rows`` if given.

    ``max_rows`` defaults to the configured ``kafka.max_messages``; without either all rows are kept.
    """
    source = config.get("kafka") or {}
    messages_or_csv = read_with_fallback(
        lambda: parse_payload(read_messages(spark, source)),
        lambda: read_csv(spark, config["data"]["training_csv"], raw_csv_schema()))
    rows = materialise(normalise(messages_or_csv), "ingested")
    limit = max_rows or source.get("max_messages")
    return most_recent(rows, int(limit), order=HashOrder(ROW_ID)) if limit else rows


def run_training(spark: SparkSession, config: Mapping, name: str, runs: str | None = None,
                 override: Mapping | None = None, max_rows: int | None = None) -> Trained:
    """Ingest, train one family, record the run and save the model where the section says.

    Parameters layer as family defaults, configuration, override.
    """
    section = model_section(config, name)
    params = layered(configured_params(config, name), override)
    rows = ingest(spark, config, max_rows or section.get("max_messages"))
    trained = train(rows, name, params, configured_settings(config, name))
    if runs:
        append_run(spark, runs, name, trained.params, trained.metrics, trained.fold_metrics)
    if section.get("path"):
        trained.model.save(section["path"])
    return trained


def run_search(spark: SparkSession, config: Mapping, name: str, runs: str | None = None, limit: int | None = None,
               mode: str = "random", metric: str = "avg_precision", max_rows: int | None = None) -> dict:
    """Ingest, judge the family's candidates by cross-validation, record each of them and the best, return its parameters.

    ``limit`` and ``mode`` truncate a grid (see ``candidates_for``).
    """
    section = model_section(config, name)
    rows = ingest(spark, config, max_rows or section.get("max_messages"))
    results = materialise(search(rows, name, candidates_for(name, limit, mode), metric, configured_settings(config, name)), "search")
    found = best(results, metric)
    if runs:
        for r in results.orderBy("candidate").collect():         # one row per candidate
            append_run(spark, runs, f"{name}-candidate-{r['candidate']:02d}", json.loads(r["params"]),
                       {f"{metric}_mean": r[f"{metric}_mean"], f"{metric}_std": r[f"{metric}_std"]})
        top = results.agg(F.max(f"{metric}_mean")).first()[0]
        append_run(spark, runs, f"{name}-search", {f"best_{k}": v for k, v in found.items()}, {f"best_{metric}": top})
    return found


def run_scoring(spark: SparkSession, config: Mapping, checkpoint: str, name: str = "xgboost",
                output: Mapping | None = None, once: bool = False):
    """Score the test topic into the output topic with the saved model.

    A configured ``prediction_threshold`` replaces the one stored with the model.
    """
    section = model_section(config, name)
    model = ScoringModel.load(spark, section["path"])
    if "prediction_threshold" in section:
        model.threshold = float(section["prediction_threshold"])
    listed = {"merchants": list(config["high_risk_merchants"])} if "high_risk_merchants" in config else {}
    return start_scoring(spark, config["kafka"], output or config["kafka"], model, checkpoint, once, **listed)
