"""Classifier families on MLlib's distributed trainers.

The trainers named after other libraries are the nearest MLlib algorithm with the same settings where a
setting exists there. They are substitutes, not numeric copies; see the README for the known gaps.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, functions as F

from ledgerlark.schema import BASE_NUMERIC, BEHAVIOUR_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES

LABEL, WEIGHT = "is_fraud", "class_weight"
MAX_TREE_DEPTH = 30      # MLlib's limit stands in for "unbounded"


@dataclass(frozen=True)
class Family:
    """How one classifier is trained and judged."""

    name: str
    build: Callable[[dict, int, dict], object]
    params: dict
    numeric: list[str]
    categorical: list[str]
    weight: str = "none"                   # form of class weights, see sampling.class_weights
    settings: dict = field(default_factory=dict)


def _gbt(params: dict, seed: int, info: dict):
    """``min_gain`` is a loss reduction summed over a node's rows; MLlib wants it per row, so the root decides its scale."""
    share = params.get("column_share", 1.0)
    return GBTClassifier(
        featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, seed=seed, maxIter=params["iterations"],
        stepSize=params["learning_rate"], maxDepth=params["max_depth"],
        subsamplingRate=params.get("row_share", 1.0), minInstancesPerNode=params.get("min_rows", 1),
        minInfoGain=params.get("min_gain", 0.0) / max(info["weight_sum"], 1.0),
        featureSubsetStrategy="all" if share >= 1 else str(share), maxBins=params.get("max_bins", 32))


def best_round(losses: list[float], patience: int) -> int:
    """Number of boosting rounds to keep: those up to the smallest loss before ``patience`` rounds without a smaller one."""
    best = 0
    for n, loss in enumerate(losses):
        if loss < losses[best]:
            best = n
        elif n - best >= patience:
            break
    return best + 1


def _logistic(params: dict, seed: int, info: dict):
    mix = {"l2": 0.0, "l1": 1.0, "elasticnet": params.get("l1_ratio", 0.5)}[params.get("penalty", "l2")]
    return LogisticRegression(
        featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, maxIter=params["max_iter"], tol=1e-6,
        regParam=1.0 / (params["C"] * info["weight_sum"]), elasticNetParam=mix, standardization=False)


def _tree(params: dict, seed: int, info: dict):
    return DecisionTreeClassifier(
        featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, seed=seed, impurity=params["criterion"],
        maxDepth=min(params["max_depth"] or MAX_TREE_DEPTH, MAX_TREE_DEPTH), minInstancesPerNode=params["min_rows"])


def _forest(params: dict, seed: int, info: dict):
    return RandomForestClassifier(
        featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, seed=seed, impurity="gini",
        numTrees=params["trees"], maxDepth=min(params["max_depth"] or MAX_TREE_DEPTH, MAX_TREE_DEPTH),
        minInstancesPerNode=params["min_rows"], featureSubsetStrategy=params["max_features"],
        bootstrap=params["bootstrap"])


def _perceptron(params: dict, seed: int, info: dict):
    return MultilayerPerceptronClassifier(
        featuresCol="features", labelCol=LABEL, seed=seed, maxIter=params["max_iter"], tol=params["tol"],
        layers=[info["width"], *params["hidden_layers"], 2], solver="l-bfgs")


# --- Fixed values: training settings per family ----------------------------------------------
_TUNED = {"test_size": 0.2, "validation_size": 0.1, "n_folds": 10, "recall_target": 0.9, "seed": 666,
          "patience": 25, "select_features": True, "importance_threshold": 0.01, "max_features": 10}
_SPLIT = {"test_size": 0.2, "n_folds": 10, "seed": 666, "threshold": 0.5}
_FULL = {"test_size": None, "n_folds": 10, "seed": 666, "threshold": 0.5}

FAMILIES = {f.name: f for f in (
    Family("xgboost", _gbt,
           {"iterations": 50, "learning_rate": 0.03, "max_depth": 2, "row_share": 0.6, "column_share": 0.6,
            "min_rows": 10, "scale_pos_weight": 10.0, "min_gain": 1.0},
           NUMERIC_FEATURES, CATEGORICAL_FEATURES, "scale_pos", {**_TUNED, "sample_noise": 0.05}),
    Family("catboost", _gbt,
           {"iterations": 50, "learning_rate": 0.03, "max_depth": 3, "row_share": 0.6, "column_share": 0.6,
            "min_rows": 10},
           NUMERIC_FEATURES, CATEGORICAL_FEATURES, "ratio", {**_TUNED, "sample_noise": 0.05}),
    Family("lightgbm", _gbt,
           {"iterations": 300, "learning_rate": 0.05, "max_depth": 5, "row_share": 0.8, "column_share": 0.8},
           BASE_NUMERIC, CATEGORICAL_FEATURES, "ratio_floor", _SPLIT),
    Family("tabnet", _gbt,
           {"iterations": 200, "learning_rate": 0.05, "max_depth": 5, "min_rows": 20},
           BASE_NUMERIC, CATEGORICAL_FEATURES, "none", _SPLIT),
    Family("logistic", _logistic,
           {"max_iter": 1000, "C": 1.0, "penalty": "l2", "class_weight": "balanced"},
           NUMERIC_FEATURES, CATEGORICAL_FEATURES, "balanced",
           {"test_size": 0.2, "n_folds": 10, "recall_target": 0.9, "seed": 666, "negative_ratio": 0.4}),
    Family("decision_tree", _tree,
           {"criterion": "gini", "max_depth": 10, "min_rows": 1},
           BASE_NUMERIC, CATEGORICAL_FEATURES, "balanced", _FULL),
    Family("extra_tree", _forest,
           {"trees": 100, "max_depth": 15, "min_rows": 1, "max_features": "sqrt", "bootstrap": False},
           BASE_NUMERIC, CATEGORICAL_FEATURES, "balanced", _FULL),
    Family("random_forest", _forest,
           {"trees": 300, "max_depth": None, "min_rows": 1, "max_features": "sqrt", "bootstrap": True},
           BASE_NUMERIC, CATEGORICAL_FEATURES, "ratio_floor", {**_SPLIT, "fold_noise": 0.05}),
    Family("mlp", _perceptron,
           {"hidden_layers": [256, 128, 64], "max_iter": 150, "tol": 0.0002},
           BASE_NUMERIC, CATEGORICAL_FEATURES, "none", _FULL),
    Family("behaviour", _gbt,
           {"iterations": 50, "learning_rate": 0.1, "max_depth": 5},
           [c for c in BEHAVIOUR_FEATURES if c != "merchant"], ["merchant"], "ratio",
           {"test_size": 0.2, "n_folds": 3, "seed": 666, "scale": False, "threshold_from_train": True}),
)}

LOGISTIC_CANDIDATES = [
    {"penalty": "l2", "C": 0.5, "class_weight": "balanced"},
    {"penalty": "l2", "C": 0.2, "class_weight": {0: 1, 1: 120}},
    {"penalty": "l2", "C": 0.05, "class_weight": {0: 1, 1: 200}},
    {"penalty": "l1", "C": 0.1, "class_weight": "balanced", "max_iter": 3000},
    {"penalty": "elasticnet", "C": 0.2, "l1_ratio": 0.5, "class_weight": "balanced", "max_iter": 3000},
    {"penalty": "l2", "C": 1.5, "class_weight": "balanced", "max_iter": 3000},
]

# These have no counterpart in MLlib and change nothing; they keep the candidates in order. Searches judge such equals once.
IDLE = {"max_delta_step", "reg_alpha"}
BOOSTING_GRID = {
    "max_depth": [4, 6],
    "min_rows": [1, 4],
    "min_gain": [0.0, 0.5],
    "row_share": [0.85, 0.95],
    "column_share": [0.8, 0.95],
    "learning_rate": [0.05, 0.08],
    "iterations": [120, 200],
    "max_delta_step": [0, 1],
}

BEHAVIOUR_GRID = {
    "max_depth": [3, 5],
    "learning_rate": [0.01, 0.1],
    "row_share": [0.6, 1.0],
    "column_share": [0.6, 1.0],
    "min_gain": [0, 0.1],
    "reg_alpha": [0, 0.5],
}
# --- end of fixed values ---------------------------------------------------------------------


def family(name: str) -> Family:
    if name not in FAMILIES:
        raise ValueError(f"unknown model family: {name}; known: {sorted(FAMILIES)}")
    return FAMILIES[name]


def layered(*layers: dict | None) -> dict:
    """Later layers win: defaults, configuration, override."""
    return {k: v for layer in layers for k, v in (layer or {}).items()}


def grid(space: dict[str, list], limit: int | None = None, mode: str = "random", seed: int = 42) -> list[dict]:
    """Parameter combinations: all, the ``first`` ones of the product, or a seeded ``random`` subset."""
    combos = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    if limit is None or limit >= len(combos):
        return combos
    if mode == "first":
        return combos[:limit]
    if mode == "random":
        return random.Random(seed).sample(combos, limit)
    raise ValueError(f"unknown grid mode: {mode}")


def importance_table(spark, names: list[str], model) -> DataFrame:
    """(feature, importance) with importances summing to 1, largest first."""
    values = model.importances() if hasattr(model, "importances") else [float(v) for v in model.featureImportances.toArray()]
    total = sum(values) or 1.0
    rows = [(n, v / total) for n, v in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def pick_features(importances: DataFrame, threshold: float, max_features: int) -> list[str]:
    """Features at or above the threshold, at most ``max_features``, largest first."""
    rows = [(r["feature"], r["importance"]) for r in importances.collect()]
    kept = [n for n, v in rows if v >= threshold] if threshold > 0 else [n for n, _ in rows]
    return kept[:max_features]
