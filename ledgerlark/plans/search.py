"""Parameter searches: a list of candidates, each judged by cross-validation on the same table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from ledgerlark.operators import metrics
from ledgerlark.operators.models import (
    BEHAVIOUR_GRID, BOOSTING_GRID, IDLE, LOGISTIC_CANDIDATES, family, grid, layered,
)
from ledgerlark.operators.sampling import HashOrder
from ledgerlark.plans.training import HELD_OUT, ROW_ID, FoldLessons, Trained, _regressed_together, cross_validate, prepare, regress_folds, rows_for, train


def candidates_for(name: str, limit: int | None = None, mode: str = "random", seed: int = 42) -> list[dict]:
    if name == "logistic":
        return LOGISTIC_CANDIDATES[:limit]
    space = BEHAVIOUR_GRID if name == "behaviour" else BOOSTING_GRID
    return grid(space, limit, mode, seed)


def search(transactions: DataFrame, name: str, candidates: list[dict], metric: str = "avg_precision",
           settings: dict | None = None, parallelism: int = 4) -> DataFrame:
    """(candidate, params, <metric>_mean, <metric>_std), one row per candidate.

    The table is prepared once; folds, and what their preprocessing learns, are the same for all candidates. Candidates that differ only in parameters without an
    effect are the same model, which is judged once.
    """
    spec = family(name)
    settings = layered(spec.settings, settings, {"select_features": False})
    order = HashOrder(ROW_ID, settings["seed"])
    table = prepare(rows_for(transactions, spec, settings), spec, settings, order)
    in_train = table.filter(~F.col(HELD_OUT))
    results, judged, lessons = None, {}, FoldLessons(in_train, spec, settings)
    chosen = [layered(spec.params, candidate) for candidate in candidates]
    models = [repr(sorted((k, v) for k, v in params.items() if k not in IDLE)) for params in chosen]
    lessons.asked = list(dict(zip(models, chosen)).values())
    if name == "logistic" and _regressed_together(lessons):
        distinct = dict(zip(models, chosen))
        judged = {model: folds for model, (folds, _) in zip(distinct, regress_folds(lessons, list(distinct.values()), order))}
    for i, (candidate, params, model) in enumerate(zip(candidates, chosen, models), start=1):
        if model not in judged:
            judged[model], _ = cross_validate(in_train, spec, params, settings, order, None, parallelism, lessons)
        folds = judged[model]
        one = (metrics.cv_summary(folds.filter(F.col("metric") == metric))
               .select(F.lit(i).alias("candidate"), F.lit(json.dumps(candidate)).alias("params"),
                       F.col("mean").alias(f"{metric}_mean"), F.col("std").alias(f"{metric}_std")))
        results = one if results is None else results.unionByName(one)
    return results


def best(results: DataFrame, metric: str = "avg_precision") -> dict:
    """Parameters of the first candidate with the highest mean."""
    return json.loads(metrics.best_candidate(results, f"{metric}_mean").first()["params"])


def search_and_train(transactions: DataFrame, name: str, candidates: list[dict], metric: str = "avg_precision",
                     settings: dict | None = None) -> Trained:
    results = search(transactions, name, candidates, metric, settings)
    return train(transactions, name, best(results, metric), settings)
