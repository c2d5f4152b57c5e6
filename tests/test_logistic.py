import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlark.operators import foldstats, logistic, models, preprocess
from ledgerlark.operators.sampling import HashOrder, add_class_weight
from ledgerlark.plans import training

SPEC = models.Family("logistic", models.family("logistic").build, {"max_iter": 1000, "C": 1.0, "penalty": "l2", "class_weight": "balanced"},
                     ["amount", "age", "flat"], ["shop", "state"], "balanced")
SETTINGS = {"n_folds": 3, "recall_target": 0.9, "seed": 1}
CANDIDATES = [dict(SPEC.params, **c) for c in (
    {}, {"C": 0.01, "class_weight": {0: 1, 1: 20}}, {"C": 0.02, "penalty": "l1"}, {"C": 0.05, "penalty": "elasticnet", "l1_ratio": 0.5})]


@pytest.fixture(scope="module")
def rows(spark):
    """Missing numbers and categories, a constant, a category of one fold alone, and a rare label."""
    rng, out = np.random.default_rng(5), []
    for i in range(2500):
        amount, shop = float(rng.lognormal(3, 1)), int(rng.integers(0, 6))
        fold = int(rng.integers(0, 3))
        fraud = int(rng.random() < 1 / (1 + np.exp(4.5 - amount / 40 - (shop == 3))))
        out.append((f"t{i}", None if i % 17 == 0 else amount, float(rng.normal(40, 9)), 2.0, None if i % 23 == 0 else f"s{shop}",
                    "only" if fold == 1 and i % 5 == 0 else "é'x", fraud, fold))
    return spark.createDataFrame(out, "transaction_id string, amount double, age double, flat double, shop string, state string, "
                                      "is_fraud int, fold int").repartition(4)


def test_folds_and_candidates_together_equal_separate_fits(rows):
    lessons = training.FoldLessons(rows, SPEC, SETTINGS)
    together = training.regress_folds(lessons, CANDIDATES, HashOrder("transaction_id", 1))
    for params, (long, scores) in zip(CANDIDATES, together):
        got = {r["transaction_id"]: (r["fold"], r["label"], r["score"]) for r in scores.collect()}
        assert len(got) == scores.count() == rows.count()
        for fold in range(3):
            inside, outside = rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)
            weights, total = training._weights(SPEC, params, inside)
            estimator = SPEC.build(params, 1, {"weight_sum": total, "width": 5}).copy()
            estimator.setTol(1e-12)
            known = preprocess.transform(add_class_weight(inside, weights, "is_fraud", models.WEIGHT), lessons.fits[fold])
            model = estimator.fit(known.select("features", "is_fraud", models.WEIGHT))
            for r in model.transform(preprocess.transform(outside, lessons.fits[fold])).select(
                    "transaction_id", "is_fraud", vector_to_array("probability")[1].alias("p")).collect():
                assert got[r["transaction_id"]][:2] == (fold, r["is_fraud"])
                assert got[r["transaction_id"]][2] == pytest.approx(r["p"], abs=2e-4)
        assert {r["fold"] for r in long.collect()} == {0, 1, 2}


def test_a_few_passes_serve_all_folds_and_candidates(spark, rows, monkeypatch):
    passes, used = [], logistic._pass
    monkeypatch.setattr(logistic, "_pass", lambda *args: passes.append(len(args[3])) or used(*args))
    monkeypatch.setattr(models.LogisticRegression, "fit", None)          # no fold is fitted by itself
    lessons = training.FoldLessons(rows, SPEC, SETTINGS)
    long, scores = training.cross_validate(rows, SPEC, CANDIDATES[0], SETTINGS, HashOrder("transaction_id", 1), lessons=lessons)
    assert scores.count() == rows.count() and passes[0] == 3 and len(passes) <= 15
    passes.clear()
    assert len(training.regress_folds(lessons, CANDIDATES, HashOrder("transaction_id", 1))) == 4
    assert passes[0] == 12 and len(passes) <= 30


def test_step_keeps_the_l1_part_whole():
    """Each coordinate of the solution fulfils the optimality condition of the quadratic form with its penalty."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 4))
    hessian, gradient, beta = x.T @ x / 50, rng.normal(size=4), np.array([0.3, 0.0, -0.2, 0.1])
    r = logistic.Regression(0, {}, 0.4, 0.5)
    new = beta + logistic.newton_step(beta, gradient, hessian, r)
    slope = gradient + hessian @ (new - beta) + 0.2 * new * [1, 1, 1, 0]
    assert (new[:3] == 0).any()
    for j in range(3):
        assert slope[j] == pytest.approx(-0.2 * np.sign(new[j]), abs=1e-7) if new[j] else abs(slope[j]) <= 0.2 + 1e-7
    assert slope[3] == pytest.approx(0, abs=1e-7)
