import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import models, perceptron
from ledgerlark.plans import training
from ledgerlark.views import txn

SF = "/root/testdata/sf0.001"


def test_gradient_is_that_of_differences():
    rng = np.random.default_rng(1)
    x, y, layers = rng.normal(size=(30, 3)), rng.integers(0, 2, 30).astype(float), [3, 4, 3, 2]
    theta = perceptron.started(layers, 4)
    found = perceptron.sums(x, y, theta, layers)
    for n in range(0, len(theta), 5):
        step = np.zeros(len(theta))
        step[n] = 1e-6
        slope = (perceptron.sums(x, y, theta + step, layers)[1] - perceptron.sums(x, y, theta - step, layers)[1]) / 2e-6
        assert slope == pytest.approx(found[2 + n], abs=1e-5)
    assert found[0] == 30


def test_folds_are_trained_together_and_mllib_scores_alike(spark, monkeypatch):
    used = models.MultilayerPerceptronClassifier.fit
    monkeypatch.setattr(models.MultilayerPerceptronClassifier, "fit",
                        lambda self, df, *rest: used(self, df, *rest) if self.getMaxIter() == 0 else pytest.fail("a fold was fitted by a job of its own"))
    seen, made = [], training.train_perceptrons
    monkeypatch.setattr(training, "train_perceptrons", lambda *a: seen.append(made(*a)) or seen[-1])
    trained = training.train(txn(spark, SF), "mlp", {"hidden_layers": [6, 4], "max_iter": 25}, {"n_folds": 3})
    table, found = seen[0]
    assert len(seen) == 1 and len(found.thetas) == 4 and all(v[-1] < 0.6 * v[0] and v == sorted(v, reverse=True) for v in found.values)
    assert trained.fold_scores.agg(F.count("*"), F.count_distinct("transaction_id"), F.count_distinct("fold")).first()[:] == (1000, 1000, 3)
    # MLlib's model of all rows scores as the weights do
    whole = perceptron.Perceptrons([found.encoders[-1]] * 3, found.layers, [found.thetas[-1]] * 3, [])
    a = {r["transaction_id"]: r["score"] for r in whole.held_out(table, "transaction_id", 3).collect()}
    b = {r["transaction_id"]: r["fraud_probability"] for r in trained.model.score(training.training_rows(txn(spark, SF))).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9
