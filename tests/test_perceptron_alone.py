import numpy as np
import pytest

from ledgerlark.operators import models, perceptron, preprocess
from ledgerlark.operators.sampling import HashOrder
from ledgerlark.plans import training
from ledgerlark.views import txn

SF = "/root/testdata/sf0.001"


def test_sums_of_fewer_bits_are_those_of_more():
    rng = np.random.default_rng(1)
    x, y, layers = rng.normal(size=(1_300, 5)), rng.integers(0, 2, 1_300).astype(float), [5, 12, 7, 2]
    theta = perceptron.started(layers, 4)
    want, got = perceptron.sums(x, y, theta, layers), perceptron.sums(x.astype(np.float32), y, theta.astype(np.float32), layers)
    assert got.dtype == np.float64 and np.abs(got - want).max() < 1e-5 * np.abs(want).max()


def test_a_task_trains_a_model_as_the_passes_do(spark, monkeypatch):
    spec, order = models.family("mlp"), HashOrder("transaction_id", 7)
    rows = training.prepare(training.training_rows(txn(spark, SF)), spec, {"n_folds": 3}, order)
    fits, params = [preprocess.fit(rows.filter(f"fold <> {m}"), spec.numeric, spec.categorical) for m in range(4)], {"hidden_layers": [6, 4], "max_iter": 12, "tol": 1e-6}
    passes, own = [], perceptron._trained_by_passes
    monkeypatch.setattr(perceptron, "_trained_by_passes", lambda *a: passes.append(1) or own(*a))
    _, alone = training.train_perceptrons(rows, 1_000, spec, params, fits, order, 5)
    assert not passes
    monkeypatch.setattr(perceptron, "ALONE", 0)
    _, together = training.train_perceptrons(rows, 1_000, spec, params, fits, order, 5)
    assert passes
    for a, b in zip(alone.values, together.values):
        assert len(a) > 5 and a == sorted(a, reverse=True) and a[:5] == pytest.approx(b[:5], rel=1e-4)
