import json

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlark.operators import models, noise, preprocess, scoring
from ledgerlark.plans import search, training
from ledgerlark.session import materialise
from ledgerlark.sources.runs import append_run, read_runs
from ledgerlark.views import txn

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    spec = models.family("decision_tree")
    return materialise(training.training_rows(txn(spark, SF)).select(
        "transaction_id", *spec.numeric, *spec.categorical, "is_fraud"), "rows")


# --- preprocessing ---

def test_impute_scale_encode(spark):
    df = spark.createDataFrame([(1.0, "b", 5.0), (2.0, "a", 5.0), (None, "a", 5.0), (9.0, None, 5.0)],
                               "x double, k string, flat double")
    fitted = preprocess.fit(df, ["x", "flat"], ["k"])
    assert fitted.medians == {"x": 2.0, "flat": 5.0} and fitted.modes == {"k": "a"} and fitted.labels == {"k": ["a", "b"]}
    unseen = df.unionByName(spark.createDataFrame([(2.0, "z", 6.0)], df.schema))
    got = preprocess.transform(unseen, fitted).select(vector_to_array("features")).collect()
    filled = np.array([1.0, 2.0, 2.0, 9.0])
    scaled = (np.append(filled, 2.0) - filled.mean()) / filled.std()
    assert np.allclose([r[0][0] for r in got], scaled)
    assert [r[0][1] for r in got] == [0, 0, 0, 0, 1]          # a constant column scales by 1
    assert [r[0][2] for r in got] == [1, 0, 0, 0, -1]


def test_quotes_and_backslashes_survive(spark):
    df = spark.createDataFrame([("o'b\\x",), ("o'b\\x",), (None,), ("é",)], "k string")
    fitted = preprocess.fit(df, [], ["k"])
    assert [r[0] for r in preprocess.transform(df, fitted).select("k_code").collect()] == [0, 0, 0, 1]


def test_large_vocabularies_get_the_same_codes(spark):
    df = spark.range(3000).select(F.concat(F.lit("v"), F.col("id") % 700).alias("k"), F.lit("one").alias("j"))
    inside, joined = (preprocess.fit(df, [], ["k", "j"], max_labels=m) for m in (10**6, 100))
    assert joined.joined == ["k"] and inside.joined == []
    a, b = (preprocess.transform(df, f).select("k", vector_to_array("features").alias("f")).distinct().collect() for f in (inside, joined))
    assert sorted(map(tuple, ((r["k"], tuple(r["f"])) for r in a))) == sorted(((r["k"], tuple(r["f"])) for r in b))


def test_unseen_values_are_minus_one_in_every_column(spark):
    df = spark.createDataFrame([("a", "x", "p"), ("b", "y", "p"), ("c", "y", "p"), ("c", "z", "p"), ("c", "v", "p")], "k string, j string, i string")
    fitted = preprocess.fit(df, [], ["k", "j", "i"])
    new = spark.createDataFrame([("a", "new", "new"), ("new", "z", "p"), ("new", "new", None)], df.schema)
    got = preprocess.transform(new, fitted).select(vector_to_array("features")).collect()
    assert [r[0] for r in got] == [[0, -1, -1], [-1, 3, 0], [-1, -1, 0]]


def test_missing_feature_is_an_error(rows):
    fitted = preprocess.fit(rows, ["amount"], ["category"])
    with pytest.raises(ValueError, match="category"):
        preprocess.transform(rows.drop("category"), fitted)


# --- noise ---

def test_noise_is_a_function_of_the_row(spark):
    df = spark.range(4000).select("id", (F.col("id") % 50).cast("double").alias("x"), F.lit(3.0).alias("flat"))
    once, again = (noise.add_sample_noise(d, ["x", "flat"], 0.05, "id", 9) for d in (df, df.repartition(7)))
    a, b = (d.orderBy("id").toPandas() for d in (once, again))
    assert np.allclose(a.x, b.x) and (a.flat == 3.0).all()
    drawn = a.x - df.orderBy("id").toPandas().x
    assert drawn.std() == pytest.approx(0.05 * np.std(np.arange(4000) % 50, ddof=1), rel=0.05)
    assert abs(drawn.mean()) < 0.05
    other = noise.add_fold_noise(df, ["x", "flat"], 0.05, "id", 10).orderBy("id").toPandas()
    assert not np.allclose(other.x, a.x) and 0 < (other.flat - 3.0).abs().max() < 1e-7


# --- families ---

def test_logistic_penalty_matches_the_sum_form(spark):
    """min C * sum(w * loss) + |b|^2 / 2, solved by Newton steps."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2))
    y = (x @ [1.5, -1.0] + rng.normal(size=300) > 0.8).astype(int)
    weight = np.where(y == 1, 3.0, 1.0)
    c, beta, design = 0.1, np.zeros(3), np.column_stack([np.ones(300), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = c * design.T @ (weight * (p - y)) + np.r_[0, beta[1:]]
        hessian = c * (design.T * (weight * p * (1 - p))) @ design + np.diag([0, 1, 1])
        beta -= np.linalg.solve(hessian, gradient)
    df = spark.createDataFrame([(*map(float, r), int(t), float(w)) for r, t, w in zip(x, y, weight)],
                               "a double, b double, is_fraud int, class_weight double")
    from pyspark.ml.feature import VectorAssembler
    ready = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    estimator = models.family("logistic").build({"C": c, "max_iter": 500, "penalty": "l2"}, 1, {"weight_sum": float(weight.sum())})
    model = estimator.fit(ready)
    assert np.allclose([model.intercept, *model.coefficients], beta, atol=1e-3)


def test_grids_and_layers():
    assert models.layered({"a": 1, "b": 2}, None, {"b": 3}) == {"a": 1, "b": 3}
    space = {"a": [1, 2], "b": [3, 4]}
    assert models.grid(space, 2, "first") == [{"a": 1, "b": 3}, {"a": 1, "b": 4}]
    assert models.grid(space, 3, seed=1) == models.grid(space, 3, seed=1) and len(models.grid(space)) == 4
    assert len(search.candidates_for("logistic")) == 6 and len(search.candidates_for("xgboost", 10)) == 10
    with pytest.raises(ValueError):
        models.family("nothing")


def test_patience_keeps_the_best_round():
    assert models.best_round([5, 4, 3, 2, 1], 2) == 5
    assert models.best_round([5, 4, 3, 4, 4, 1], 2) == 3      # the last round is beyond the patience
    assert models.best_round([5, 4, 3, 4, 4, 1], 4) == 6
    assert models.best_round([1, 2, 3], 25) == 1


def test_grids_have_all_axes():
    assert len(models.grid(models.BOOSTING_GRID)) == 256 and len(models.grid(models.BEHAVIOUR_GRID)) == 64
    assert {c["min_gain"] for c in search.candidates_for("xgboost")} == {0.0, 0.5}


def test_minimum_gain_prunes(spark):
    rows = training.training_rows(txn(spark, SF))
    spec = models.family("xgboost")
    sizes = []
    for gain in (0.0, 1e9):
        model = training.fit_model(rows, spec, {**spec.params, "iterations": 2, "min_gain": gain}, {}, 1)
        sizes.append(sum(t.numNodes for t in model.pipeline.stages[-1].trees))
    assert sizes[0] > sizes[1] == 2


def test_feature_choice(spark):
    table = spark.createDataFrame([("a", 0.6), ("b", 0.39), ("c", 0.01), ("d", 0.0)], "feature string, importance double").orderBy(F.desc("importance"))
    assert models.pick_features(table, 0.01, 10) == ["a", "b", "c"]
    assert models.pick_features(table, 0.01, 2) == ["a", "b"]
    assert models.pick_features(table, 0, 3) == ["a", "b", "c"]


# --- jobs ---

def test_training_job_records_and_reloads(spark, tmp_path):
    trained = training.train(txn(spark, SF), "decision_tree", settings={"n_folds": 2, "test_size": 0.2})
    assert {"cv_roc_auc_mean", "cv_f1_std", "test_f1", "decision_threshold"} <= set(trained.metrics)
    assert all(0 <= trained.metrics[f"cv_{m}_mean"] <= 1 for m in ("avg_precision", "roc_auc", "precision", "recall", "f1"))

    path = str(tmp_path / "runs")
    append_run(spark, path, "tree", trained.params, trained.metrics, trained.fold_metrics)
    runs = read_runs(spark, path)
    assert runs.filter("kind = 'param' and key = 'max_depth'").first()["value"] == "10"
    assert runs.filter("fold is not null").select("fold").distinct().count() == 2

    trained.model.save(str(tmp_path / "model"))
    loaded = scoring.ScoringModel.load(spark, str(tmp_path / "model"))
    batch = training.training_rows(txn(spark, SF))
    a, b = (m.score(batch).select("record_id", "prediction", "fraud_probability").orderBy("record_id").collect()
            for m in (trained.model, loaded))
    assert a == b and len(a) == 1000
    assert all(r["prediction"] == int(r["fraud_probability"] >= loaded.threshold) and 0 <= r["fraud_probability"] <= 1 for r in a)


def test_tuned_family_selects_stops_early_and_keeps_recall(spark):
    trained = training.train(txn(spark, SF), "xgboost", {"iterations": 5}, {"n_folds": 2})
    assert 1 <= len(trained.features) <= 10
    assert trained.metrics["decision_threshold"] == trained.metrics["cv_decision_threshold_mean"]
    assert trained.metrics["cv_threshold_recall_at_target_mean"] >= 0.9
    assert "cv_best_iteration_mean" in trained.metrics
    total = trained.importances.agg(F.sum("importance")).first()[0]
    assert total == pytest.approx(1.0)


def test_search_ranks_candidates(spark):
    found = search.search(txn(spark, SF), "decision_tree", [{"max_depth": 1}, {"max_depth": 6}], settings={"n_folds": 2})
    rows = {r["candidate"]: r for r in found.collect()}
    better = max(rows.values(), key=lambda r: r["avg_precision_mean"])
    assert search.best(found) == json.loads(better["params"]) == {"max_depth": 6}


def half():
    class Half:
        def predict_proba(self, frame):
            assert list(frame.columns) == ["merchant", "amount"]
            p = np.minimum(frame["amount"].to_numpy() / 100, 1.0)
            return np.column_stack([1 - p, p])

    return Half()


def test_foreign_model_gets_its_columns_in_order(spark):
    apply = scoring.foreign_scorer(spark, half(), ["merchant", "amount"], threshold=0.5)
    df = spark.createDataFrame([(10.0, "m"), (50.0, "n")], "amount double, merchant string")
    assert [(r["prediction"], r["fraud_probability"]) for r in apply(df).collect()] == [(0, 0.1), (1, 0.5)]
    with pytest.raises(ValueError, match="merchant"):
        apply(df.drop("merchant"))


def test_a_model_too_large_to_broadcast_is_refused(spark):
    with pytest.raises(ValueError, match="bytes"):
        scoring.foreign_scorer(spark, {"weights": b"x" * 5000}, ["amount"], max_bytes=4000)
