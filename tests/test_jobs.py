import pytest
from pyspark.sql import functions as F

from ledgerlark.plans import jobs
from ledgerlark.plans.registry import _message_folder, _raw_rows
from ledgerlark.session import scratch_path
from ledgerlark.sources import files, messages
from ledgerlark.sources.runs import read_runs

SF = "/root/testdata/sf0.001"


def test_configuration_names():
    config = {"models": {"xgboost": {"n_folds": 10, "threshold_recall_target": 0.9, "early_stopping_rounds": 0,
                                     "params": {"n_estimators": 50, "colsample_bytree": 0.6, "tree_method": "hist", "gamma": 1.0}}},
              "high_risk_merchants": ["QuickCash"]}
    assert jobs.configured_params(config, "xgboost") == {"iterations": 50, "column_share": 0.6, "min_gain": 1.0}
    assert jobs.configured_settings(config, "xgboost") == {"n_folds": 10, "recall_target": 0.9, "patience": 0,
                                                           "high_risk_merchants": ["QuickCash"]}
    with pytest.raises(ValueError, match="models.logistic"):
        jobs.model_section(config, "logistic")


def test_yaml(tmp_path):
    path = tmp_path / "config.yaml"
    path.write_text("kafka:\n  topic: t\nmodels:\n  mlp:\n    params:\n      hidden_layer_sizes: [4, 2]\n")
    assert jobs.configured_params(jobs.load_config(str(path)), "mlp") == {"hidden_layers": [4, 2]}


def test_ingest_falls_back_to_the_csv_and_keeps_the_latest(spark):
    csv = scratch_path(spark, "csv")
    files.write_csv(_raw_rows(spark, SF).drop("idx"), csv)
    config = {"kafka": {"path": scratch_path(spark, "nothing")}, "data": {"training_csv": csv}}
    everything = jobs.ingest(spark, config)
    latest = jobs.ingest(spark, config, 100)
    assert everything.count() > 900 and latest.count() == 100
    edge = latest.agg(F.min("transaction_time")).first()[0]
    assert everything.filter(F.col("transaction_time") > edge).count() < 100


def test_train_then_score(spark, tmp_path):
    topic = _message_folder(spark, SF)
    config = {"kafka": topic, "models": {"decision_tree": {
        "path": str(tmp_path / "model"), "n_folds": 2, "prediction_threshold": 0.25, "params": {"max_depth": 4}}}}
    trained = jobs.run_training(spark, config, "decision_tree", str(tmp_path / "runs"), {"max_depth": 3})
    assert trained.params["max_depth"] == 3
    assert read_runs(spark, str(tmp_path / "runs")).filter("key = 'cv_f1_mean'").count() == 1
    sink = {"path": str(tmp_path / "out")}
    jobs.run_scoring(spark, config, str(tmp_path / "checkpoint"), "decision_tree", sink, once=True).awaitTermination()
    scored = messages.read_messages(spark, sink).select(
        F.from_json("value", "prediction int, fraud_probability double").alias("d")).select("d.*")
    assert scored.count() == 1000
    assert scored.filter("prediction <> cast(fraud_probability >= 0.25 as int)").count() == 0


def test_search_job_records_every_candidate_and_the_best(spark, tmp_path):
    config = {"kafka": _message_folder(spark, SF), "models": {"logistic": {"n_folds": 2}}}
    found = jobs.run_search(spark, config, "logistic", str(tmp_path / "runs"), limit=2)
    runs = read_runs(spark, str(tmp_path / "runs"))
    means = {r["run_name"]: float(r["value"]) for r in runs.filter("key = 'avg_precision_mean'").collect()}
    assert set(means) == {"logistic-candidate-01", "logistic-candidate-02"}
    top = float(runs.filter("key = 'best_avg_precision'").first()["value"])
    assert top == max(means.values()) and runs.filter("key = 'best_C'").first()["value"] == str(found["C"])


def test_configured_merchants_reach_training_and_scoring(spark):
    from ledgerlark.operators.models import family
    from ledgerlark.plans import training
    from ledgerlark.views import txn
    rows = txn(spark, SF)
    one = rows.filter("merchant IS NOT NULL").first()["merchant"]
    table = training.rows_for(rows, family("behaviour"), {"high_risk_merchants": [one]})
    assert table.filter("merchant_risk = 1").count() == rows.filter(F.col("merchant") == one).count() > 0
