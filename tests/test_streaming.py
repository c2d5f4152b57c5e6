import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import features
from ledgerlark.operators.history import add_behaviour
from ledgerlark.operators.normalise import normalise_messages
from ledgerlark.plans import training
from ledgerlark.plans.registry import _message_folder
from ledgerlark.operators.models import family
from ledgerlark.session import scratch_path
from ledgerlark.sources import messages
from ledgerlark.streaming import history as stream_history, scoring
from ledgerlark.streaming.history import COLUMNS, HistoryStream, LateRouter
from ledgerlark.views import txn

SF = "/root/testdata/sf0.001"
NOON = dt.datetime(2024, 3, 1, 12)


def drained(spark, df):
    path = scratch_path(spark, "out")
    scoring.run_once(df, path, scratch_path(spark, "checkpoint"))
    return spark.read.schema(df.schema).parquet(path)


def test_stream_and_batch_features_are_equal(spark):
    config = _message_folder(spark, SF)
    streamed = drained(spark, scoring.features(messages.stream_messages(spark, config)))
    batch = features.add_serving_features(normalise_messages(messages.read_messages(spark, config)))
    assert streamed.columns == batch.columns and streamed.count() == batch.count() > 900
    assert streamed.exceptAll(batch).count() == 0


def test_scored_topic_passes_the_acceptance_checks(spark):
    """Probabilities in [0, 1], predictions 0/1, and the ids of the input topic."""
    spec = family("decision_tree")
    rows = training.training_rows(txn(spark, SF)).select(*spec.numeric, *spec.categorical, "is_fraud")
    model = training.fit_model(rows, spec, spec.params, spec.settings, 1)
    source, sink = _message_folder(spark, SF), {"path": scratch_path(spark, "predictions")}
    scoring.start_scoring(spark, source, sink, model, scratch_path(spark, "checkpoint"), once=True).awaitTermination()
    out = messages.read_messages(spark, sink)
    parsed = out.select("key", F.from_json("value", "prediction int, fraud_probability double").alias("d")).select("key", "d.*")
    assert parsed.filter("prediction not in (0, 1) or fraud_probability not between 0 and 1").count() == 0
    wanted = messages.read_messages(spark, source).select("key")
    assert parsed.select("key").exceptAll(wanted).count() == 0 and parsed.count() == wanted.count()


def delivery(spark, folder, rows):
    (spark.createDataFrame(rows, "transaction_id string, card_number string, transaction_time timestamp, amount double")
     .coalesce(1).write.mode("append").parquet(folder))


def at(hours):
    return NOON + dt.timedelta(hours=hours)


@pytest.mark.parametrize("hot_rows", [10**9, 2])
def test_history_spans_deliveries_and_replays_change_nothing(spark, hot_rows):
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "checkpoint")
    stream = HistoryStream(scratch_path(spark, "store"), scratch_path(spark, "out"), hot_rows=hot_rows)
    deliveries = [[("a", "c1", at(0), 10.0), ("b", "c1", at(5), 30.0), ("x", "c2", at(1), None), ("n", None, at(1), 5.0)],
                  [("c", "c1", at(24), 20.0), ("d", "c1", at(200), 4.0), ("e", "c3", at(30), 7.0), ("t", "c2", None, 2.0)],
                  [("f", "c2", at(45 * 24), 8.0), ("g", "c1", at(45 * 24), None), ("h", "c1", at(46 * 24), 1.0)]]
    schema = "transaction_id string, card_number string, transaction_time timestamp, amount double"
    for rows in deliveries:
        delivery(spark, folder, rows)
        stream.start(spark.readStream.schema(schema).parquet(folder), checkpoint, once=True).awaitTermination()

    everything = spark.createDataFrame(sum(deliveries, []), schema)
    wanted = add_behaviour(everything, hot=[]).select("transaction_id", *COLUMNS).orderBy("transaction_id").collect()
    def got():
        return spark.read.parquet(stream.output).select("transaction_id", *COLUMNS).orderBy("transaction_id").collect()
    assert got() == wanted
    assert {r["transaction_id"]: r["user_activity_24h"] for r in wanted}["c"] == 2

    stream.process(spark.createDataFrame(deliveries[2], schema), 2)   # the same batch again
    assert got() == wanted


def test_snapshots_hold_what_the_additions_held(spark, monkeypatch):
    """Many small batches: old cards are still known, and a batch reads few of the store's files."""
    monkeypatch.setattr(stream_history, "SNAPSHOT_EVERY", 3)
    stream = HistoryStream(scratch_path(spark, "store"), scratch_path(spark, "out"))
    schema = "transaction_id string, card_number string, transaction_time timestamp, amount double"
    batches = [[(f"{n}-{i}", f"c{i}", at(24 * 20 * n + i), float(n + i)) for i in range(3) if (n + i) % 3] for n in range(6)] + [[]]
    batches += [[("last", f"c{i}", at(24 * 20 * 9), 5.0) for i in range(4)]]
    for n, rows in enumerate(batches):
        stream.process(spark.createDataFrame(rows, schema), n)
    got = sorted(map(tuple, spark.read.parquet(stream.output).select("transaction_id", *COLUMNS).collect()), key=repr)
    everything = spark.createDataFrame(sum(batches, []), schema)
    wanted = add_behaviour(everything, hot=[]).select("transaction_id", *COLUMNS).collect()
    assert got == sorted(map(tuple, wanted), key=repr)


def test_late_rows_are_set_apart(spark):
    schema = "transaction_id string, transaction_time timestamp"
    router = LateRouter(*[scratch_path(spark, n) for n in ("on-time", "late", "clock")])
    router.process(spark.createDataFrame([("a", at(0)), ("b", at(-100))], schema), 0)
    router.process(spark.createDataFrame([("c", at(-23)), ("d", at(-25)), ("e", at(50))], schema), 1)
    router.process(spark.createDataFrame([("f", at(20))], schema), 2)
    late = {r["transaction_id"] for r in spark.read.parquet(router.late).collect()}
    on_time = {r["transaction_id"] for r in spark.read.parquet(router.on_time).collect()}
    assert (late, on_time) == ({"d", "f"}, {"a", "b", "c", "e"})


def test_duplicates_are_dropped_across_batches(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    schema = "transaction_id string, card_number string, transaction_time timestamp, amount double"
    for rows in ([("a", "c", at(0), 1.0), ("a", "c", at(0), 1.0)], [("a", "c", at(0), 1.0), ("b", "c", at(1), 1.0)]):
        delivery(spark, folder, rows)
        stream = spark.readStream.schema(schema).parquet(folder).withWatermark("transaction_time", "24 hours")
        scoring.run_once(scoring.distinct_transactions(stream), out, checkpoint)
    assert sorted(r["transaction_id"] for r in spark.read.parquet(out).collect()) == ["a", "b"]
