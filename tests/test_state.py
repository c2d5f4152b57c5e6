import datetime as dt
import random

import pytest

from ledgerlark.operators.history import Entity, add_behaviour
from ledgerlark.session import scratch_path
from ledgerlark.streaming import scoring
from ledgerlark.streaming.state import COLUMNS, keyed_history

START = dt.datetime(2024, 3, 4)
SCHEMA = "transaction_id string, card_number string, transaction_time timestamp, amount double"


def deliver(spark, parts, **options):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("deliveries", "keyed", "checkpoint"))
    for rows in parts:                                        # each delivery is a new start from the checkpoint
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(SCHEMA).parquet(folder)
        scoring.run_once(keyed_history(source, **options), out, checkpoint)
    return {r["transaction_id"]: r for r in spark.read.parquet(out).collect()}


def day(x):
    return START + dt.timedelta(days=x)


@pytest.mark.parametrize("slice_days", [1, 7])
def test_equals_the_batch_features(spark, slice_days):
    rng = random.Random(slice_days)
    times = sorted(rng.choice([rng.uniform(0, 20), round(rng.uniform(0, 20)), round(rng.uniform(0, 20)) + 1e-6]) for _ in range(240))
    rows = [(f"t{n:04}", rng.choice(["hot", "hot", "a", "b"]), day(t), rng.choice([None, round(rng.uniform(1, 99), 2)])) for n, t in enumerate(times)]
    rows += [("n1", None, day(3), 5.0), ("n2", "a", None, 5.0)]
    cuts = [[r for r in rows if r[2] is not None and lo <= r[2] < hi] for lo, hi in ((day(-1), day(6)), (day(6), day(13)), (day(13), day(30)))]
    cuts[0].append(rows[-1])
    found = deliver(spark, cuts, slice_days=slice_days)
    batch = add_behaviour(spark.createDataFrame(rows, SCHEMA), Entity()).collect()
    assert len(found) == len(rows)
    for r in batch:
        got = found[r["transaction_id"]]
        assert got["user_activity_24h"] == (r["user_activity_24h"] or 0)
        for c in ("rolling_avg_7d", "time_since_last_txn"):
            if c == "time_since_last_txn" and r[c] is not None and got[c] is None:
                assert r[c] > 7 * 86400                       # older than what the state reaches
            else:
                assert got[c] == (None if r[c] is None else pytest.approx(r[c], abs=1e-9))


def test_late_rows_count_and_state_ends(spark):
    first = [("a1", "a", day(1.5), 10.0), ("a2", "a", day(2.0), 20.0)]
    second = [("a0", "a", day(1.25), 5.0), ("a3", "a", day(2.1), 1.0)]        # a0 is late, within the watermark
    third = [("b1", "b", day(40), 1.0)]                                       # moves the watermark far ahead
    fourth = [("a4", "a", day(3), 1.0), ("a5", "a", day(41), 1.0)]            # a4 is behind it
    found = deliver(spark, [first, second, third, fourth])
    assert found["a0"]["txn_count_7d"] == 0 and found["a0"]["time_since_last_txn"] is None
    assert found["a3"]["txn_count_7d"] == 3 and found["a3"]["amount_sum_7d"] == 35.0
    assert "a4" not in found and found["a5"]["txn_count_7d"] == 0
    assert set(COLUMNS) < set(found["a1"].asDict())


def test_slices_divide_the_week(spark):
    with pytest.raises(ValueError):
        keyed_history(spark.createDataFrame([], SCHEMA), slice_days=2)


def test_needs_no_state_store_in_the_session(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    given = spark.conf.get(key)
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(key, plain)
    try:
        found = deliver(spark, [[("a1", "a", day(1), 10.0)], [("a2", "a", day(1.5), 20.0)]])
        assert spark.conf.get(key) == plain
    finally:
        spark.conf.set(key, given)
    assert found["a2"]["txn_count_7d"] == 1 and found["a2"]["amount_sum_7d"] == 10.0


def test_equal_times_come_in_the_order_of_the_transaction_id(spark, monkeypatch):
    from ledgerlark.plans import registry
    rows = spark.createDataFrame([(n, f"t{n}", "a", day(1), 1.0) for n in (8, 10)], "record_id long, " + SCHEMA)
    monkeypatch.setattr(registry, "_history_rows", lambda *args: rows)
    found = {r["record_id"]: r["time_since_last_txn"] for r in registry.keyed_state_history(spark, "").collect()}
    assert found == {8: 0.0, 10: None}
