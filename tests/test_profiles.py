import pytest
from pyspark.sql import functions as F

from ledgerlark.session import scratch_path
from ledgerlark.streaming.profiles import ProfileJoin, ProfileStore

ROWS, PROFILE = "id long, card_number string", "card_number string, txn_count long"


def joined(spark, join):
    return {(r["id"], r["card_number"]): (r["txn_count"], r["version"]) for r in spark.read.parquet(join.output).collect()}


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def join(spark):
    return ProfileJoin(ProfileStore(scratch_path(spark, "profiles")), scratch_path(spark, "joined"), scratch_path(spark, "used"), PROFILE)


def test_a_running_stream_sees_the_next_snapshot(spark, join):
    folder = scratch_path(spark, "rows")
    deliver(spark, folder, [(1, "a"), (2, None)])
    query = join.start(spark.readStream.schema(ROWS).parquet(folder), scratch_path(spark, "checkpoint"))
    try:
        query.processAllAvailable()
        assert joined(spark, join) == {(1, "a"): (None, -1), (2, None): (None, -1)}
        for version, count in ((0, 5), (1, 9)):
            assert join.store.publish(spark.createDataFrame([("a", count)], PROFILE)) == version
            deliver(spark, folder, [(10 + version, "a"), (20 + version, "b")])
            query.processAllAvailable()
    finally:
        query.stop()
    found = joined(spark, join)
    assert found[10, "a"] == (5, 0) and found[11, "a"] == (9, 1)
    assert found[20, "b"] == (None, 0) and found[21, "b"] == (None, 1) and len(found) == 6


def test_a_replayed_batch_joins_what_it_joined_before(spark, join):
    join.store.publish(spark.createDataFrame([("a", 1)], PROFILE))
    batch = spark.createDataFrame([(1, "a")], ROWS)
    join.process(batch, 0)
    join.store.publish(spark.createDataFrame([("a", 2)], PROFILE))
    join.process(batch, 0)
    assert joined(spark, join) == {(1, "a"): (1, 0)}
    join.process(batch.withColumn("id", F.lit(2).cast("long")), 1)
    assert joined(spark, join) == {(1, "a"): (1, 0), (2, "a"): (2, 1)}


def test_a_snapshot_without_pointer_is_not_seen(spark, join):
    join.store.publish(spark.createDataFrame([("a", 1)], PROFILE))
    spark.createDataFrame([("a", 7)], PROFILE).write.parquet(f"{join.store.path}/snapshots/1")
    assert join.store.newest(spark) == 0
    assert join.store.publish(spark.createDataFrame([("a", 8)], PROFILE)) == 1
    assert [r["txn_count"] for r in join.store.snapshot(spark, 1).collect()] == [8]
