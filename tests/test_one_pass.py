import random

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators.sampling import HashOrder, SampleStream, take, take_once
from ledgerlark.session import scratch_path

SCHEMA = "transaction_id string, amount double, note string"


def rows(n, seed=1):
    rng = random.Random(seed)
    out = [(None if rng.random() < .05 else f"t{rng.randrange(n)}", rng.choice([None, float(rng.randrange(5))]), rng.choice(["x", None])) for _ in range(n)]
    return out + out[:n // 5]                                  # repeated ids and whole rows


def bag(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("n", [0, 1, 7, 150, 600, 10_000])
@pytest.mark.parametrize("order", [HashOrder(), HashOrder(seed=3, method="md5"), HashOrder("absent")])
def test_equals_the_sample_of_many_passes(spark, n, order):
    df = spark.createDataFrame(rows(500), SCHEMA).repartition(7)
    assert bag(take_once(df, n, order)) == bag(take(df, n, order))


def test_the_source_is_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.createDataFrame(rows(3000), SCHEMA).repartition(5)
    assert len(take_once(source.mapInArrow(counted, SCHEMA), 100).collect()) == 100
    assert seen.value == 3600


def test_a_stream_has_the_sample_of_all_its_rows(spark):
    folder, checkpoint = scratch_path(spark, "rows"), scratch_path(spark, "checkpoint")
    stream, everything = SampleStream(scratch_path(spark, "samples"), 60), []
    for seed in range(3):
        everything += rows(100, seed)
        spark.createDataFrame(rows(100, seed), SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream.start(spark.readStream.schema(SCHEMA).parquet(folder), checkpoint, once=True).awaitTermination()
        got = spark.read.schema(SCHEMA).parquet(f"{stream.path}/{seed}")
        assert bag(got) == bag(take(spark.createDataFrame(everything, SCHEMA), 60))


def test_empty(spark):
    assert take_once(spark.createDataFrame([], SCHEMA), 5).collect() == []
    assert take_once(spark.createDataFrame(rows(5), SCHEMA).filter(F.lit(False)), 5).columns == ["transaction_id", "amount", "note"]
