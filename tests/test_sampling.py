import math

import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import sampling
from ledgerlark.operators.sampling import HashOrder

ORDER = HashOrder("id", 7)


@pytest.fixture(scope="module")
def rows(spark):
    """1000 rows, 87 positives; times with many ties."""
    return spark.range(1000).select("id", (F.col("id") < 87).cast("int").alias("is_fraud"),
                                    F.timestamp_seconds(F.col("id") % 100).alias("transaction_time")).repartition(5)


def counts(df, *by):
    return {tuple(r[b] for b in by): r["count"] for r in df.groupBy(*by).count().collect()}


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_folds_partition_the_rows_evenly_per_label(rows):
    folds = counts(sampling.mark_folds(rows, 10, order=ORDER), "is_fraud", "fold")
    assert len(folds) == 20 and sum(folds.values()) == 1000
    for label, total in ((0, 913), (1, 87)):
        sizes = [folds[label, f] for f in range(10)]
        assert sum(sizes) == total and max(sizes) - min(sizes) <= 1


def test_split_is_exact_stratified_and_repeatable(rows):
    train, test = sampling.stratified_split(rows, 0.2, order=ORDER)
    assert test.count() == math.ceil(200) and counts(test, "is_fraud") == {(0,): 183, (1,): 17}
    again = sampling.stratified_split(rows.repartition(11), 0.2, order=ORDER)[1]
    other = sampling.stratified_split(rows, 0.2, order=HashOrder("id", 8))[1]
    assert ids(test) == ids(again) != ids(other)
    assert sorted(ids(train) + ids(test)) == list(range(1000))


@pytest.mark.parametrize("n, size", [(0, 0), (1, 1), (250, 250), (1000, 1000), (5000, 1000)])
def test_sample_size(rows, n, size):
    got = ids(sampling.take(rows, n, ORDER))
    assert len(got) == len(set(got)) == size


@pytest.mark.parametrize("bits", [1, 4, 14])
def test_cut_offs_do_not_depend_on_the_bins(rows, bits):
    def wanted(sizes):
        return {0: [5, 500], 1: [1, 87, 88]}

    assert sampling.cut_offs(rows, ORDER, "is_fraud", wanted, bits) == sampling.cut_offs(rows, ORDER, "is_fraud", wanted, 8)


@pytest.mark.parametrize("ratio, negatives", [(0.4, 365), (0.01, 87), (1.0, 913), (0.0, 913), (1.5, 913)])
def test_downsampling_follows_the_formula(rows, ratio, negatives):
    assert counts(sampling.downsample_negatives(rows, ratio, order=ORDER), "is_fraud") == {(0,): negatives, (1,): 87}


def test_downsampling_without_negatives_changes_nothing(rows):
    positives = rows.filter("is_fraud = 1")
    assert sampling.downsample_negatives(positives, 0.4, order=ORDER).count() == 87


@pytest.mark.parametrize("n", [1, 10, 25, 999, 1000, 2000])
def test_most_recent_rows_with_ties(rows, n):
    got = sampling.most_recent(rows, n, order=ORDER, small=20).collect()
    assert len(got) == min(n, 1000)
    seconds = sorted((int(r["transaction_time"].timestamp()) for r in got), reverse=True)
    assert seconds == sorted([i % 100 for i in range(1000)], reverse=True)[:n]


def test_class_weights():
    assert sampling.class_weights("scale_pos", 90, 10, 10) == {0: 1.0, 1: 10.0}
    assert sampling.class_weights("scale_pos", 990, 10, 10) == {0: 1.0, 1: 99.0}
    assert sampling.class_weights("ratio_floor", 5, 10) == {0: 1.0, 1: 1.0}
    assert sampling.class_weights("ratio", 5, 10) == {0: 1.0, 1: 0.5}
    assert sampling.class_weights("balanced", 75, 25) == {0: 100 / 150, 1: 2.0}
    assert sampling.class_weights("ratio", 5, 0) == {0: 1.0, 1: 1.0}


def test_allocation_sums_up():
    assert sampling.allocate({0: 7, 1: 2}, 5) == {0: 4, 1: 1}
    assert sampling.allocate({0: 10}, 3) == {0: 3}


# --- missing, repeated and absent ids -------------------------------------------------------

@pytest.fixture(scope="module", params=["none", "half missing", "all missing", "few ids", "equal rows", "no column"])
def untidy(request, spark):
    """2000 rows, 300 positives, whose ids do not tell them apart."""
    ids = {"none": F.col("n"), "half missing": F.when(F.col("n") % 2 == 0, F.col("n")), "all missing": F.lit(None).cast("long"),
           "few ids": F.col("n") % 4, "equal rows": F.lit(7).cast("long"), "no column": F.col("n")}[request.param]
    df = spark.range(2000).withColumnRenamed("id", "n").select(ids.alias("id"), (F.col("n") < 300).cast("int").alias("is_fraud"), "n")
    if request.param == "equal rows":
        df = df.withColumn("n", F.lit(1).cast("long"))
    return df.drop("id") if request.param == "no column" else df


@pytest.mark.parametrize("n", [1, 700, 1500, 1999])
def test_samples_of_untidy_ids_have_their_size(untidy, n):
    got = sampling.take(untidy.repartition(3), n, ORDER)
    assert got.count() == n and got.columns == untidy.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, sampling.take(untidy, n, ORDER).collect()), key=repr)


@pytest.mark.parametrize("fraction", [0.2, 0.5])
def test_splits_of_untidy_ids_are_exact(untidy, fraction):
    assert counts(sampling.mark_split(untidy, fraction, order=ORDER), "is_fraud", "is_test") == {
        (0, True): 1700 * fraction, (0, False): 1700 * (1 - fraction), (1, True): 300 * fraction, (1, False): 300 * (1 - fraction)}


def test_folds_of_untidy_ids_are_even_and_lose_nothing(untidy):
    folds = sampling.mark_folds(untidy, 10, order=ORDER)
    assert counts(folds, "is_fraud", "fold") == {(y, f): (30 if y else 170) for y in (0, 1) for f in range(10)}
    assert sorted(map(tuple, folds.drop("fold").collect()), key=repr) == sorted(map(tuple, untidy.collect()), key=repr)


def test_downsampling_of_untidy_ids(untidy):
    assert counts(sampling.downsample_negatives(untidy, 0.5, order=ORDER), "is_fraud") == {(0,): 850, (1,): 300}


def test_missing_labels_are_a_stratum(rows):
    some = rows.withColumn("is_fraud", F.when(F.col("id") >= 200, F.col("is_fraud")).otherwise(None))
    folds = counts(sampling.mark_folds(some, 4, order=ORDER), "is_fraud", "fold")
    assert [folds[None, f] for f in range(4)] == [50] * 4 and sum(folds.values()) == 1000
    assert counts(sampling.mark_split(some, 0.25, order=ORDER).filter("is_fraud IS NULL"), "is_test") == {(True,): 50, (False,): 150}


def test_narrowing_finds_the_same_rows(untidy):
    def wanted(sizes):
        return {0: [5, 500, 1700], 1: [1, 300, 301]}

    far = sampling.cut_offs(untidy, ORDER, "is_fraud", wanted, fetch=1)
    assert far == sampling.cut_offs(untidy, ORDER, "is_fraud", wanted) and len(far) == 5
