import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlark.functions.scalar import as_double, event_time, to_double, to_event_timestamp, to_long
from ledgerlark.operators import clean, features, normalise, profile
from ledgerlark.operators.bounded import join_small
from ledgerlark.schema import REQUIRED_COLUMNS


def column(spark, values, expression, dtype="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {dtype}").select(expression(F.col("x"))).collect()]


def test_lenient_numbers(spark):
    texts = ["1.5", "", None, "n/a", "NaN", "-3", "1d", "2.f", "0x1p3", "1e3", " 7 ", "inf"]
    assert column(spark, texts, to_double) == [1.5, None, None, None, None, -3.0, None, None, None, 1000.0, 7.0, None]
    assert column(spark, ["-1.9", "1.9", "", "x", "inf", "1e30"], to_long) == [-1, 1, None, None, None, None]


def test_lenient_times(spark):
    got = column(spark, ["2024-01-02 03:04:05", "not a date", "", None, "2024-01-02T03:04:05Z"], to_event_timestamp)
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), None, None, None, dt.datetime(2024, 1, 2, 3, 4, 5)]
    df = spark.createDataFrame([("bad", 60.9), ("2024-01-01", 60.0), (None, None)], "t string, u double")
    assert [r[0] for r in df.select(event_time(F.col("t"), F.col("u"))).collect()] == [
        dt.datetime(1970, 1, 1, 0, 1), dt.datetime(2024, 1, 1), None]


RAW = {"trans_date_trans_time": "2024-01-01 23:00:00", "amt": "10.5", "merchant": "m", "category": "c", "city": "x",
       "state": "NY", "zip": "1", "lat": "1", "long": "2", "city_pop": "0", "merch_lat": "4", "merch_long": "6",
       "is_fraud": "1", "cc_num": "9", "trans_num": "a"}


def raw(spark, *changes):
    rows = [tuple({**RAW, **c}.values()) for c in (changes or ({},))]
    return spark.createDataFrame(rows, ", ".join(f"{k} string" for k in RAW))


def test_normalise_aliases_coerces_and_drops(spark):
    got = normalise.normalise(raw(spark, {}, {"amt": "x"}, {"trans_date_trans_time": "x"}, {"is_fraud": None}, {"lat": "?"}))
    rows = got.select("transaction_id", "card_number", "amount", "merchant_lat", "lat", "is_fraud", "amt").collect()
    assert [tuple(r) for r in rows] == [("a", "9", 10.5, 4.0, 1.0, 1, "10.5"), ("a", "9", 10.5, 4.0, None, 1, "10.5")]


def test_first_alias_wins_and_targets_are_kept(spark):
    df = spark.createDataFrame([("t1", "t2", 5.0, "7")], "transacted_at string, trans_date_trans_time string, amount double, amt string")
    row = normalise.apply_aliases(df).first()
    assert (row["transaction_time"], row["amount"]) == ("t1", 5.0)


@pytest.mark.parametrize("gone", ["merchant", "is_fraud"])
def test_missing_required_column_is_an_error(spark, gone):
    with pytest.raises(ValueError, match=gone):
        normalise.normalise(raw(spark).drop(gone))
    assert len(REQUIRED_COLUMNS) == 13


def test_gender_is_optional_and_features_follow(spark):
    row = features.add_training_features(normalise.normalise(raw(spark))).first()
    assert row["gender"] == "unknown" and row["merchant_distance"] == 5.0
    assert (row["transaction_hour"], row["transaction_dayofweek"], row["transaction_month"]) == (23, 0, 1)


def test_null_policies(spark):
    df = spark.createDataFrame([(None, 1.0, 3.0, 4.0, -5.0, None)],
                               "lat double, long double, merchant_lat double, merchant_long double, amount double, city_pop double")
    kept, zero = features.add_magnitudes(df).first(), features.add_magnitudes(df, "zero").first()
    assert (kept["merchant_distance"], kept["city_pop_log"], kept["amount_log"]) == (None, None, 0.0)
    assert (zero["merchant_distance"], zero["city_pop_log"]) == (pytest.approx(18 ** 0.5), 0.0)


def test_payload_survives_a_bad_field(spark):
    df = spark.createDataFrame([('{"record_id": 4, "amount": "oops", "merchant": "m", "unix_time": 60}',), ("not json",)], "value string")
    got = normalise.normalise_messages(df).select("record_id", "amount", "merchant", "gender", "transaction_time").collect()
    assert tuple(got[0]) == (4, None, "m", "unknown", dt.datetime(1970, 1, 1, 0, 1))
    assert tuple(got[1])[:2] == (None, None)


def test_keep_first_holds_for_a_hot_key_and_missing_keys(spark):
    df = (spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
                                   .otherwise(F.col("id").cast("string")).alias("trans_num"),
                                   (3000 - F.col("id")).alias("record_id"), F.col("id").alias("payload")).repartition(7))
    got = clean.drop_duplicates_keep_first(df)
    assert got.columns == df.columns
    assert got.filter("trans_num = 'hot'").first()["payload"] == 2997
    assert got.filter("trans_num is null").first()["payload"] == 2996
    assert got.count() == 3000 - clean.duplicate_count(df).first()[0]


def test_standard_values(spark):
    df = spark.createDataFrame([(" female ", " Home ", "ny"), ("male", "X", "xyz"), (None, None, None), (" f", "a", " ca ")],
                               "gender string, category string, state string")
    assert [tuple(r) for r in clean.standardise(df).collect()] == [
        ("F", "home", "NY"), ("M", "x", "UNK"), (None, None, "UNK"), ("F", "a", "CA")]


def test_rare_values_collapse_and_null_stays(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4 + [(None,)], "merchant string")
    got = sorted(str(r[0]) for r in clean.collapse_rare(df).collect())
    assert got == ["None"] + ["a"] * 5 + ["other"] * 4


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_small_and_large_join_sides_agree(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    left = spark.range(50).withColumn("k", F.col("id") % 10)
    right = spark.createDataFrame([(i, f"v{i}") for i in range(0, 10, 2)], "k long, v string")
    got = join_small(left, right, "k", "left")
    assert got.filter("v is not null").count() == 25 and got.count() == 50
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keep_first_without_order_and_with_ties(spark):
    rows = [("a", None, 5.0), ("b", 2, 1.0), ("b", None, 9.0), ("c", 1, 3.0), ("c", 1, 4.0), ("c", 2, 0.0)]
    df = spark.createDataFrame(rows, "trans_num string, record_id long, amount double")
    got = {r["trans_num"]: (r["record_id"], r["amount"]) for r in clean.drop_duplicates_keep_first(df).collect()}
    assert got["a"] == (None, 5.0) and got["b"] == (2, 1.0) and got["c"] in ((1, 3.0), (1, 4.0))
    again = {r["trans_num"]: (r["record_id"], r["amount"]) for r in clean.drop_duplicates_keep_first(df.repartition(5)).collect()}
    assert again == got


def test_infinite_numbers_are_missing(spark):
    df = spark.createDataFrame([("inf", float("inf")), ("1e999", float("nan")), ("-Infinity", float("-inf")), ("2.5", 2.5), ("-0", None)], "t string, n double")
    got = df.select(to_double(F.col("t")).alias("t"), as_double(F.col("n"), df.schema["n"].dataType).alias("n")).collect()
    assert [tuple(r) for r in got] == [(None, None), (None, None), (None, None), (2.5, 2.5), (0.0, None)]


def test_rules(spark):
    df = spark.createDataFrame([
        ("e1", 1000.0, 5.0, "USD", "m", "2024-01-01 00:00:00", "US", 0),
        (None, 999.0, 0.0, "usd", None, "soon", "USA", 2),
        ("e3", 9999.0, 100000.0, "USD", None, "2024-01-01", None, 1),
    ], "transaction_id string, user_id double, amount double, currency string, merchant string, timestamp string, location string, is_fraud int")
    good, bad = clean.split_valid(df)
    assert sorted(r["transaction_id"] for r in good.collect()) == ["e1", "e3"]
    assert bad.first()["violations"] == ["transaction_id", "user_id", "amount", "currency", "timestamp", "location", "is_fraud"]


def test_profile_guards(spark):
    none = spark.createDataFrame([(0,)], "is_fraud int")
    with pytest.raises(ValueError, match="no positive"):
        profile.check_positives(none)
    with pytest.warns(UserWarning, match="positive rows"):
        assert profile.check_positives(spark.createDataFrame([(1,), (0,)], "is_fraud int")) == 1


def test_histogram_shares_sum_to_one_per_label(spark):
    df = spark.range(100).select((F.col("id") * 1.7).alias("amount"), (F.col("id") % 4 == 0).cast("int").alias("is_fraud"))
    sums = profile.label_density(df).groupBy("is_fraud").agg(F.sum("share")).collect()
    assert all(s[1] == pytest.approx(1.0) for s in sums) and len(sums) == 2
