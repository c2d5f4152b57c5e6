"""Every operator as a named query over the test tables, with the same result written as SQL.

A query takes (spark, folder of parquet tables) and returns a frame over the whole tables. ``covers``
names the survey entries it exercises.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark import views
from ledgerlark.functions import hashing
from ledgerlark.functions.scalar import event_time, to_double
from ledgerlark.operators import (
    clean, features, foldstats, history, metrics, models, noise, normalise, ordered, orderstats, preprocess, profile, sampling, scoring,
)
from ledgerlark.operators.sampling import HashOrder
from ledgerlark.plans import exploration, publishing, search, training
from ledgerlark.schema import BEHAVIOUR_FEATURES, CATEGORICAL_FEATURES, RAW_CSV_COLUMNS, raw_csv_schema
from ledgerlark.session import materialise, scratch_path
from ledgerlark.sources import files, messages, runs
from ledgerlark.streaming import history as stream_history, profiles as stream_profiles, scoring as stream_scoring, state as stream_state
from ledgerlark.views import scored, txn, txn_raw, with_views


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    covers: str
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    def register(run):
        REGISTRY[run.__name__] = Query(run, covers, sql.strip() if sql else None)
        return run
    return register


# Any engine with md5 draws the same samples.
ORDER = HashOrder("record_id", 42, "md5")
HASH = "CAST('0x' || substr(md5(concat_ws('|', CAST({id} AS VARCHAR), '{seed}')), 1, 8) AS BIGINT)"


def _hash(row_id: str = "record_id", seed: int = 42) -> str:
    return HASH.format(id=row_id, seed=seed)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _micros(df: DataFrame, column: str = "transaction_time") -> DataFrame:
    return df.withColumn(column, F.unix_micros(column))


# --- flagship -------------------------------------------------------------------------------

@query("A5 A4 P19", with_views("txn") + """,
tidy AS (SELECT lower(trim(category)) AS category, is_fraud FROM txn),
top AS (SELECT category, count(*) AS transactions, sum(is_fraud) AS fraud_cases FROM tidy
        GROUP BY category ORDER BY transactions DESC, category LIMIT 10)
SELECT category, transactions, CAST(fraud_cases AS BIGINT) AS fraud_cases,
  round(fraud_cases / transactions, 6) AS fraud_rate FROM top ORDER BY fraud_rate DESC, category
""")
def fraud_rate_by_top_category(spark, sf_dir):
    rows = txn(spark, sf_dir).withColumn("category", clean.standard_category(F.col("category")))
    return _rounded(profile.label_rate_by_top(rows), "fraud_rate")


# --- sources and sinks ----------------------------------------------------------------------

def _raw_rows(spark, sf_dir) -> DataFrame:
    """``txn_raw`` with the full CSV header."""
    raw = txn_raw(spark, sf_dir)
    missing = {c: F.lit(None).cast("string") for c in RAW_CSV_COLUMNS if c not in raw.columns}
    return raw.withColumns(missing).select("idx", *RAW_CSV_COLUMNS)


def _message_folder(spark, sf_dir, files_wanted: int | None = None) -> dict:
    """The transactions as messages in a folder: the stand-in for a topic."""
    payload = txn(spark, sf_dir).select(
        "record_id", F.date_format("transaction_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("transacted_at"), "card_number",
        "merchant", "category", "amount", "gender", "city", "state", "zip", "lat", "long", "city_pop",
        "transaction_id", "merchant_lat", "merchant_long", "is_fraud", "transaction_time")
    envelope = messages.to_envelope(payload.drop("transaction_time"))
    if files_wanted:
        envelope = envelope.repartition(files_wanted)
    config = {"path": scratch_path(spark, "topic")}
    messages.publish(envelope, config)
    return config


@query("S1 S8 P1 P7", with_views("txn") + """
SELECT record_id, transaction_id, card_number, epoch_us(transaction_time) AS transaction_time, amount,
  coalesce(gender, 'unknown') AS gender, coalesce(category, 'unknown') AS category,
  coalesce(state, 'unknown') AS state, coalesce(city, 'unknown') AS city,
  coalesce(merchant, 'unknown') AS merchant, lat, city_pop, is_fraud FROM txn
""")
def bounded_message_read(spark, sf_dir):
    read = messages.read_messages(spark, _message_folder(spark, sf_dir))
    return _micros(normalise.normalise_messages(read)).select(
        "record_id", "transaction_id", "card_number", "transaction_time", "amount", "gender", "category",
        "state", "city", "merchant", "lat", "city_pop", "is_fraud")


_PAYLOAD_SQL = """
SELECT CASE WHEN CAST(idx AS BIGINT) = 0 THEN -1 ELSE CAST(idx AS BIGINT) END AS record_id,
  trans_num AS transaction_id, trans_date_trans_time AS transacted_at, cc_num AS card_number,
  merchant, category, TRY_CAST(amt AS DOUBLE) AS amount, gender, city, state,
  CAST(TRY_CAST(zip AS DOUBLE) AS BIGINT) AS zip, TRY_CAST(lat AS DOUBLE) AS lat,
  CAST(TRY_CAST(city_pop AS DOUBLE) AS BIGINT) AS city_pop, TRY_CAST(merch_lat AS DOUBLE) AS merchant_lat,
  CAST(unix_time AS BIGINT) AS unix_time, CAST(is_fraud AS BIGINT) AS is_fraud
"""
_PAYLOAD_COLUMNS = ["record_id", "transaction_id", "transacted_at", "card_number", "merchant", "category",
                    "amount", "gender", "city", "state", "zip", "lat", "city_pop", "merchant_lat", "unix_time",
                    "is_fraud"]


@query("S4 P10 P11 P12 P13", with_views("txn_raw") + _PAYLOAD_SQL + " FROM txn_raw WHERE trans_num <> ''")
def csv_scan_to_payload(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(_raw_rows(spark, sf_dir), path)
    raw = files.read_csv(spark, path, raw_csv_schema("idx")).withColumn("ordinal", F.lit(-1).cast("bigint"))
    return messages.transaction_payload(raw, "idx").select(*_PAYLOAD_COLUMNS)


@query("P13 S4", with_views("txn_raw") + """
SELECT count(*) AS n, min(i) AS low, max(i) AS high, count(DISTINCT i) AS distinct_ordinals
FROM (SELECT row_number() OVER (ORDER BY idx) - 1 AS i FROM txn_raw)
""")
def row_ordinals(spark, sf_dir):
    return messages.with_ordinal(txn_raw(spark, sf_dir).select("idx")).agg(
        F.count("*").alias("n"), F.min("ordinal").alias("low"), F.max("ordinal").alias("high"),
        F.count_distinct("ordinal").alias("distinct_ordinals"))


@query("S5 S4", with_views("txn_raw") + """
SELECT idx, cc_num, merchant, nullif(amt, '') AS amt, nullif(trans_num, '') AS trans_num FROM txn_raw
""")
def fallback_to_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(_raw_rows(spark, sf_dir), path)
    empty = scratch_path(spark, "no-topic")
    return files.read_with_fallback(
        lambda: messages.read_messages(spark, {"path": empty}),
        lambda: files.read_csv(spark, path, raw_csv_schema("idx"))).select("idx", "cc_num", "merchant", "amt", "trans_num")


@query("S6 J5", with_views("txn_raw") + """
SELECT cc_num, merchant, category, nullif(amt, '') AS amt, nullif(trans_num, '') AS trans_num, is_fraud FROM txn_raw
""")
def merged_csv_files(spark, sf_dir):
    raw = _raw_rows(spark, sf_dir)
    first, second = scratch_path(spark, "train-csv"), scratch_path(spark, "test-csv")
    is_first = F.col("idx").cast("bigint") % 10 < 7
    files.write_csv(raw.filter(is_first), first)
    files.write_csv(raw.filter(~is_first), second)
    merged = files.merge_csv(spark, first, second, raw_csv_schema("idx"), scratch_path(spark, "merged-csv"), "idx")
    return merged.select("cc_num", "merchant", "category", "amt", "trans_num", "is_fraud")


@query("S4", with_views("txn_raw") + " SELECT merchant, nullif(amt, '') AS amt, cc_num FROM txn_raw")
def csv_with_index_column(spark, sf_dir):
    """A file with a leading index, an unknown column and another order than the declared one."""
    path = scratch_path(spark, "csv")
    raw = _raw_rows(spark, sf_dir).withColumn("note", F.lit("x"))
    files.write_csv(raw.select(F.col("idx").alias("row"), "note", *reversed(RAW_CSV_COLUMNS)), path)
    return files.read_csv(spark, path, raw_csv_schema()).select("merchant", "amt", "cc_num")


@query("S8 X7 P10 P12", with_views("txn_raw") + """
SELECT trans_num AS key, TRY_CAST(amt AS DOUBLE) AS amount, merchant FROM txn_raw WHERE trans_num <> ''
""")
def published_without_limit(spark, sf_dir):
    config = {"path": scratch_path(spark, "topic")}
    publishing.publish_rows(_raw_rows(spark, sf_dir), config, index="idx")
    read = messages.read_messages(spark, config)
    return read.select("key", F.from_json("value", "amount double, merchant string").alias("d")).select("key", "d.*")


@query("S8 X5 X7 P10", with_views("txn_raw") + f""",
drawn AS (SELECT * FROM txn_raw ORDER BY {_hash('idx')}, idx LIMIT 10000)
SELECT trans_num AS key, CAST(idx AS BIGINT) AS record_id, trans_num AS transaction_id,
  TRY_CAST(amt AS DOUBLE) AS amount, merchant FROM drawn WHERE trans_num <> ''
""")
def published_sample(spark, sf_dir):
    raw = sampling.take(_raw_rows(spark, sf_dir), 10_000, HashOrder("idx", 42, "md5"))
    payload = messages.transaction_payload(raw.withColumn("ordinal", F.lit(0).cast("bigint")), "idx")
    config = {"path": scratch_path(spark, "topic")}
    messages.publish(messages.to_envelope(sampling.shuffled(payload, HashOrder("record_id"))), config)
    read = messages.read_messages(spark, config)
    return read.select("key", F.from_json("value", "record_id bigint, transaction_id string, amount double, merchant string")
                       .alias("d")).select("key", "d.*")


@query("S10", with_views("txn") + """,
folds AS (SELECT CAST(record_id % 5 AS INT) AS fold, avg(is_fraud) AS v FROM txn GROUP BY 1)
SELECT 'metric' AS kind, 'positive_ratio' AS key, fold, round(v, 6) AS number FROM folds
UNION ALL SELECT 'metric', 'samples', NULL, CAST(count(*) AS DOUBLE) FROM txn
UNION ALL SELECT 'param', 'n_folds', NULL, 5.0
""")
def run_records(spark, sf_dir):
    rows = txn(spark, sf_dir)
    by_fold = (rows.groupBy((F.col("record_id") % 5).cast("int").alias("fold")).agg(F.avg("is_fraud").alias("value"))
               .withColumn("metric", F.lit("positive_ratio")))
    path = scratch_path(spark, "runs")
    runs.append_run(spark, path, "profile", {"n_folds": 5}, {"samples": rows.count()}, by_fold)
    return runs.read_runs(spark, path).select("kind", "key", "fold", F.round(F.col("value").cast("double"), 6).alias("number"))


# --- normalising and cleaning ---------------------------------------------------------------

def _typed_sql(extra: str = "") -> str:
    return with_views("txn_raw") + """,
typed AS (SELECT *, CAST(idx AS BIGINT) AS record_id, TRY_CAST(trans_date_trans_time AS TIMESTAMP) AS transacted_at,
  TRY_CAST(amt AS DOUBLE) AS amt_n, TRY_CAST(lat AS DOUBLE) AS lat_n, TRY_CAST(long AS DOUBLE) AS long_n,
  TRY_CAST(city_pop AS DOUBLE) AS city_pop_n, TRY_CAST(merch_lat AS DOUBLE) AS merch_lat_n,
  TRY_CAST(merch_long AS DOUBLE) AS merch_long_n FROM txn_raw),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trans_num ORDER BY record_id) AS nth FROM typed)
           WHERE nth = 1)""" + extra


@query("P2 P3 P4 P5 P8 P9", _typed_sql() + """
SELECT record_id, trans_num AS transaction_id, cc_num AS card_number, epoch_us(transacted_at) AS transaction_time,
  amt_n AS amount, lat_n AS lat, city_pop_n AS city_pop, merch_lat_n AS merchant_lat, CAST(is_fraud AS INT) AS is_fraud
FROM typed WHERE transacted_at IS NOT NULL AND amt_n IS NOT NULL AND is_fraud IS NOT NULL
""")
def normalised_rows(spark, sf_dir):
    rows = normalise.normalise(txn_raw(spark, sf_dir).withColumn("record_id", F.col("idx").cast("bigint")))
    return _micros(rows).select("record_id", "transaction_id", "card_number", "transaction_time", "amount", "lat",
                                "city_pop", "merchant_lat", "is_fraud")


@query("P6", _typed_sql() + """
SELECT record_id, epoch_us(coalesce(transacted_at, make_timestamp(CAST(unix_time AS BIGINT) * 1000000))) AS transaction_time
FROM typed
""")
def event_times(spark, sf_dir):
    raw = txn_raw(spark, sf_dir)
    time = event_time(F.col("trans_date_trans_time"), F.col("unix_time"))
    return raw.select(F.col("idx").cast("bigint").alias("record_id"), F.unix_micros(time).alias("transaction_time"))


@query("P7", with_views("txn") + """
SELECT record_id, coalesce(gender, 'unknown') AS gender, coalesce(category, 'unknown') AS category,
  coalesce(state, 'unknown') AS state, coalesce(city, 'unknown') AS city, coalesce(merchant, 'unknown') AS merchant
FROM txn
""")
def filled_categoricals(spark, sf_dir):
    return normalise.fill_categoricals(txn(spark, sf_dir)).select("record_id", "gender", "category", "state", "city", "merchant")


def _typed(spark, sf_dir) -> DataFrame:
    raw = txn_raw(spark, sf_dir).withColumn("record_id", F.col("idx").cast("bigint"))
    return exploration.typed(raw)


@query("P14", with_views("txn") + """
SELECT card_number, min(CASE WHEN record_id % 3 <> 0 THEN record_id // 10 END) AS record_id, true AS whole FROM txn GROUP BY card_number
""")
def first_of_untidy_duplicates(spark, sf_dir):
    """Order values are missing or equal; the first row of each card comes out whole."""
    rows = txn(spark, sf_dir).select("card_number", "transaction_id", F.when(
        F.col("record_id") % 3 != 0, F.floor(F.col("record_id") / 10)).alias("record_id"))
    first = clean.drop_duplicates_keep_first(rows, "card_number")
    return first.select("card_number", "record_id", F.col("transaction_id").isNotNull().alias("whole"))


@query("P4 P11", with_views("txn") + """
SELECT record_id, CASE WHEN record_id % 11 IN (0, 1, 2) THEN NULL ELSE amount END AS amount FROM txn
""")
def numbers_that_are_not_finite(spark, sf_dir):
    text = F.when(F.col("record_id") % 11 == 0, "Infinity").when(F.col("record_id") % 11 == 1, "-1e999").when(
        F.col("record_id") % 11 == 2, "NaN").otherwise(F.col("amount").cast("string"))
    return txn(spark, sf_dir).select("record_id", to_double(text).alias("amount"))


@query("P14", _typed_sql() + """
SELECT trans_num, record_id, cc_num, merchant, amt_n AS amt, is_fraud FROM firsts
""")
def first_of_duplicates(spark, sf_dir):
    rows = _typed(spark, sf_dir).select("trans_num", "record_id", "cc_num", "merchant", "amt", "is_fraud")
    return clean.drop_duplicates_keep_first(rows)


@query("P14", """
WITH lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS nth FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lines WHERE nth = 1
""")
def first_of_duplicate_lines(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    keyed = lines.select(F.struct("l_orderkey", "l_linenumber").alias("line"), "l_partkey", "l_suppkey", "l_quantity",
                         F.struct(*order).alias("place"))
    firsts = clean.drop_duplicates_keep_first(keyed, "line", "place")
    return firsts.select("line.*", "l_partkey", "l_suppkey", "l_quantity")


@query("P15", with_views("txn_raw") + """
SELECT count(*) - count(DISTINCT trans_num) AS duplicates_removed FROM txn_raw
""")
def duplicate_count(spark, sf_dir):
    return clean.duplicate_count(txn_raw(spark, sf_dir))


_FENCES = """,
q AS (SELECT {stats} FROM firsts)"""


def _fence_sql(columns: list[str]) -> str:
    stats = ", ".join(f"quantile_cont({c}_n, 0.25) AS {c}_1, quantile_cont({c}_n, 0.75) AS {c}_3" for c in columns)
    return _FENCES.format(stats=stats)


def _clip_sql(c: str) -> str:
    low, high = f"({c}_1 - 1.5 * ({c}_3 - {c}_1))", f"({c}_3 + 1.5 * ({c}_3 - {c}_1))"
    return f"CASE WHEN {c}_n IS NULL THEN NULL ELSE least(greatest({c}_n, {low}), {high}) END"


_OUTLIERS = ["amt", "city_pop", "lat", "long", "merch_lat", "merch_long"]
_CLIPPED = ", ".join(f"round({'abs(' if c == 'amt' else '('}{_clip_sql(c)}), 6) AS {c}" for c in _OUTLIERS)


@query("P16 P17", _typed_sql(_fence_sql(_OUTLIERS)) + f"""
SELECT record_id, {_CLIPPED} FROM firsts, q
""")
def winsorised(spark, sf_dir):
    rows = clean.drop_duplicates_keep_first(_typed(spark, sf_dir).select("record_id", "trans_num", *_OUTLIERS))
    rows = materialise(rows, "deduplicated")
    return _rounded(clean.absolute(clean.winsorise(rows)), *_OUTLIERS).select("record_id", *_OUTLIERS)


_STANDARD = """CASE upper(trim(gender)) WHEN 'FEMALE' THEN 'F' WHEN 'MALE' THEN 'M' ELSE upper(trim(gender)) END AS gender,
  lower(trim(category)) AS category,
  CASE WHEN length(trim(state)) = 2 THEN upper(trim(state)) ELSE 'UNK' END AS state"""


@query("P18 P19 P20 F13", with_views("txn") + f" SELECT record_id, {_STANDARD} FROM txn")
def standard_categories(spark, sf_dir):
    return clean.standardise(txn(spark, sf_dir)).select("record_id", "gender", "category", "state")


@query("P21 J2", with_views("txn") + """,
counts AS (SELECT merchant AS m, count(*) AS n FROM txn GROUP BY merchant)
SELECT record_id, CASE WHEN n < 5 THEN 'other' ELSE merchant END AS merchant
FROM txn LEFT JOIN counts ON merchant = m
""")
def collapsed_merchants(spark, sf_dir):
    return clean.collapse_rare(txn(spark, sf_dir).select("record_id", "merchant"))


@query("P14 P16 P17 P18 P19 P20 P21 P9", _typed_sql(_fence_sql(_OUTLIERS)) + f""",
counts AS (SELECT merchant AS m, count(*) AS n FROM firsts GROUP BY merchant)
SELECT record_id, trans_num, {_CLIPPED}, {_STANDARD}, CASE WHEN n < 5 THEN 'other' ELSE merchant END AS merchant,
  CAST(is_fraud AS INT) AS is_fraud
FROM firsts LEFT JOIN counts ON merchant = m, q
""")
def cleaned_rows(spark, sf_dir):
    raw = txn_raw(spark, sf_dir).withColumn("record_id", F.col("idx").cast("bigint"))
    return _rounded(exploration.cleaned(raw), *_OUTLIERS).select(
        "record_id", "trans_num", *_OUTLIERS, "gender", "category", "state", "merchant", "is_fraud")


_RULES_SQL = """,
checked AS (SELECT record_id,
  concat_ws(',', CASE WHEN transaction_id IS NULL THEN 'transaction_id' END,
    CASE WHEN user_id IS NULL OR user_id < 1000 OR user_id > 9999 THEN 'user_id' END,
    CASE WHEN amount IS NULL OR amount < 0.01 OR amount > 100000 THEN 'amount' END,
    CASE WHEN currency IS NULL OR NOT regexp_matches(currency, '^[A-Z]{3}$') THEN 'currency' END,
    CASE WHEN "timestamp" IS NULL OR TRY_CAST("timestamp" AS TIMESTAMP) IS NULL THEN 'timestamp' END,
    CASE WHEN location IS NOT NULL AND NOT regexp_matches(location, '^[A-Z]{2}$') THEN 'location' END,
    CASE WHEN is_fraud IS NULL OR is_fraud < 0 OR is_fraud > 1 THEN 'is_fraud' END) AS violations FROM event)"""


@query("P22", with_views("event") + _RULES_SQL + " SELECT record_id, violations FROM checked WHERE violations <> ''")
def quarantined_events(spark, sf_dir):
    _, bad = clean.split_valid(views.events(spark, sf_dir))
    return bad.select("record_id", F.array_join("violations", ",").alias("violations"))


@query("P22", with_views("event") + _RULES_SQL + """
SELECT e.record_id, e.transaction_id, e.user_id, e.amount FROM event e JOIN checked c ON e.record_id = c.record_id
WHERE c.violations = ''
""")
def valid_events(spark, sf_dir):
    good, _ = clean.split_valid(views.events(spark, sf_dir))
    return good.select("record_id", "transaction_id", "user_id", "amount")


@query("P23 J3", with_views("event") + """,
compromised AS (SELECT DISTINCT CAST(1000 + c_custkey * 5 AS DOUBLE) AS user_id FROM customer WHERE c_acctbal < 0)
SELECT record_id,
  CASE WHEN amount > 500 AND user_id IN (SELECT user_id FROM compromised) THEN 1 ELSE 0 END AS account_takeover,
  CASE WHEN amount < 2 AND CAST(user_id AS BIGINT) % 1000 = 0 THEN 1 ELSE 0 END AS card_testing,
  CASE WHEN merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') AND amount > 300 THEN 1 ELSE 0 END AS merchant_collusion,
  CASE WHEN CAST(user_id AS BIGINT) % 500 = 0 THEN 1 ELSE 0 END AS geo_anomaly FROM event
""")
def suspicious_patterns(spark, sf_dir):
    compromised = (views.table(spark, sf_dir, "customer").filter("c_acctbal < 0")
                   .select((F.col("c_custkey") * 5 + 1000).cast("double").alias("user_id")))
    return clean.flag_patterns(views.events(spark, sf_dir), compromised).select(
        "record_id", "account_takeover", "card_testing", "merchant_collusion", "geo_anomaly")


# --- row-wise features ----------------------------------------------------------------------

_CALENDAR = """CAST(hour(transaction_time) AS INT) AS transaction_hour,
  CAST(isodow(transaction_time) - 1 AS INT) AS transaction_dayofweek,
  CAST(month(transaction_time) AS INT) AS transaction_month"""
_CALENDAR_FLAGS = """CASE WHEN hour(transaction_time) >= 22 OR hour(transaction_time) < 5 THEN 1 ELSE 0 END AS is_night,
  CASE WHEN isodow(transaction_time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CAST(day(transaction_time) AS INT) AS transaction_day"""


@query("F1 F2 F3 F4", with_views("txn") + f" SELECT record_id, {_CALENDAR}, {_CALENDAR_FLAGS} FROM txn")
def calendar_features(spark, sf_dir):
    rows = features.add_calendar_flags(features.add_calendar(txn(spark, sf_dir)))
    return rows.select("record_id", "transaction_hour", "transaction_dayofweek", "transaction_month", "is_night",
                       "is_weekend", "transaction_day")


_TRAINING_FEATURES = f"""{_CALENDAR}, coalesce(gender, 'unknown') AS gender,
  round(ln(1 + greatest(amount, 0)), 6) AS amount_log,
  round(sqrt(pow(lat - merchant_lat, 2) + pow(long - merchant_long, 2)), 6) AS merchant_distance,
  CASE WHEN city_pop IS NULL THEN NULL ELSE round(ln(1 + greatest(city_pop, 0)), 6) END AS city_pop_log"""


@query("F1 F5 F6 F10 P24", with_views("txn") + f" SELECT record_id, {_TRAINING_FEATURES} FROM txn")
def training_features(spark, sf_dir):
    rows = training.training_rows(txn(spark, sf_dir))
    return _rounded(features.feature_columns(rows), "amount_log", "merchant_distance", "city_pop_log").select(
        "record_id", "transaction_hour", "transaction_dayofweek", "transaction_month", "gender", "amount_log",
        "merchant_distance", "city_pop_log")


_SERVING_COLUMNS = ["record_id", "transaction_hour", "transaction_dayofweek", "transaction_month", "is_night",
                    "is_weekend", "transaction_day", "amount_log", "merchant_distance", "city_pop_log",
                    "time_since_last_txn", "user_activity_24h", "rolling_avg_7d", "amount_to_avg_ratio", "merchant_risk"]
_SERVING_SQL = f"""
SELECT record_id, {_CALENDAR}, {_CALENDAR_FLAGS}, round(ln(1 + greatest(coalesce(amount, 0), 0)), 6) AS amount_log,
  round(sqrt(pow(coalesce(lat, 0) - merchant_lat, 2) + pow(long - merchant_long, 2)), 6) AS merchant_distance,
  round(ln(1 + greatest(coalesce(city_pop, 0), 0)), 6) AS city_pop_log, CAST(0 AS DOUBLE) AS time_since_last_txn,
  1000 AS user_activity_24h, CAST(1000 AS DOUBLE) AS rolling_avg_7d, round(amount / 1000, 6) AS amount_to_avg_ratio,
  CASE WHEN merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') THEN 1 ELSE 0 END AS merchant_risk
FROM txn WHERE amount IS NOT NULL"""


def _served(rows: DataFrame) -> DataFrame:
    return _rounded(rows, "amount_log", "merchant_distance", "city_pop_log", "amount_to_avg_ratio").select(*_SERVING_COLUMNS)


@query("F5 F6 F8 F9 T2 J3", with_views("txn") + _SERVING_SQL)
def serving_features(spark, sf_dir):
    return _served(features.add_serving_features(txn(spark, sf_dir)))


@query("F7", with_views("txn") + """
SELECT record_id, round(2 * 6371 * asin(sqrt(pow(sin((radians(merchant_lat) - radians(lat)) / 2), 2)
  + cos(radians(lat)) * cos(radians(merchant_lat)) * pow(sin((radians(merchant_long) - radians(long)) / 2), 2))), 4)
  AS customer_merchant_distance_km FROM txn
""")
def haversine_distances(spark, sf_dir):
    return _rounded(features.add_haversine(txn(spark, sf_dir)), "customer_merchant_distance_km", digits=4).select(
        "record_id", "customer_merchant_distance_km")


def _normal_sql(column: str, seed: int) -> str:
    u = "((" + HASH.replace("{id}", "concat_ws('|', CAST(record_id AS VARCHAR), '{column}', '{part}')") + " + 0.5) / 4294967296.0)"
    u1, u2 = (u.format(column=column, part=p, seed=seed) for p in "ab")
    return f"sqrt(-2 * ln({u1})) * cos(2 * pi() * {u2})"


@query("F11", with_views("txn") + f""",
s AS (SELECT stddev_samp(amount) AS sa, stddev_samp(city_pop) AS sc FROM txn)
SELECT record_id, round(amount + {_normal_sql('amount', 42)} * sa * 0.05, 5) AS amount,
  round(city_pop + {_normal_sql('city_pop', 42)} * sc * 0.05, 5) AS city_pop FROM txn, s
""")
def sample_noise(spark, sf_dir):
    rows = txn(spark, sf_dir).select("record_id", "amount", "city_pop")
    return _rounded(noise.add_sample_noise(rows, ["amount", "city_pop"], 0.05, "record_id", 42, "md5"), "amount",
                    "city_pop", digits=5)


@query("F12", with_views("txn") + f""",
t AS (SELECT *, 7.0 AS flat FROM txn WHERE record_id % 3 <> 0),
s AS (SELECT stddev_pop(amount) AS sa FROM t)
SELECT record_id, round(amount + {_normal_sql('amount', 43)} * sa * 0.05, 5) AS amount,
  round(flat + {_normal_sql('flat', 43)} * 1e-8 * 0.05, 5) AS flat FROM t, s
""")
def fold_noise(spark, sf_dir):
    rows = (txn(spark, sf_dir).filter("record_id % 3 <> 0")
            .select("record_id", "amount", F.lit(7.0).cast("double").alias("flat")))
    return _rounded(noise.add_fold_noise(rows, ["amount", "flat"], 0.05, "record_id", 43, "md5"), "amount", "flat", digits=5)


def _part_sql(fold: int) -> str:
    return f"""SELECT {fold} AS fold, record_id, round(amount + {_normal_sql('amount', 43 + fold)} * sa * 0.05, 5) AS amount,
  round(7.0 + {_normal_sql('flat', 43 + fold)} * 1e-8 * 0.05, 5) AS flat
FROM marked, (SELECT stddev_pop(amount) AS sa FROM marked WHERE fold <> {fold}) WHERE fold <> {fold}"""


@query("F12 X2", with_views("txn") + f""",
marked AS (SELECT record_id, amount, ntile(3) OVER (PARTITION BY is_fraud ORDER BY {_hash()}, record_id) - 1 AS fold FROM txn)
""" + " UNION ALL ".join(_part_sql(fold) for fold in range(3)))
def fold_noise_parts(spark, sf_dir):
    """Noise in the training part of every fold, from all rows of the table."""
    rows = txn(spark, sf_dir).select("record_id", "is_fraud", "amount", F.lit(7.0).cast("double").alias("flat"))
    marked = materialise(sampling.mark_folds(rows, 3, order=ORDER), "folds")
    parts = [noise.add_fold_noise(marked.filter(F.col("fold") != fold), ["amount", "flat"], 0.05, "record_id", 43 + fold, "md5")
             .withColumn("fold", F.lit(fold)) for fold in range(3)]
    noisy = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _rounded(noisy, "amount", "flat", digits=5).select("fold", "record_id", "amount", "flat")


# --- history --------------------------------------------------------------------------------

_DAY_FRAME = """OVER (PARTITION BY card_number ORDER BY transaction_time
  RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"""
_WEEK_FRAME = _DAY_FRAME.replace("24 HOURS", "7 DAYS")
_ROW_FRAME = "OVER (PARTITION BY card_number ORDER BY transaction_time, transaction_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
_LAST = "lag(transaction_time) OVER (PARTITION BY card_number ORDER BY transaction_time, transaction_id)"
_ACTIVITY_SQL = with_views("txn") + f" SELECT record_id, count(amount) {_DAY_FRAME} AS user_activity_24h FROM txn"
_RATIO_SQL = with_views("txn") + f"""
SELECT record_id, round(coalesce(amount / nullif(avg(amount) {_ROW_FRAME}, 0), 1), 9) AS amount_to_avg_ratio FROM txn"""
_BEHAVIOUR_SQL = with_views("txn") + f"""
SELECT record_id, count(amount) {_DAY_FRAME} AS user_activity_24h, round(avg(amount) {_WEEK_FRAME}, 9) AS rolling_avg_7d,
  round((epoch_us(transaction_time) - epoch_us({_LAST})) / 1000000, 6) AS time_since_last_txn,
  round(coalesce(amount / nullif(avg(amount) {_ROW_FRAME}, 0), 1), 9) AS amount_to_avg_ratio FROM txn"""
_BEHAVIOUR_COLUMNS = ["record_id", "user_activity_24h", "rolling_avg_7d", "time_since_last_txn", "amount_to_avg_ratio"]


def _history_rows(spark, sf_dir) -> DataFrame:
    return txn(spark, sf_dir).select("record_id", "transaction_id", "card_number", "transaction_time", "amount")


def _behaviour(df: DataFrame) -> DataFrame:
    df = _rounded(df, "rolling_avg_7d", "amount_to_avg_ratio", digits=9)
    return _rounded(df, "time_since_last_txn").select(*_BEHAVIOUR_COLUMNS)


@query("W1 W6 U4", _ACTIVITY_SQL)
def user_activity_24h(spark, sf_dir):
    return history.add_user_activity(_history_rows(spark, sf_dir)).select("record_id", "user_activity_24h")


@query("W2 U4", _RATIO_SQL)
def amount_to_avg_ratio(spark, sf_dir):
    return _rounded(history.add_amount_ratio(_history_rows(spark, sf_dir)), "amount_to_avg_ratio", digits=9).select(
        "record_id", "amount_to_avg_ratio")


@query("W1 W2 W3 W4 W5 W6", _BEHAVIOUR_SQL)
def behaviour_history(spark, sf_dir):
    return _behaviour(history.add_behaviour(_history_rows(spark, sf_dir)))


@query("W1 W2 W3 W5 (cards cut into slices)", _BEHAVIOUR_SQL)
def behaviour_history_of_hot_cards(spark, sf_dir):
    """The same history with the busiest cards routed through slices."""
    rows = _history_rows(spark, sf_dir)
    return _behaviour(history.add_behaviour(rows, hot_rows=rows.count() // 140))


_UNTIDY_HISTORY_SQL = with_views("txn") + f""",
untidy AS (SELECT record_id, transaction_id, card_number, CASE WHEN record_id % 37 = 0 THEN NULL ELSE transaction_time END AS transaction_time,
  CASE WHEN record_id % 499 = 0 THEN 1e12 ELSE amount END AS amount FROM txn),
known AS (SELECT record_id, count(amount) {_DAY_FRAME} AS user_activity_24h, avg(amount) {_WEEK_FRAME} AS a,
  round((epoch_us(transaction_time) - epoch_us({_LAST})) / 1000000, 6) AS time_since_last_txn,
  round(coalesce(amount / nullif(avg(amount) {_ROW_FRAME}, 0), 1), 6) AS amount_to_avg_ratio
  FROM untidy WHERE transaction_time IS NOT NULL AND card_number IS NOT NULL)
SELECT record_id, user_activity_24h, CASE WHEN a > 1e6 THEN round(a) ELSE round(a, 6) END AS rolling_avg_7d, time_since_last_txn,
  amount_to_avg_ratio FROM known
UNION ALL SELECT record_id, 0, NULL, NULL, 1.0 FROM untidy WHERE transaction_time IS NULL OR card_number IS NULL"""


def _untidy_history(spark, sf_dir, **routing) -> DataFrame:
    """History over rows of which some have no time and some a huge amount."""
    rows = _history_rows(spark, sf_dir).withColumns({
        "transaction_time": F.when(F.col("record_id") % 37 != 0, F.col("transaction_time")),
        "amount": F.when(F.col("record_id") % 499 == 0, 1e12).otherwise(F.col("amount"))})
    found = history.add_behaviour(rows, **routing)
    mean = F.col("rolling_avg_7d")
    return _rounded(found.withColumn("rolling_avg_7d", F.when(mean > 1e6, F.round(mean)).otherwise(F.round(mean, 6))),
                    "time_since_last_txn", "amount_to_avg_ratio").select(*_BEHAVIOUR_COLUMNS)


@query("W1 W2 W3 W5", _UNTIDY_HISTORY_SQL)
def history_of_untidy_rows(spark, sf_dir):
    return _untidy_history(spark, sf_dir, hot=[])


@query("W1 W2 W3 W5 (cards cut into slices)", _UNTIDY_HISTORY_SQL)
def history_of_untidy_rows_of_hot_cards(spark, sf_dir):
    return _untidy_history(spark, sf_dir, hot_rows=txn(spark, sf_dir).count() // 140)


@query("W1 W2 F2 F3 F4 F9", with_views("txn") + f"""
SELECT record_id, amount, {_CALENDAR_FLAGS}, count(amount) {_DAY_FRAME} AS user_activity_24h,
  round(coalesce(amount / nullif(avg(amount) {_ROW_FRAME}, 0), 1), 9) AS amount_to_avg_ratio,
  CASE WHEN merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') THEN 1 ELSE 0 END AS merchant_risk,
  merchant, is_fraud FROM txn
""")
def behaviour_features(spark, sf_dir):
    rows = training.behaviour_rows(txn(spark, sf_dir)).select("record_id", *BEHAVIOUR_FEATURES, "is_fraud")
    return _rounded(rows, "amount_to_avg_ratio", digits=9)


# --- profile --------------------------------------------------------------------------------

_PROFILED = ["cc_num", "merchant", "category", "amt", "gender", "city", "state", "lat", "city_pop", "transacted_at"]


@query("A1", _typed_sql() + ", n AS (SELECT count(*) AS total FROM typed), m AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c + '_n' if c in ('amt', 'lat', 'city_pop') else c} IS NULL) "
    "AS missing_count FROM typed" for c in _PROFILED) + """)
SELECT "column", missing_count, round(missing_count / total, 6) AS missing_rate FROM m, n WHERE missing_count > 0
""")
def missing_values(spark, sf_dir):
    return _rounded(profile.missing_summary(_typed(spark, sf_dir), _PROFILED), "missing_rate")


@query("A2 E1", _typed_sql() + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}_n) AS count, round(avg({c}_n), 1) AS mean, round(stddev_samp({c}_n), 1) AS std,
  round(min({c}_n), 1) AS min, round(quantile_cont({c}_n, 0.25), 1) AS p25, round(quantile_cont({c}_n, 0.5), 1) AS p50,
  round(quantile_cont({c}_n, 0.75), 1) AS p75, round(max({c}_n), 1) AS max FROM typed""" for c in ("amt", "lat", "city_pop", "merch_long")))
def numeric_description(spark, sf_dir):
    return profile.describe_numeric(_typed(spark, sf_dir), ["amt", "lat", "city_pop", "merch_long"])


@query("A3", with_views("txn") + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", (SELECT count({c}) FROM txn) AS count, (SELECT count(DISTINCT {c}) FROM txn) AS "unique",
  v AS top, n AS freq FROM (SELECT {c} AS v, count(*) AS n FROM txn WHERE {c} IS NOT NULL GROUP BY {c}
  ORDER BY n DESC, v LIMIT 1)""" for c in CATEGORICAL_FEATURES))
def categorical_description(spark, sf_dir):
    return profile.describe_categorical(txn(spark, sf_dir), CATEGORICAL_FEATURES)


@query("A4", with_views("txn") + """
SELECT merchant, count(*) AS transactions FROM txn WHERE merchant IS NOT NULL GROUP BY merchant
ORDER BY transactions DESC, merchant LIMIT 10
""")
def top_merchants(spark, sf_dir):
    return profile.top_values(txn(spark, sf_dir), "merchant")


@query("J1 A4", with_views("txn") + """,
top AS (SELECT merchant FROM txn GROUP BY merchant ORDER BY count(*) DESC, merchant LIMIT 10)
SELECT record_id, merchant FROM txn WHERE merchant IN (SELECT merchant FROM top)
""")
def rows_of_top_merchants(spark, sf_dir):
    rows = txn(spark, sf_dir).select("record_id", "merchant")
    return profile.members(rows, "merchant", profile.top_values(rows, "merchant")).select("record_id", "merchant")


_QUANTILE_SQL = with_views("txn") + """
SELECT 'amount' AS "column", round(quantile_cont(amount, 0.25), 6) AS p25, round(quantile_cont(amount, 0.5), 6) AS p50,
  round(quantile_cont(amount, 0.99), 6) AS p99 FROM txn UNION ALL
SELECT 'city_pop', round(quantile_cont(city_pop, 0.25), 6), round(quantile_cont(city_pop, 0.5), 6),
  round(quantile_cont(city_pop, 0.99), 6) FROM txn
"""


def _quantile_frame(spark, sf_dir, **how) -> DataFrame:
    found = orderstats.quantiles(txn(spark, sf_dir), ["amount", "city_pop"], [0.25, 0.5, 0.99], **how)
    return spark.createDataFrame([(c, *[round(v, 6) for v in q]) for c, q in found.items()],
                                 "column string, p25 double, p50 double, p99 double")


@query("A6 E1", _QUANTILE_SQL)
def amount_quantiles(spark, sf_dir):
    return _quantile_frame(spark, sf_dir)


@query("A6 E1 (narrowing search)", _QUANTILE_SQL)
def amount_quantiles_by_narrowing(spark, sf_dir):
    """The same quantiles by the search used for columns too long for one buffer."""
    return _quantile_frame(spark, sf_dir, small=200, accuracy=100)


@query("A7", with_views("txn") + """,
b AS (SELECT is_fraud, CAST(floor(amount / 10) AS BIGINT) AS bin, count(*) AS transactions FROM txn GROUP BY 1, 2),
t AS (SELECT is_fraud AS l, sum(transactions) AS total FROM b GROUP BY 1)
SELECT is_fraud, bin, CAST(bin * 10 AS DOUBLE) AS bin_start, transactions, round(transactions / total, 6) AS share,
  round(transactions / total / 10, 6) AS density FROM b JOIN t ON is_fraud = l
""")
def amount_density(spark, sf_dir):
    return _rounded(profile.label_density(txn(spark, sf_dir)), "share", "density")


@query("A8", with_views("txn") + " SELECT round(avg(is_fraud) * 100, 6) AS fraud_rate_percent FROM txn")
def fraud_rate(spark, sf_dir):
    return _rounded(profile.label_rate(txn(spark, sf_dir)), "fraud_rate_percent")


# --- sampling -------------------------------------------------------------------------------

def _split_sql(fraction: float, seed: int, source: str = "txn") -> str:
    """Largest-remainder quota of the kept part per label, taken from the start of the hash order."""
    return f""",
sizes AS (SELECT is_fraud AS l, count(*) AS c, sum(count(*)) OVER () AS n FROM {source} GROUP BY is_fraud),
shares AS (SELECT l, c, (n - ceil(n * {fraction})) * c / n AS exact, n - ceil(n * {fraction}) AS total FROM sizes),
quota AS (SELECT l, floor(exact) + CASE WHEN row_number() OVER (ORDER BY floor(exact) - exact, CAST(l AS VARCHAR))
    <= total - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS kept FROM shares),
marked AS (SELECT s.*, row_number() OVER (PARTITION BY is_fraud ORDER BY {_hash(seed=seed)}, record_id) > kept AS is_test
  FROM {source} s JOIN quota ON is_fraud = l)"""


@query("X1", with_views("txn") + _split_sql(0.2, 42) + " SELECT record_id, is_fraud, is_test FROM marked")
def stratified_split(spark, sf_dir):
    rows = txn(spark, sf_dir).select("record_id", "is_fraud")
    return sampling.mark_split(rows, 0.2, order=ORDER)


def _untidy_ids(spark, sf_dir) -> DataFrame:
    """Raw rows of which some share an id and others have none."""
    return txn_raw(spark, sf_dir).select("is_fraud", "amt", "cc_num", F.nullif(F.trim("trans_num"), F.lit("")).alias("trans_num"))


@query("X1", with_views("txn_raw") + _split_sql(0.5, 42, "txn_raw").split(",\nmarked")[0] + """
SELECT l AS is_fraud, part = 'test' AS is_test, CAST(CASE WHEN part = 'test' THEN c - kept ELSE kept END AS BIGINT) AS n
FROM quota JOIN sizes USING (l), (VALUES ('test'), ('train')) AS parts(part)
""")
def split_with_missing_ids(spark, sf_dir):
    marked = sampling.mark_split(_untidy_ids(spark, sf_dir), 0.5, order=HashOrder("trans_num"))
    return marked.groupBy("is_fraud", "is_test").agg(F.count("*").alias("n"))


@query("X2", with_views("txn_raw") + """,
sizes AS (SELECT is_fraud, count(*) AS c FROM txn_raw GROUP BY is_fraud)
SELECT is_fraud, CAST(fold AS INTEGER) AS fold, CAST(c // 10 + CASE WHEN fold < c % 10 THEN 1 ELSE 0 END AS BIGINT) AS n
FROM sizes, range(10) AS folds(fold) WHERE c // 10 + CASE WHEN fold < c % 10 THEN 1 ELSE 0 END > 0
""")
def folds_with_repeated_ids(spark, sf_dir):
    marked = sampling.mark_folds(_untidy_ids(spark, sf_dir), 10, order=HashOrder("cc_num"))
    return marked.groupBy("is_fraud", "fold").agg(F.count("*").alias("n"))


@query("X4 X5", with_views("txn_raw") + "SELECT least(2500, count(*)) AS n, CAST(0 AS BIGINT) AS unknown FROM txn_raw")
def sample_with_repeated_ids(spark, sf_dir):
    """Ids repeat a hundred times or are missing; the sample's size is exact and it holds only rows of the table."""
    rows = _untidy_ids(spark, sf_dir)
    drawn = sampling.take(rows, 2500, HashOrder("cc_num"))
    counted = drawn.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    there = rows.groupBy(*rows.columns).agg(F.count("*").alias("m"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"t.{c}")) for c in rows.columns]
    joined = counted.alias("d").join(there.alias("t"), same, "left")
    return joined.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("m").isNull() | (F.col("n") > F.col("m"))).alias("unknown"))


@query("X3", with_views("txn") + _split_sql(0.2, 42) + """, train AS (SELECT record_id, is_fraud FROM marked WHERE NOT is_test)"""
       + _split_sql(0.1, 43, "train").replace("sizes", "sizes2").replace("shares", "shares2").replace("quota", "quota2")
       .replace("marked", "marked2") + " SELECT record_id, is_fraud, is_test AS is_validation FROM marked2")
def validation_split(spark, sf_dir):
    rows = txn(spark, sf_dir).select("record_id", "is_fraud")
    train, _ = sampling.stratified_split(rows, 0.2, order=ORDER)
    return sampling.mark_split(train, 0.1, order=HashOrder("record_id", 43, "md5"), name="is_validation")


@query("X2", with_views("txn") + f"""
SELECT record_id, is_fraud, CAST(ntile(10) OVER (PARTITION BY is_fraud ORDER BY {_hash()}, record_id) - 1 AS INT) AS fold FROM txn
""")
def stratified_folds(spark, sf_dir):
    return sampling.mark_folds(txn(spark, sf_dir).select("record_id", "is_fraud"), 10, order=ORDER)


@query("X4 X5", with_views("txn") + f" SELECT record_id, amount FROM txn ORDER BY {_hash()}, record_id LIMIT 5000")
def random_sample(spark, sf_dir):
    return sampling.take(txn(spark, sf_dir).select("record_id", "amount"), 5000, ORDER)


@query("X5", with_views("txn") + f" SELECT record_id, amount FROM txn ORDER BY {_hash()}, record_id LIMIT 5000")
def one_pass_sample(spark, sf_dir):
    """The same rows as ``random_sample`` from one pass over the source."""
    return sampling.take_once(txn(spark, sf_dir).select("record_id", "amount"), 5000, ORDER)


@query("X6 J6", with_views("txn") + f""",
sizes AS (SELECT count(*) FILTER (WHERE is_fraud = 0) AS neg, count(*) FILTER (WHERE is_fraud = 1) AS pos FROM txn),
ranked AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY {_hash()}, record_id) AS r FROM txn)
SELECT record_id, is_fraud FROM ranked, sizes
WHERE is_fraud = 1 OR r <= least(neg, floor(greatest(neg * 0.4, pos)))
""")
def downsampled_negatives(spark, sf_dir):
    return sampling.downsample_negatives(txn(spark, sf_dir).select("record_id", "is_fraud"), 0.4, order=ORDER)


@query("X8", with_views("txn") + """,
c AS (SELECT CAST(count(*) FILTER (WHERE is_fraud = 0) AS DOUBLE) AS neg, CAST(count(*) FILTER (WHERE is_fraud = 1) AS DOUBLE) AS pos FROM txn)
SELECT 'scale_pos' AS form, 1.0 AS negative, round(greatest(10, neg / pos), 6) AS positive FROM c
UNION ALL SELECT 'ratio_floor', 1.0, round(greatest(1, neg / pos), 6) FROM c
UNION ALL SELECT 'ratio', 1.0, round(neg / pos, 6) FROM c
UNION ALL SELECT 'balanced', round((neg + pos) / (2 * neg), 6), round((neg + pos) / (2 * pos), 6) FROM c
""")
def class_weight_forms(spark, sf_dir):
    sizes = sampling.stratum_sizes(txn(spark, sf_dir), "is_fraud")
    forms = [(f, sampling.class_weights(f, sizes[0], sizes[1], 10.0)) for f in ("scale_pos", "ratio_floor", "ratio", "balanced")]
    return spark.createDataFrame([(f, round(w[0], 6), round(w[1], 6)) for f, w in forms],
                                 "form string, negative double, positive double")


@query("X8", with_views("txn") + """,
c AS (SELECT is_fraud AS l, count(*) AS n, sum(count(*)) OVER () AS total FROM txn GROUP BY 1)
SELECT record_id, round(total / (2 * n), 6) AS class_weight FROM txn JOIN c ON is_fraud = l
""")
def balanced_row_weights(spark, sf_dir):
    rows = txn(spark, sf_dir).select("record_id", "is_fraud")
    sizes = sampling.stratum_sizes(rows, "is_fraud")
    weighted = sampling.add_class_weight(rows, sampling.class_weights("balanced", sizes[0], sizes[1]))
    return _rounded(weighted, "class_weight").drop("is_fraud")


@query("A9 X1", with_views("txn") + _split_sql(0.2, 42) + """
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS part, count(*) AS samples, CAST(sum(is_fraud) AS BIGINT) AS positives,
  round(avg(is_fraud), 6) AS positive_ratio FROM marked GROUP BY 1
UNION ALL SELECT 'all', count(*), CAST(sum(is_fraud) AS BIGINT), round(avg(is_fraud), 6) FROM txn
""")
def split_statistics(spark, sf_dir):
    rows = txn(spark, sf_dir).select("record_id", "is_fraud")
    return _rounded(profile.split_stats(sampling.mark_split(rows, 0.2, order=ORDER)), "positive_ratio")


@query("A10", with_views("txn") + """
SELECT record_id, epoch_us(transaction_time) AS transaction_time FROM txn ORDER BY transaction_time DESC LIMIT 5000
""")
def most_recent_rows(spark, sf_dir):
    rows = txn(spark, sf_dir).select("record_id", "transaction_time")
    return _micros(sampling.most_recent(rows, 5000, order=ORDER))


@query("A12 F7 X4", with_views("txn") + f""",
complete AS (SELECT * FROM txn WHERE lat IS NOT NULL AND long IS NOT NULL ORDER BY {_hash()}, record_id LIMIT 5000)
SELECT record_id, amount, is_fraud, round(2 * 6371 * asin(sqrt(pow(sin((radians(merchant_lat) - radians(lat)) / 2), 2)
  + cos(radians(lat)) * cos(radians(merchant_lat)) * pow(sin((radians(merchant_long) - radians(long)) / 2), 2))), 4)
  AS customer_merchant_distance_km FROM complete
""")
def amount_distance_sample(spark, sf_dir):
    drawn = profile.amount_distance_sample(txn(spark, sf_dir), 5000, ORDER, "merchant_lat", "merchant_long")
    return _rounded(drawn, "customer_merchant_distance_km", digits=4).select(
        "record_id", "amount", "is_fraud", "customer_merchant_distance_km")


# --- preprocessing --------------------------------------------------------------------------

def _scaled_sql(c: str) -> str:
    return (f"round((coalesce({c}, {c}_m) - avg(coalesce({c}, {c}_m)) OVER ()) / "
            f"coalesce(nullif(stddev_pop(coalesce({c}, {c}_m)) OVER (), 0), 1), 5) AS {c}")


@query("E1 E2", with_views("txn") + """,
m AS (SELECT quantile_cont(amount, 0.5) AS amount_m, quantile_cont(lat, 0.5) AS lat_m, quantile_cont(city_pop, 0.5) AS city_pop_m FROM txn)
SELECT record_id, """ + ", ".join(_scaled_sql(c) for c in ("amount", "lat", "city_pop")) + " FROM txn, m")
def imputed_and_scaled(spark, sf_dir):
    columns = ["amount", "lat", "city_pop"]
    rows = txn(spark, sf_dir).select("record_id", *columns)
    fitted = preprocess.fit(rows, columns, [])
    ready = preprocess.transform(rows, fitted)
    return ready.select("record_id", *[F.round(preprocess.scaled_name(c), 5).alias(c) for c in columns])


@query("E3", with_views("txn") + " UNION ALL ".join(
    f""" SELECT '{c}' AS "column", v AS mode FROM (SELECT {c} AS v, count(*) AS n FROM txn WHERE {c} IS NOT NULL
    GROUP BY {c} ORDER BY n DESC, v LIMIT 1)""" for c in CATEGORICAL_FEATURES))
def most_frequent_values(spark, sf_dir):
    modes = preprocess.fit_modes(profile.value_counts(txn(spark, sf_dir), CATEGORICAL_FEATURES))
    return spark.createDataFrame(list(modes.items()), "column string, mode string")


def _code_sql(c: str) -> str:
    return f"""{c}_codes AS (SELECT v, row_number() OVER (ORDER BY encode(v)) - 1 AS code FROM (
  SELECT DISTINCT {c} AS v FROM txn WHERE {c} IS NOT NULL AND record_id % 2 = 0)),
{c}_mode AS (SELECT {c} AS v FROM txn WHERE {c} IS NOT NULL AND record_id % 2 = 0 GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""


_CODED = ["state", "gender", "merchant"]
_CODE_QUERY = with_views("txn") + ",\n" + ",\n".join(_code_sql(c) for c in _CODED) + "\nSELECT record_id, " + ", ".join(
    f"CAST(coalesce({c}_codes.code, -1) AS DOUBLE) AS {c}_code" for c in _CODED) + " FROM txn " + " ".join(
    f"LEFT JOIN {c}_codes ON {c}_codes.v = coalesce({c}, (SELECT v FROM {c}_mode))" for c in _CODED)


@query("E3 E4 E7", _CODE_QUERY)
def ordinal_codes(spark, sf_dir):
    """Codes fitted on half of the rows, so that the other half holds unseen values."""
    rows = txn(spark, sf_dir).select("record_id", *_CODED)
    fitted = preprocess.fit(rows.filter("record_id % 2 = 0"), [], _CODED)
    return preprocess.transform(rows, fitted).select("record_id", *[preprocess.code_name(c) for c in _CODED])


@query("E3 E4 J2 (codes by join)", _CODE_QUERY)
def ordinal_codes_by_join(spark, sf_dir):
    """The same codes through the code table that serves vocabularies too large for the model."""
    rows = txn(spark, sf_dir).select("record_id", *_CODED)
    fitted = preprocess.fit(rows.filter("record_id % 2 = 0"), [], _CODED, max_labels=0)
    coded = preprocess.encode_by_join(rows, _CODED, fitted.code_table, fitted.modes)
    return coded.select("record_id", *[preprocess.code_name(c) for c in _CODED])


@query("E5 E6 P24", with_views("txn") + f""",
f AS (SELECT record_id, category, city, coalesce(gender, 'unknown') AS gender, amount, lat, ln(1 + city_pop) AS city_pop_log,
  CAST(hour(transaction_time) AS DOUBLE) AS transaction_hour FROM txn),
codes AS (SELECT 'category' AS k, v, row_number() OVER (ORDER BY encode(v)) - 1 AS code FROM (SELECT DISTINCT category AS v FROM f WHERE category IS NOT NULL)
  UNION ALL SELECT 'gender', v, row_number() OVER (ORDER BY encode(v)) - 1 FROM (SELECT DISTINCT gender AS v FROM f)
  UNION ALL SELECT 'city', v, row_number() OVER (ORDER BY encode(v)) - 1 FROM (SELECT DISTINCT city AS v FROM f WHERE city IS NOT NULL)),
mode AS (SELECT city AS v FROM f WHERE city IS NOT NULL GROUP BY city ORDER BY count(*) DESC, city LIMIT 1),
m AS (SELECT quantile_cont(amount, 0.5) AS amount_m, quantile_cont(lat, 0.5) AS lat_m, quantile_cont(city_pop_log, 0.5) AS city_pop_log_m,
  quantile_cont(transaction_hour, 0.5) AS transaction_hour_m FROM f)
SELECT record_id, {", ".join(_scaled_sql(c).replace(f"AS {c}", f"AS f{i}") for i, c in enumerate(("amount", "lat", "transaction_hour", "city_pop_log")))},
  CAST(a.code AS DOUBLE) AS f4, CAST(b.code AS DOUBLE) AS f5, CAST(d.code AS DOUBLE) AS f6
FROM f LEFT JOIN codes a ON a.k = 'category' AND a.v = f.category LEFT JOIN codes b ON b.k = 'gender' AND b.v = f.gender
LEFT JOIN codes d ON d.k = 'city' AND d.v = coalesce(f.city, (SELECT v FROM mode)), m
""")
def feature_vectors(spark, sf_dir):
    numeric, categorical = ["amount", "lat", "transaction_hour", "city_pop_log"], ["category", "gender", "city"]
    rows = training.training_rows(txn(spark, sf_dir)).select("record_id", *numeric, *categorical)
    rows = materialise(rows, "rows")
    ready = preprocess.transform(rows, preprocess.fit(rows, numeric, categorical))
    vector = vector_to_array("features")
    return ready.select("record_id", *[F.round(vector[i], 5).alias(f"f{i}") for i in range(7)])


_FOLD_NUMERIC, _FOLD_CATEGORICAL = ["amount", "lat", "city_pop"], ["category", "city", "state"]


@query("E1 E2 E3 E4 E5 M13", with_views("txn") + f""",
t AS (SELECT *, {_hash()} % 5 AS f FROM txn),
p AS (SELECT model, t.* FROM (VALUES (0), (1), (2), (3), (4), (5)) m(model) JOIN t ON f <> model),
""" + ",\n".join(f"""{c}_m AS (SELECT model, quantile_cont({c}, 0.5) AS median FROM p GROUP BY 1),
{c}_s AS (SELECT model, '{c}' AS "column", any_value(median) AS median, avg(coalesce({c}, median)) AS mean, stddev_pop(coalesce({c}, median)) AS deviation
  FROM p JOIN {c}_m USING (model) GROUP BY 1)""" for c in _FOLD_NUMERIC) + ",\n" + ",\n".join(
    f"""{c}_c AS (SELECT model, '{c}' AS "column", {c} AS v, count(*) AS n FROM p WHERE {c} IS NOT NULL GROUP BY 1, 2, 3),
{c}_w AS (SELECT model, "column", count(*) AS words, arg_min(v, (-n, v)) AS mode FROM {c}_c GROUP BY 1, 2)""" for c in _FOLD_CATEGORICAL) + """
""" + " UNION ALL ".join(f"""SELECT model, "column", round(median, 6) AS median, round(mean, 6) AS mean, round(deviation, 5) AS deviation,
  CAST(NULL AS VARCHAR) AS mode, CAST(NULL AS BIGINT) AS words FROM {c}_s""" for c in _FOLD_NUMERIC) + " UNION ALL " + " UNION ALL ".join(
    f"""SELECT model, "column", NULL, NULL, NULL, mode, words FROM {c}_w""" for c in _FOLD_CATEGORICAL))
def fold_preprocessing(spark, sf_dir):
    """What the rows outside each of five folds, and all rows (model 5), teach, from the passes of one fit."""
    fold = F.pmod(hashing.order_hash(F.col("record_id"), 42, "md5"), F.lit(5)).alias("fold")
    rows = materialise(txn(spark, sf_dir).select(*_FOLD_NUMERIC, *_FOLD_CATEGORICAL, fold), "rows")
    out = []
    for m, f in enumerate(foldstats.fit_folds(rows, _FOLD_NUMERIC, _FOLD_CATEGORICAL, "fold", 5)):
        out += [(m, c, float(f.medians[c]), float(f.means[c]), float(f.deviations[c]), None, None) for c in f.numeric]
        out += [(m, c, None, None, None, f.modes[c], len(f.labels[c])) for c in f.categorical]
    found = spark.createDataFrame(out, "model int, `column` string, median double, mean double, deviation double, mode string, words bigint")
    return _rounded(_rounded(found, "median", "mean"), "deviation", digits=5)


_TARGETS = ["category", "city"]
_BEFORE = "OVER (PARTITION BY {c} ORDER BY h, CAST(record_id AS VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


@query("M2 E6", with_views("txn") + f""",
t AS (SELECT *, {_hash()} AS h FROM txn)
SELECT record_id, """ + ", ".join(f"""round(CASE WHEN {c} IS NULL THEN 0.5 ELSE (coalesce(sum(is_fraud) {_BEFORE.format(c=c)}, 0) + 0.5)
  / (count(is_fraud) {_BEFORE.format(c=c)} + 1) END, 9) AS {c}_code""" for c in _TARGETS) + " FROM t")
def ordered_target_statistics(spark, sf_dir):
    """The label's smoothed mean over the rows of the same category that come before in the hash order."""
    rows = materialise(txn(spark, sf_dir).select("record_id", *_TARGETS, "is_fraud"), "rows")
    codes = [preprocess.code_name(c) for c in _TARGETS]
    return _rounded(ordered.ordered_statistics(rows, _TARGETS, "is_fraud", ORDER), *codes, digits=9).select("record_id", *codes)


@query("M2 E6 J2", with_views("txn") + """,
past AS (SELECT * FROM txn WHERE transaction_time < TIMESTAMP '2024-01-16'),
""" + ",\n".join(f"{c}_s AS (SELECT {c} AS v, (sum(is_fraud) + 0.5) / (count(is_fraud) + 1) AS code FROM past WHERE {c} IS NOT NULL GROUP BY 1)"
                  for c in _TARGETS) + """
SELECT record_id, """ + ", ".join(f"round(coalesce({c}_s.code, 0.5), 9) AS {c}_code" for c in _TARGETS)
       + " FROM txn " + " ".join(f"LEFT JOIN {c}_s ON {c}_s.v = txn.{c}" for c in _TARGETS))
def target_statistics_of_the_past(spark, sf_dir):
    """Every row with the statistic that the rows before one day have left."""
    rows = txn(spark, sf_dir)
    past = rows.filter("transaction_time < TIMESTAMP '2024-01-16'")
    table = materialise(ordered.target_statistics(past, _TARGETS, "is_fraud"), "statistics")
    codes = [preprocess.code_name(c) for c in _TARGETS]
    found = preprocess.encode_by_join(rows.select("record_id", *_TARGETS), _TARGETS, table, unseen=ordered.PRIOR)
    return _rounded(found, *codes, digits=9).select("record_id", *codes)


# --- metrics --------------------------------------------------------------------------------

_CURVE = """,
g AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY score),
curve AS (SELECT score AS threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g WINDOW w AS (ORDER BY score DESC))"""
_FOLD_CURVE = """,
g AS (SELECT fold, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY fold, score),
curve AS (SELECT fold, score AS threshold, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  sum(pos) OVER (PARTITION BY fold) AS p, sum(neg) OVER (PARTITION BY fold) AS n FROM g
  WINDOW w AS (PARTITION BY fold ORDER BY score DESC)),
points AS (SELECT *, tp / (tp + fp) AS prec, tp / p AS rec FROM curve)"""


@query("V1", with_views("scored") + _CURVE + """
SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM curve
UNION ALL SELECT NULL, 1.0, 0.0
""")
def precision_recall_curve(spark, sf_dir):
    return _rounded(metrics.precision_recall_curve(scored(spark, sf_dir)), "precision", "recall")


_GAPS = with_views("scored").replace("scored AS", "all_scored AS") + """,
scored AS (SELECT * REPLACE (CASE WHEN record_id % 7 = 0 THEN -1.0 ELSE score END AS score) FROM all_scored)"""


def _scored_with_gaps(spark, sf_dir) -> DataFrame:
    return scored(spark, sf_dir).withColumn("score", F.when(F.col("record_id") % 7 != 0, F.col("score")))


@query("V2 (missing scores)", _GAPS + _CURVE + " SELECT round(sum(pos / p * tp / (tp + fp)), 6) AS avg_precision FROM curve")
def average_precision_with_missing_scores(spark, sf_dir):
    return _rounded(metrics.average_precision(_scored_with_gaps(spark, sf_dir)), "avg_precision")


@query("V4 V5 V6 (missing scores)", _GAPS + """
SELECT CAST(sum(label) FILTER (WHERE score >= 0.3) AS BIGINT) AS tp, count(*) FILTER (WHERE score >= 0.3 AND label = 0) AS fp,
  CAST(sum(label) FILTER (WHERE score < 0.3) AS BIGINT) AS fn, count(*) FILTER (WHERE score < 0.3 AND label = 0) AS tn FROM scored
""")
def confusion_with_missing_scores(spark, sf_dir):
    return metrics.threshold_metrics(_scored_with_gaps(spark, sf_dir), 0.3).select("tp", "fp", "fn", "tn")


@query("V2", with_views("scored") + _CURVE + " SELECT round(sum(pos / p * tp / (tp + fp)), 6) AS avg_precision FROM curve")
def average_precision(spark, sf_dir):
    return _rounded(metrics.average_precision(scored(spark, sf_dir)), "avg_precision")


@query("V3", with_views("scored") + _CURVE + " SELECT round(sum(neg * (tp - pos / 2)) / max(p * n), 6) AS roc_auc FROM curve")
def roc_auc(spark, sf_dir):
    return _rounded(metrics.roc_auc(scored(spark, sf_dir)), "roc_auc")


_COUNTS = """,
k AS (SELECT count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
  count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn FROM scored)"""


@query("V4 V5 U2", with_views("scored") + _COUNTS + """
SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(5 * tp / (5 * tp + 4 * fn + fp), 6) AS f_beta FROM k
""")
def metrics_at_threshold(spark, sf_dir):
    return _rounded(metrics.threshold_metrics(scored(spark, sf_dir), 0.5), "precision", "recall", "f1", "f_beta")


@query("V6", with_views("scored") + _COUNTS + """
SELECT 0 AS label, 0 AS prediction, tn AS count FROM k UNION ALL SELECT 0, 1, fp FROM k
UNION ALL SELECT 1, 0, fn FROM k UNION ALL SELECT 1, 1, tp FROM k
""")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored(spark, sf_dir), 0.5)


@query("V7", with_views("scored") + _FOLD_CURVE + """,
best AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY prec DESC, threshold) AS r FROM points WHERE rec >= 0.9)
SELECT fold, threshold AS decision_threshold, round(prec, 6) AS threshold_precision_at_target,
  round(rec, 6) AS threshold_recall_at_target FROM best WHERE r = 1
""")
def threshold_at_recall(spark, sf_dir):
    found = metrics.threshold_at_recall(scored(spark, sf_dir), 0.9, by=["fold"])
    return _rounded(found, "threshold_precision_at_target", "threshold_recall_at_target")


@query("V8", with_views("scored") + _CURVE + """
SELECT threshold AS decision_threshold, round(2 * tp / (tp + fp + p), 6) AS f1 FROM curve ORDER BY 2 * tp / (tp + fp + p) DESC, threshold LIMIT 1
""")
def threshold_at_best_f1(spark, sf_dir):
    return _rounded(metrics.threshold_at_best_f1(scored(spark, sf_dir)), "f1")


_FOLD_METRICS = _FOLD_CURVE + """,
best AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY prec DESC, threshold) AS r FROM points WHERE rec >= 0.9),
free AS (SELECT fold, sum(pos / p * prec) AS avg_precision, sum(neg * (tp - pos / 2)) / max(p * n) AS roc_auc FROM points GROUP BY fold),
folds AS (SELECT free.fold, avg_precision, roc_auc, prec, rec, 2 * prec * rec / (prec + rec) AS f1, threshold
  FROM free JOIN best ON free.fold = best.fold AND r = 1)"""


@query("V2 V3 V4 V7 M13", with_views("scored") + _FOLD_METRICS + """
SELECT fold, round(avg_precision, 6) AS avg_precision, round(roc_auc, 6) AS roc_auc, round(prec, 6) AS precision,
  round(rec, 6) AS recall, round(f1, 6) AS f1, threshold AS decision_threshold FROM folds
""")
def fold_metrics(spark, sf_dir):
    found = metrics.evaluate(scored(spark, sf_dir), target=0.9, by=["fold"])
    return _rounded(found, "avg_precision", "roc_auc", "precision", "recall", "f1").drop(
        "threshold_precision_at_target", "threshold_recall_at_target")


@query("V9", with_views("scored") + _FOLD_METRICS + " " + " UNION ALL ".join(
    f"SELECT '{n}' AS metric, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM folds" for n, c in (
        ("avg_precision", "avg_precision"), ("roc_auc", "roc_auc"), ("precision", "prec"), ("recall", "rec"), ("f1", "f1"),
        ("decision_threshold", "threshold"), ("threshold_precision_at_target", "prec"), ("threshold_recall_at_target", "rec"))))
def cross_validation_summary(spark, sf_dir):
    found = metrics.evaluate(scored(spark, sf_dir), target=0.9, by=["fold"])
    return _rounded(metrics.cv_summary(metrics.to_long(found, ["fold"])), "mean", "std")


@query("V10", with_views("scored") + _FOLD_METRICS + """
SELECT fold, round(avg_precision, 6) AS avg_precision FROM folds ORDER BY avg_precision DESC, fold LIMIT 1
""")
def best_fold(spark, sf_dir):
    found = metrics.evaluate(scored(spark, sf_dir), target=0.9, by=["fold"])
    return _rounded(metrics.best_candidate(found, "avg_precision", "fold"), "avg_precision").select("fold", "avg_precision")


# --- vectorised scoring of foreign models ---------------------------------------------------

def fixed_logistic():
    """A hand-set logistic model with the ``predict_proba`` interface.

    The class is local, so it is shipped by value and executors need no copy of this package.
    """
    class FixedLogistic:
        def predict_proba(self, frame: pd.DataFrame) -> np.ndarray:
            risky = frame["merchant"].isin(["QuickCash", "GlobalDigital", "FastMoneyX"])
            p = 1 / (1 + np.exp(-(-4 + 0.02 * frame["amount"] + 0.1 * frame["is_night"] + 2 * risky)))
            return np.column_stack([1 - p, p])

    return FixedLogistic()


_FIXED_FEATURES = ["amount", "is_night", "merchant"]
_FIXED_SQL = with_views("txn") + """,
s AS (SELECT record_id, 1 / (1 + exp(-(-4 + 0.02 * amount
    + 0.1 * CASE WHEN hour(transaction_time) >= 22 OR hour(transaction_time) < 5 THEN 1 ELSE 0 END
    + 2 * CASE WHEN merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') THEN 1 ELSE 0 END))) AS p FROM txn)
SELECT record_id, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction, round(p, 6) AS fraud_probability FROM s"""


@query("U1 U2 U3 E8", _FIXED_SQL)
def foreign_model_scores(spark, sf_dir):
    score = scoring.foreign_scorer(spark, fixed_logistic(), _FIXED_FEATURES)
    rows = features.add_calendar_flags(txn(spark, sf_dir)).select("record_id", *_FIXED_FEATURES)
    return _rounded(score(rows), "fraud_probability").select("record_id", "prediction", "fraud_probability")


# --- streaming ------------------------------------------------------------------------------

def _drained(spark, df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    stream_scoring.run_once(df, path, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(df.schema).parquet(path)


@query("S2 T1 T2 T4 F5 F6 F8 F9", with_views("txn") + _SERVING_SQL)
def streamed_features(spark, sf_dir):
    source = messages.stream_messages(spark, _message_folder(spark, sf_dir))
    return _served(_drained(spark, stream_scoring.features(source), "features"))


@query("S2 S7 T1 T3 T4 U1 U2 U3 F14", _FIXED_SQL)
def streamed_scores(spark, sf_dir):
    """Messages in, scored messages out as JSON, read back from the output folder."""
    rows = stream_scoring.features(messages.stream_messages(spark, _message_folder(spark, sf_dir)))
    out = scoring.foreign_scorer(spark, fixed_logistic(), _FIXED_FEATURES)(rows)
    sink = {"path": scratch_path(spark, "predictions")}
    envelope = messages.to_envelope(out)
    messages.stream_sink(envelope, sink, scratch_path(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    read = messages.read_messages(spark, sink)
    parsed = read.select(F.from_json("value", "record_id bigint, prediction int, fraud_probability double").alias("d")).select("d.*")
    return _rounded(parsed, "fraud_probability")


@query("T5 T1", with_views("txn") + " SELECT record_id, transaction_id, amount FROM txn")
def streamed_distinct(spark, sf_dir):
    """Every message is delivered twice; each transaction comes out once."""
    once = messages.read_messages(spark, _message_folder(spark, sf_dir))
    config = {"path": scratch_path(spark, "topic")}
    messages.publish(once.unionByName(once), config)
    source = stream_scoring.transactions(messages.stream_messages(spark, config))
    rows = stream_scoring.distinct_transactions(source).select("record_id", "transaction_id", "amount")
    return _drained(spark, rows, "distinct")


@query("T5 T1", with_views("txn") + """,
split AS (SELECT *, record_id % 4 = 3 AS second FROM txn),
edge AS (SELECT max(transaction_time) - INTERVAL 24 HOURS AS w FROM split WHERE NOT second)
SELECT record_id, second AND transaction_time < w AS is_late FROM split, edge
""")
def late_transactions(spark, sf_dir):
    """Two deliveries; rows of the second one that fall behind the first one's watermark are set apart."""
    folder = scratch_path(spark, "deliveries")
    rows = txn(spark, sf_dir).select("record_id", "transaction_time")
    router = stream_history.LateRouter(*[scratch_path(spark, n) for n in ("on-time", "late", "clock")])
    checkpoint = scratch_path(spark, "checkpoint")
    for second in (False, True):
        rows.filter((F.col("record_id") % 4 == 3) == second).write.mode("append").parquet(folder)
        router.start(spark.readStream.schema(rows.schema).parquet(folder), checkpoint, once=True).awaitTermination()
    on_time = spark.read.parquet(router.on_time).select("record_id", F.lit(False).alias("is_late"))
    return on_time.unionByName(spark.read.parquet(router.late).select("record_id", F.lit(True).alias("is_late")))


@query("T6 W1 W2 W3 W5", _BEHAVIOUR_SQL)
def streamed_history(spark, sf_dir):
    """Rows arrive in two deliveries by time; each row sees its card's past across deliveries."""
    return _delivered(spark, _history_rows(spark, sf_dir))


@query("T6", with_views("txn").replace("txn AS", "all_txn AS") + """,
txn AS (SELECT * REPLACE (CASE WHEN record_id % 13 = 0 THEN NULL ELSE amount END AS amount,
  CASE WHEN transaction_time >= TIMESTAMP '2024-01-16 12:00:00' THEN transaction_time + INTERVAL 45 DAYS ELSE transaction_time END
  AS transaction_time) FROM all_txn)""" + _BEHAVIOUR_SQL.removeprefix(with_views("txn")))
def streamed_history_with_gaps(spark, sf_dir):
    """The second delivery is 45 days younger, and some amounts are missing."""
    noon = F.lit("2024-01-16 12:00:00").cast("timestamp")
    rows = _history_rows(spark, sf_dir).withColumns({
        "amount": F.when(F.col("record_id") % 13 != 0, F.col("amount")),
        "transaction_time": F.when(F.col("transaction_time") >= noon, F.col("transaction_time") + F.expr("INTERVAL 45 DAYS")).otherwise(
            F.col("transaction_time"))})
    return _delivered(spark, rows)


def _busy(rows: DataFrame) -> DataFrame:
    """A third of the rows belongs to one card."""
    return rows.withColumn("card_number", F.when(F.col("record_id") % 3 == 0, F.lit("busy")).otherwise(F.col("card_number")))


@query("T6 T1 W1 W3 W4 W5", with_views("txn").replace("txn AS", "all_txn AS") + f""",
txn AS (SELECT * REPLACE (CASE WHEN record_id % 3 = 0 THEN 'busy' ELSE card_number END AS card_number) FROM all_txn),
seen AS (SELECT *, {_LAST} AS last FROM txn)
SELECT record_id, count(amount) {_DAY_FRAME} AS user_activity_24h, count(amount) {_WEEK_FRAME} AS txn_count_7d,
  round(sum(amount) {_WEEK_FRAME}, 6) AS amount_sum_7d,
  round(round(sum(amount) {_WEEK_FRAME}, 6) / nullif(count(amount) {_WEEK_FRAME}, 0), 9) AS rolling_avg_7d,
  CASE WHEN last >= date_trunc('day', transaction_time) - INTERVAL 7 DAYS
    THEN round((epoch_us(transaction_time) - epoch_us(last)) / 1000000, 6) END AS time_since_last_txn FROM seen""")
def keyed_state_history(spark, sf_dir):
    """Three deliveries by time, each a restart from the checkpoint; the past is in keyed state, a third of it in one card's."""
    rows, folder, out, checkpoint = _busy(_history_rows(spark, sf_dir)), *(scratch_path(spark, n) for n in ("deliveries", "keyed", "checkpoint"))
    edges = [F.lit(f"2024-01-{d} 12:00:00").cast("timestamp") for d in (11, 21)]
    time = F.col("transaction_time")
    for part in (time < edges[0], (time >= edges[0]) & (time < edges[1]), time >= edges[1]):
        rows.filter(part).write.mode("append").parquet(folder)
        source = spark.readStream.schema(rows.schema).parquet(folder)
        stream_scoring.run_once(stream_state.keyed_history(source, history.Entity()), out, checkpoint)
    # The mean of the rounded sum: a mean of cents can end in a 5, where the order of adding would decide.
    found = _rounded(spark.read.parquet(out), "time_since_last_txn", "amount_sum_7d")
    found = found.withColumn("rolling_avg_7d", F.try_divide("amount_sum_7d", "txn_count_7d"))
    found = found.withColumn("record_id", F.substring("transaction_id", 2, 20).cast("bigint"))
    return _rounded(found, "rolling_avg_7d", digits=9).select("record_id", *stream_state.COLUMNS)


def _delivered(spark, rows: DataFrame) -> DataFrame:
    folder = scratch_path(spark, "deliveries")
    stream = stream_history.HistoryStream(scratch_path(spark, "store"), scratch_path(spark, "enriched"))
    checkpoint = scratch_path(spark, "checkpoint")
    noon = F.lit("2024-01-16 12:00:00").cast("timestamp")
    for part in (F.col("transaction_time") < noon, F.col("transaction_time") >= noon):
        rows.filter(part).write.mode("append").parquet(folder)
        stream.start(spark.readStream.schema(rows.schema).parquet(folder), checkpoint, once=True).awaitTermination()
    found = spark.read.parquet(stream.output)
    return _behaviour(found.withColumn("record_id", F.substring("transaction_id", 2, 20).cast("bigint")))


@query("T7 J4", with_views("txn") + """,
p AS (SELECT card_number AS k, count(amount) AS txn_count, avg(amount) AS amount_avg, max(transaction_time) AS last_time
  FROM txn WHERE transaction_time < TIMESTAMP '2024-01-16' GROUP BY 1)
SELECT record_id, txn_count, round(amount_avg, 9) AS amount_avg, epoch_us(last_time) AS last_time FROM txn LEFT JOIN p ON card_number = k
""")
def streamed_profile_join(spark, sf_dir):
    past = txn(spark, sf_dir).filter("transaction_time < TIMESTAMP '2024-01-16'")
    daily = history.user_profile(past)
    card = materialise(history.merge_profile(daily), "profile")
    source = stream_scoring.transactions(messages.stream_messages(spark, _message_folder(spark, sf_dir)))
    rows = stream_scoring.join_profile(source, card).select("record_id", "txn_count", "amount_avg", "last_time")
    return _micros(_rounded(_drained(spark, rows, "profiled"), "amount_avg", digits=9), "last_time")


_PROFILE_DAYS = ("2024-01-11", "2024-01-21")


@query("T7 J4", with_views("txn") + f""",
parts AS (SELECT *, (transaction_time >= TIMESTAMP '{_PROFILE_DAYS[0]}')::INT + (transaction_time >= TIMESTAMP '{_PROFILE_DAYS[1]}')::INT AS part FROM txn),
p AS (SELECT s.part, c.card_number AS k, count(c.amount) AS txn_count, round(sum(c.amount), 6) AS amount_sum, max(c.transaction_time) AS last_time
  FROM (VALUES (1), (2)) s(part) JOIN parts c ON c.part < s.part GROUP BY 1, 2)
SELECT record_id, CAST(parts.part - 1 AS BIGINT) AS version, txn_count, amount_sum, epoch_us(last_time) AS last_time
FROM parts LEFT JOIN p ON parts.part = p.part AND card_number = k""")
def versioned_profile_join(spark, sf_dir):
    """Three deliveries by day to one running stream; before the second and the third a profile of all earlier rows is published."""
    rows, folder = _history_rows(spark, sf_dir), scratch_path(spark, "deliveries")
    store = stream_profiles.ProfileStore(scratch_path(spark, "profiles"))
    join = stream_profiles.ProfileJoin(store, scratch_path(spark, "profiled"), scratch_path(spark, "used"),
                                       "card_number string, txn_count long, amount_sum double, last_time timestamp")
    edges, time = [F.lit(d).cast("timestamp") for d in _PROFILE_DAYS], F.col("transaction_time")
    parts = (time < edges[0], (time >= edges[0]) & (time < edges[1]), time >= edges[1])
    rows.limit(0).write.parquet(folder)
    running = join.start(spark.readStream.schema(rows.schema).parquet(folder), scratch_path(spark, "checkpoint"))
    try:
        for n, part in enumerate(parts):
            if n:
                past = history.merge_profile(history.user_profile(rows.filter(time < edges[n - 1])))
                store.publish(past.select("card_number", "txn_count", "amount_sum", "last_time"))
            rows.filter(part).write.mode("append").parquet(folder)
            running.processAllAvailable()
    finally:
        running.stop()
    found = spark.read.parquet(join.output)
    return _micros(_rounded(found, "amount_sum"), "last_time").select("record_id", "version", "txn_count", "amount_sum", "last_time")


@query("T8 A8", with_views("txn") + """,
h AS (SELECT date_trunc('hour', transaction_time) AS t, count(*) AS transactions, avg(is_fraud) AS r FROM txn GROUP BY 1)
SELECT epoch_us(t) AS window_start, transactions, round(r, 6) AS fraud_rate FROM h
WHERE t + INTERVAL 1 HOUR <= (SELECT max(transaction_time) FROM txn) - INTERVAL 24 HOURS
""")
def streamed_hourly_rates(spark, sf_dir):
    """Windows that the watermark has closed."""
    source = stream_scoring.transactions(messages.stream_messages(spark, _message_folder(spark, sf_dir)))
    closed = _drained(spark, stream_scoring.hourly_monitor(source), "hourly")
    return _micros(_rounded(closed, "fraud_rate"), "window_start")


# --- models (no SQL equivalent) -------------------------------------------------------------
# Small budgets: the settings of the families are far larger. All rows are used.

def _facts_sql(folds: int | None = 10, held_out: bool = True, negative_ratio: float | None = None) -> str:
    """What SQL can say about a training: how many rows each part has, and what must not happen."""
    k = "kept" if held_out else "c"
    negatives = (f"least({k}, floor(greatest({k} * {negative_ratio}, (SELECT {k} FROM quota JOIN sizes USING (l) WHERE l = 1))))"
                 if negative_ratio else k)
    out = with_views("txn") + _split_sql(0.2, 666).split(",\nmarked")[0].replace("kept FROM shares", "kept FROM shares") + f""",
used AS (SELECT l, CASE WHEN l = 0 THEN {negatives} ELSE {k} END AS n FROM quota JOIN sizes USING (l))
SELECT 'scored_rows' AS fact, count(*) AS n FROM txn UNION ALL SELECT 'wrong_decisions', 0 UNION ALL SELECT 'outside_0_1', 0
UNION ALL SELECT 'metrics_outside_0_1', 0"""
    if folds:
        out += f"""
UNION ALL SELECT 'out_of_fold_rows', CAST(sum(n) AS BIGINT) FROM used
UNION ALL SELECT 'out_of_fold_positives', CAST(sum(n) AS BIGINT) FROM used WHERE l = 1
UNION ALL SELECT 'folds', {folds} UNION ALL SELECT 'scored_twice_out_of_fold', 0 UNION ALL SELECT 'outside_0_1_out_of_fold', 0"""
    return out


_LIFT = " UNION ALL SELECT 'folds_without_lift', 0"


def _folds_without_lift(trained, lift: float = 5) -> int:
    """Folds whose held-out average precision is below ``lift`` times the share of positives, which no constant model reaches."""
    precision = trained.fold_metrics.filter("metric = 'avg_precision'").select("fold", "value")
    rates = trained.fold_scores.groupBy("fold").agg(F.avg("label").alias("rate"))
    return rates.join(precision, "fold", "left").filter(~(F.coalesce("value", F.lit(0.0)) >= lift * F.col("rate"))).count()


def _facts(spark, sf_dir, name: str, params: dict | None = None, lift: bool = False, second_order: bool = False, **settings) -> DataFrame:
    """Trains a family and states what SQL can check (see ``_facts_sql``) as (fact, n)."""
    rows, spec = txn(spark, sf_dir), models.family(name)
    if second_order:
        return _side_by_side_facts(spark, rows, spec, training.boosted_folds(rows, name, params, settings))
    trained = training.train(rows, name, params, settings)
    p = F.col("fraud_probability")
    table = materialise(training.rows_for(rows, spec, settings), "features")
    scored_rows = trained.model.score(table)
    facts = dict(scored_rows.agg(
        F.count("*").alias("scored_rows"), F.count_if(F.col("prediction") != (p >= trained.model.threshold).cast("int")).alias("wrong_decisions"),
        F.count_if(~p.between(0, 1)).alias("outside_0_1")).first().asDict())
    shares = ("avg_precision", "roc_auc", "precision", "recall", "f1", "f2", "decision_threshold")
    facts["metrics_outside_0_1"] = sum(
        not 0 <= v <= 1 for k, v in trained.metrics.items() if v is not None and k.removesuffix("_mean").endswith(shares))
    if trained.fold_scores is not None:
        found = trained.fold_scores.agg(
            F.count("*").alias("rows"), F.sum("label").alias("positives"), F.count_distinct("fold").alias("folds"),
            F.count_distinct("transaction_id").alias("ids"), F.count_if(~F.col("score").between(0, 1)).alias("outside")).first()
        facts |= {"out_of_fold_rows": found["rows"], "out_of_fold_positives": int(found["positives"]), "folds": found["folds"],
                  "scored_twice_out_of_fold": found["rows"] - found["ids"], "outside_0_1_out_of_fold": found["outside"]}
    if lift:
        facts["folds_without_lift"] = _folds_without_lift(trained)
    return spark.createDataFrame([(k, int(v)) for k, v in facts.items()], "fact string, n bigint")


@query("M6 M13 M14 M18 X8 E5 S10", _facts_sql(held_out=False))
def decision_tree_training(spark, sf_dir):
    return _facts(spark, sf_dir, "decision_tree")


@query("M5 M13 M14 X6 X8 V7", _facts_sql(negative_ratio=0.4))
def logistic_training(spark, sf_dir):
    return _facts(spark, sf_dir, "logistic")


@query("M1 M11 M12 M13 M14 X3 X8 F11 V7 V9", _facts_sql())
def xgboost_training(spark, sf_dir):
    """The whole road: selection, ten folds with early stopping, final fit, mean threshold."""
    return _facts(spark, sf_dir, "xgboost")


def _side_by_side_facts(spark, rows: DataFrame, spec, trained) -> DataFrame:
    """The facts of ``_facts`` and ``_LIFT`` for models of all folds that were trained at once."""
    facts = trained.fold_scores.agg(
        F.count("*").alias("out_of_fold_rows"), F.sum("label").alias("out_of_fold_positives"), F.count_distinct("fold").alias("folds"),
        (F.count("*") - F.count_distinct("transaction_id")).alias("scored_twice_out_of_fold"),
        F.count_if(~F.col("score").between(0, 1)).alias("outside_0_1_out_of_fold")).first().asDict()
    facts["folds_without_lift"] = _folds_without_lift(trained)
    shares = ("avg_precision", "roc_auc", "precision", "recall", "f1", "f2", "decision_threshold")
    facts["metrics_outside_0_1"] = sum(
        not 0 <= v <= 1 for k, v in trained.metrics.items() if v is not None and k.removesuffix("_mean").endswith(shares))
    coded = training.with_codes(training.rows_for(rows, spec), trained.codes)
    threshold = trained.metrics["decision_threshold"]
    scored = trained.model.score(coded).withColumn("prediction", (F.col("score") >= threshold).cast("int"))
    facts |= scored.agg(F.count("*").alias("scored_rows"), F.count_if(F.col("prediction") != (F.col("score") >= threshold).cast("int")).alias("wrong_decisions"),
                        F.count_if(~F.col("score").between(0, 1)).alias("outside_0_1")).first().asDict()
    return spark.createDataFrame([(k, int(v)) for k, v in facts.items()], "fact string, n bigint")


@query("M1 M4 M12 M13 M14 E4 V7 V9", _facts_sql() + _LIFT)
def boosted_training(spark, sf_dir):
    """Second-order boosting at the family's settings, ten folds and all rows in one sequence of passes; each fold's held-out average
    precision is several times the share of positives, which no constant model reaches."""
    return _facts(spark, sf_dir, "xgboost", second_order=True)


@query("M2 M12 M14", _facts_sql(folds=None))
def catboost_training(spark, sf_dir):
    return _facts(spark, sf_dir, "catboost", n_folds=None)


@query("M3", _facts_sql(folds=None))
def lightgbm_training(spark, sf_dir):
    return _facts(spark, sf_dir, "lightgbm", n_folds=None)


@query("M4", _facts_sql(folds=None))
def tabnet_training(spark, sf_dir):
    return _facts(spark, sf_dir, "tabnet", n_folds=None)


@query("M7", _facts_sql(folds=None))
def extra_tree_training(spark, sf_dir):
    return _facts(spark, sf_dir, "extra_tree", n_folds=None)


@query("M8 F12", _facts_sql(folds=None))
def random_forest_training(spark, sf_dir):
    return _facts(spark, sf_dir, "random_forest", n_folds=None)


@query("M9", _facts_sql(folds=None))
def mlp_training(spark, sf_dir):
    return _facts(spark, sf_dir, "mlp", n_folds=None)


# The same families at all their own settings, ten folds included.

@query("M2 M12 M13 M14 V7", _facts_sql())
def catboost_folds_training(spark, sf_dir):
    return _facts(spark, sf_dir, "catboost")


@query("M2 E6 M11 M12 M13 M14 V7", _facts_sql() + _LIFT)
def catboost_ordered_training(spark, sf_dir):
    """The same with ordered target statistics in place of codes."""
    return _facts(spark, sf_dir, "catboost", lift=True, ordered=True)


@query("M3 M13", _facts_sql())
def lightgbm_folds_training(spark, sf_dir):
    return _facts(spark, sf_dir, "lightgbm")


@query("M4 M13", _facts_sql())
def tabnet_folds_training(spark, sf_dir):
    return _facts(spark, sf_dir, "tabnet")


@query("M7 M13", _facts_sql(held_out=False))
def extra_tree_folds_training(spark, sf_dir):
    return _facts(spark, sf_dir, "extra_tree")


@query("M8 M13 F12", _facts_sql())
def random_forest_folds_training(spark, sf_dir):
    return _facts(spark, sf_dir, "random_forest")


@query("M9 M13", _facts_sql(held_out=False))
def mlp_folds_training(spark, sf_dir):
    return _facts(spark, sf_dir, "mlp")


@query("M10 V8 E7 M13", _facts_sql(folds=3))
def behaviour_training(spark, sf_dir):
    return _facts(spark, sf_dir, "behaviour")


@query("M11 V11", "SELECT 18 AS features, CAST(0 AS BIGINT) AS negative, CAST(1 AS DOUBLE) AS total, true AS largest_first")
def feature_importances(spark, sf_dir):
    spec = models.family("xgboost")
    rows = materialise(training.training_rows(txn(spark, sf_dir)).select(*spec.numeric, *spec.categorical, "is_fraud"), "rows")
    _, table = training.select_features(rows, spec, spec.params, spec.settings, 666)
    found = [r["importance"] for r in table.collect()]           # one row per feature
    return table.agg(F.count_distinct("feature").cast("int").alias("features"), F.count_if(F.col("importance") < 0).alias("negative"),
                     F.round(F.sum("importance"), 6).alias("total")).withColumn("largest_first", F.lit(found == sorted(found, reverse=True)))


def _candidates_sql(candidates: list[dict]) -> str:
    rows = [f"""SELECT {n} AS candidate, '{json.dumps(c).replace("'", "''")}' AS params, true AS mean_in_0_1, true AS std_is_positive"""
            for n, c in enumerate(candidates, start=1)]
    return " UNION ALL ".join(rows)


def _searched(spark, sf_dir, name: str, candidates: list[dict], metric: str = "avg_precision", **settings) -> DataFrame:
    found = search.search(txn(spark, sf_dir), name, candidates, metric, settings)
    mean, deviation = F.col(f"{metric}_mean"), F.col(f"{metric}_std")
    return found.select("candidate", "params", mean.between(0, 1).alias("mean_in_0_1"), (deviation >= 0).alias("std_is_positive"))


@query("M15 V10", _candidates_sql(search.candidates_for("logistic")))
def logistic_search(spark, sf_dir):
    """All candidates, judged by the family's ten folds."""
    return _searched(spark, sf_dir, "logistic", search.candidates_for("logistic"))


@query("M16 V10", _candidates_sql(search.candidates_for("xgboost", 10, "first")))
def boosting_search(spark, sf_dir):
    """The first ten candidates of the truncated grid, judged by the family's ten folds with early stopping."""
    return _searched(spark, sf_dir, "xgboost", search.candidates_for("xgboost", 10, "first"))


@query("M16 V10 M12 M13", _candidates_sql(search.candidates_for("xgboost", 10, "first")))
def boosting_folds_search(spark, sf_dir):
    """The first ten candidates of the truncated grid, judged by the family's ten folds with early stopping."""
    return _searched(spark, sf_dir, "xgboost", search.candidates_for("xgboost", 10, "first"))


@query("M15 V10 M13", _candidates_sql(search.candidates_for("logistic")))
def logistic_folds_search(spark, sf_dir):
    """All candidates, judged by the family's ten folds."""
    return _searched(spark, sf_dir, "logistic", search.candidates_for("logistic"))


@query("M17 V5 V10", _candidates_sql(search.candidates_for("behaviour", 5)))
def behaviour_search(spark, sf_dir):
    return _searched(spark, sf_dir, "behaviour", search.candidates_for("behaviour", 5), "f2")


@query("S9 T3 E8 U2", with_views("txn") + " SELECT count(*) AS n, CAST(0 AS BIGINT) AS different, CAST(0 AS BIGINT) AS wrong_decisions FROM txn")
def reloaded_model_scores_stream(spark, sf_dir):
    """A saved model, loaded again, scores the message stream like the one in memory scores the batch."""
    spec = models.family("decision_tree")
    rows = materialise(training.training_rows(txn(spark, sf_dir)).select("record_id", *spec.numeric, *spec.categorical, "is_fraud"), "rows")
    model, path = training.fit_model(rows, spec, spec.params, spec.settings, 666), scratch_path(spark, "model")
    model.save(path)
    loaded = scoring.ScoringModel.load(spark, path)
    source = messages.stream_messages(spark, _message_folder(spark, sf_dir))
    streamed = _drained(spark, stream_scoring.scored(source, loaded, keep=["record_id"]), "scored")
    batch = model.score(rows).select("record_id", F.col("fraud_probability").alias("p"))
    p = F.col("fraud_probability")
    return streamed.join(batch, "record_id", "left").agg(
        F.count("*").alias("n"), F.count_if(F.coalesce(F.abs(p - F.col("p")) > 1e-9, F.lit(True))).alias("different"),
        F.count_if(F.col("prediction") != (p >= loaded.threshold).cast("int")).alias("wrong_decisions"))
