"""Declared schemas and column lists. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, order and types of the transaction message -------------------------
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("record_id", T.LongType()),   # wider than an int: ordinals of large tables must fit
    T.StructField("transacted_at", T.StringType()),
    T.StructField("card_number", T.StringType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("city_pop", T.DoubleType()),
    T.StructField("job", T.StringType()),
    T.StructField("dob", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("unix_time", T.DoubleType()),
    T.StructField("merchant_lat", T.DoubleType()),
    T.StructField("merchant_long", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
])

# Header of the raw CSV, all read as strings. The two source files carry an unnamed index first.
RAW_CSV_COLUMNS = [
    "trans_date_trans_time", "cc_num", "merchant", "category", "amt", "first", "last", "gender",
    "street", "city", "state", "zip", "lat", "long", "city_pop", "job", "dob", "trans_num",
    "unix_time", "merch_lat", "merch_long", "is_fraud",
]

# target column -> source names, best first
COLUMN_ALIASES = {
    "transaction_time": ["transacted_at", "trans_date_trans_time"],
    "amount": ["amt"],
    "merchant_lat": ["merch_lat"],
    "merchant_long": ["merch_long"],
    "card_number": ["cc_num"],
    "transaction_id": ["trans_num"],
}

REQUIRED_COLUMNS = [
    "transaction_time", "amount", "merchant", "category", "city", "state", "zip", "lat", "long",
    "city_pop", "merchant_lat", "merchant_long", "is_fraud",
]

COERCED_COLUMNS = ["amount", "zip", "lat", "long", "city_pop", "merchant_lat", "merchant_long"]

FILLED_CATEGORICALS = ["gender", "category", "state", "city", "merchant"]

WINSORISED_COLUMNS = ["amt", "city_pop", "lat", "long", "merch_lat", "merch_long"]

BASE_NUMERIC = [
    "amount", "zip", "lat", "long", "city_pop", "merchant_lat", "merchant_long",
    "transaction_hour", "transaction_dayofweek", "transaction_month",
]
DERIVED_NUMERIC = ["amount_log", "merchant_distance", "city_pop_log"]
NUMERIC_FEATURES = BASE_NUMERIC + DERIVED_NUMERIC
CATEGORICAL_FEATURES = ["category", "state", "gender", "city", "merchant"]

BEHAVIOUR_FEATURES = [
    "amount", "is_night", "is_weekend", "transaction_day", "user_activity_24h",
    "amount_to_avg_ratio", "merchant_risk", "merchant",
]

HIGH_RISK_MERCHANTS = ["QuickCash", "GlobalDigital", "FastMoneyX"]
# --- end of fixed values ---------------------------------------------------------------------

# The message source and its file stand-in share this envelope.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

RUN_SCHEMA = T.StructType([
    T.StructField("run_name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("fold", T.IntegerType()),
    T.StructField("value", T.StringType()),
])


def raw_csv_schema(index_column: str | None = None) -> T.StructType:
    names = ([index_column] if index_column else []) + RAW_CSV_COLUMNS
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
