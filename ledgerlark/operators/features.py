"""Row-wise features, shared by training and serving."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions.scalar import (
    clipped_log1p, haversine_km, is_member, is_night, is_weekend, planar_distance,
)
from ledgerlark.operators.normalise import drop_unusable
from ledgerlark.schema import HIGH_RISK_MERCHANTS


def add_calendar(df: DataFrame, column: str = "transaction_time") -> DataFrame:
    """Hour, day of week (Monday 0) and month."""
    ts = F.col(column)
    return df.withColumns({
        "transaction_hour": F.hour(ts),
        "transaction_dayofweek": F.weekday(ts),
        "transaction_month": F.month(ts),
    })


def add_calendar_flags(df: DataFrame, column: str = "transaction_time") -> DataFrame:
    ts = F.col(column)
    return df.withColumns({
        "is_night": is_night(F.hour(ts)),
        "is_weekend": is_weekend(F.weekday(ts)),
        "transaction_day": F.dayofmonth(ts),
    })


def add_magnitudes(df: DataFrame, null_policy: str = "null") -> DataFrame:
    """Logs and planar distance. ``null`` keeps gaps for imputation, ``zero`` fills them."""
    if null_policy not in ("null", "zero"):
        raise ValueError(f"unknown null policy: {null_policy}")
    zero = null_policy == "zero"
    return df.withColumns({
        "amount_log": clipped_log1p(F.col("amount"), zero),
        "merchant_distance": planar_distance(F.col("lat"), F.col("long"), F.col("merchant_lat"),
                                             F.col("merchant_long"), zero),
        "city_pop_log": clipped_log1p(F.col("city_pop"), zero),
    })


def add_training_features(df: DataFrame) -> DataFrame:
    """Features of the trainers: calendar, gender default, logs, distance."""
    gender = F.coalesce(F.col("gender"), F.lit("unknown")) if "gender" in df.columns else F.lit("unknown")
    return add_magnitudes(add_calendar(df).withColumn("gender", gender))


def add_constant_history(df: DataFrame, average: float = 1000.0, activity: int = 1000) -> DataFrame:
    """Constant stand-ins for history, for serving without any history."""
    return df.withColumns({
        "time_since_last_txn": F.lit(0.0),
        "user_activity_24h": F.lit(activity),
        "rolling_avg_7d": F.lit(average),
        "amount_to_avg_ratio": F.coalesce(F.try_divide(F.col("amount"), F.lit(average)), F.lit(1.0)),
    })


def add_merchant_risk(df: DataFrame, merchants: Sequence[str] = HIGH_RISK_MERCHANTS,
                      null_as: int | None = None) -> DataFrame:
    return df.withColumn("merchant_risk", is_member(F.col("merchant"), merchants, null_as))


def add_serving_features(df: DataFrame, merchants: Sequence[str] = HIGH_RISK_MERCHANTS,
                         null_policy: str = "zero") -> DataFrame:
    """Everything the scorer sees, row by row: the same plan on a batch and on a stream."""
    df = add_magnitudes(add_calendar_flags(add_calendar(drop_unusable(df))), null_policy)
    return add_merchant_risk(add_constant_history(df), merchants)


def add_haversine(df: DataFrame, name: str = "customer_merchant_distance_km", merchant_lat: str = "merchant_lat",
                  merchant_long: str = "merchant_long") -> DataFrame:
    return df.withColumn(name, haversine_km(F.col("long"), F.col("lat"),
                                            F.col(merchant_long), F.col(merchant_lat)))


def feature_columns(df: DataFrame, excluded: Sequence[str] = ("is_fraud", "transaction_time")) -> DataFrame:
    """The feature frame without label and time."""
    return df.drop(*excluded)
