"""Streaming: parse, watermark, features, score, write. The column logic is the batch code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.operators.features import add_serving_features
from ledgerlark.operators.normalise import normalise_messages
from ledgerlark.operators.scoring import ScoringModel
from ledgerlark.schema import HIGH_RISK_MERCHANTS
from ledgerlark.session import STATE_CONF, settings
from ledgerlark.sources.messages import stream_messages, stream_sink, to_envelope

LATENESS = "24 hours"


def transactions(messages: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Parsed and filled transactions under the event-time watermark."""
    return normalise_messages(messages).withWatermark("transaction_time", lateness)


def distinct_transactions(df: DataFrame) -> DataFrame:
    """Each transaction id once; state older than the watermark is dropped."""
    return df.dropDuplicatesWithinWatermark(["transaction_id"])


def features(messages: DataFrame, lateness: str = LATENESS, null_policy: str = "zero",
             merchants: Sequence[str] = HIGH_RISK_MERCHANTS) -> DataFrame:
    return add_serving_features(transactions(messages, lateness), merchants, null_policy)


def scored(messages: DataFrame, model: ScoringModel, lateness: str = LATENESS, null_policy: str = "null",
           keep: list[str] | None = None, merchants: Sequence[str] = HIGH_RISK_MERCHANTS) -> DataFrame:
    """Message and feature columns plus prediction and probability.

    The default NULL policy is the one of training: gaps reach the model's imputation. ``keep`` narrows
    the output before it is serialised.
    """
    out = model.score(features(messages, lateness, null_policy, merchants))
    return out.select(*keep, "prediction", "fraud_probability") if keep else out


def start_scoring(spark: SparkSession, source: Mapping, sink: Mapping, model: ScoringModel, checkpoint: str,
                  once: bool = False, **options) -> StreamingQuery:
    """Score the topic (or folder) into the output topic; ``once`` drains what is there and stops."""
    envelope = to_envelope(scored(stream_messages(spark, source), model, **options),
                           timestamp=F.col("transaction_time"))
    writer = stream_sink(envelope, sink, checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def join_profile(stream: DataFrame, profile: DataFrame, key: str = "card_number") -> DataFrame:
    """Stream-static left join with a per-card profile: one static row per card."""
    return stream.join(profile, key, "left")


def hourly_monitor(df: DataFrame, label: str = "is_fraud", width: str = "1 hour") -> DataFrame:
    """Rows and label rate per time window, final once the watermark has passed."""
    return (df.groupBy(F.window("transaction_time", width))
            .agg(F.count("*").alias("transactions"), F.avg(label).alias("fraud_rate"))
            .select(F.col("window.start").alias("window_start"), "transactions", "fraud_rate"))


def run_once(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Drain a streaming frame into files and wait. State is on disk, whatever the session's own store is.

    A partition of state costs a store and a worker in every batch, empty or not, so a new checkpoint gets two a core at most.
    """
    writer = (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(availableNow=True))
    spark = df.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    with settings(spark, {**STATE_CONF, "spark.sql.shuffle.partitions": str(parts)}):          # a query copies them when it starts
        query = writer.start()
    query.awaitTermination()
