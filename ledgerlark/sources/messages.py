"""Message sources and sinks: a Kafka topic, or a folder of JSON lines with the same envelope.

The envelope is ``(key, value, timestamp)``. Options are plain dicts built from a configuration mapping,
so they can be checked without a broker; credentials come from that mapping or the environment.
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerlark.functions.scalar import blank_to_null, to_double, to_long
from ledgerlark.schema import ENVELOPE_SCHEMA
from ledgerlark.session import materialise

_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def security_options(config: Mapping) -> dict[str, str]:
    """PLAINTEXT, or SASL with user name and password."""
    protocol = str(config.get("security_protocol", "PLAINTEXT")).upper()
    options = {"kafka.security.protocol": protocol}
    if protocol.startswith("SASL"):
        user = config.get("username") or os.environ.get("KAFKA_USERNAME", "")
        secret = config.get("password") or os.environ.get("KAFKA_PASSWORD", "")
        options["kafka.sasl.mechanism"] = config.get("sasl_mechanism", "PLAIN")
        quoted = [v.replace("\\", "\\\\").replace('"', '\\"') for v in (str(user), str(secret))]
        options["kafka.sasl.jaas.config"] = '{} required username="{}" password="{}";'.format(_LOGIN_MODULE, *quoted)
    return options


def _servers(config: Mapping) -> str:
    servers = ",".join(s.strip() for s in str(config.get("bootstrap_servers", "")).split(",") if s.strip())
    if not servers:
        raise ValueError("no bootstrap_servers in the source or sink settings")
    return servers


def source_options(config: Mapping, streaming: bool = False) -> dict[str, str]:
    """A bounded read takes the training topic from its start; a stream takes the test topic's new rows.

    ``max_offsets`` bounds one micro-batch of the stream.
    """
    topic = config.get("test_data", config.get("topic")) if streaming else config.get("topic")
    if not topic:
        raise ValueError("no topic in the source settings")
    options = {"kafka.bootstrap.servers": _servers(config), "subscribe": str(topic),
               "startingOffsets": "latest" if streaming else "earliest"}
    if streaming and config.get("max_offsets"):
        options["maxOffsetsPerTrigger"] = str(config["max_offsets"])
    return options | security_options(config)


def sink_options(config: Mapping, topic: str | None = None) -> dict[str, str]:
    topic = topic or config.get("output_topic", "fraud_predictions")
    return {"kafka.bootstrap.servers": _servers(config), "topic": topic,
            "kafka.compression.type": config.get("compression", "gzip")} | security_options(config)


def is_folder(config: Mapping) -> bool:
    return "path" in config


# --- reading --------------------------------------------------------------------------------

def read_messages(spark: SparkSession, config: Mapping) -> DataFrame:
    """Bounded read of the envelope, from the earliest message on."""
    if is_folder(config):
        return spark.read.schema(ENVELOPE_SCHEMA).json(config["path"])
    raw = spark.read.format("kafka").options(**source_options(config)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def stream_messages(spark: SparkSession, config: Mapping) -> DataFrame:
    """Unbounded read of the envelope."""
    if is_folder(config):
        reader = spark.readStream.schema(ENVELOPE_SCHEMA)
        if config.get("max_files"):
            reader = reader.option("maxFilesPerTrigger", config["max_files"])
        return reader.json(config["path"])
    raw = spark.readStream.format("kafka").options(**source_options(config, streaming=True)).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


# --- writing --------------------------------------------------------------------------------

def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Dense row numbers from 0, in partition order.

    Rows are written once with their partition and place, which pins both against retries and a changing
    number of executors. Then only partition sizes are aggregated and each row adds the rows before its
    partition: no sort, no shuffle of rows.
    """
    tagged = materialise(df.withColumns({
        "_part": F.spark_partition_id(),
        "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ordinal")
    sizes = sorted((r["_part"], r["count"]) for r in tagged.groupBy("_part").count().collect())
    starts, total = [], 0
    for part, size in sizes:
        starts.append((part, total))
        total += size
    table = df.sparkSession.createDataFrame(starts or [(0, 0)], "_part int, _start bigint")
    return (tagged.join(F.broadcast(table), "_part")   # one row per input partition
            .withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start"))


def transaction_payload(raw: DataFrame, index: str | None = None, ordinal: str = "ordinal") -> DataFrame:
    """Raw CSV rows (all text) to the 23 message fields; rows without any id are dropped.

    ``record_id`` is the parsed index; a missing index, and index 0, give the row ordinal.
    """
    def text(name: str) -> Column:
        return F.col(name) if name in raw.columns else F.lit(None).cast("string")

    parsed_index = to_long(text(index)) if index else F.lit(None).cast("bigint")
    fields = {
        "record_id": F.coalesce(F.nullif(parsed_index, F.lit(0)), F.col(ordinal)),
        "transacted_at": text("trans_date_trans_time"), "card_number": text("cc_num"),
        "merchant": text("merchant"), "category": text("category"), "amount": to_double(text("amt")),
        "first_name": text("first"), "last_name": text("last"), "gender": text("gender"),
        "street": text("street"), "city": text("city"), "state": text("state"), "zip": to_long(text("zip")),
        "lat": to_double(text("lat")), "long": to_double(text("long")), "city_pop": to_long(text("city_pop")),
        "job": text("job"), "dob": text("dob"),
        "transaction_id": F.coalesce(blank_to_null(text("trans_num")), blank_to_null(text("transaction_id"))),
        "unix_time": to_long(text("unix_time")), "merchant_lat": to_double(text("merch_lat")),
        "merchant_long": to_double(text("merch_long")), "is_fraud": to_long(text("is_fraud")),
    }
    return raw.select(*[c.alias(n) for n, c in fields.items()]).filter(F.col("transaction_id").isNotNull())


def to_envelope(df: DataFrame, key: str = "transaction_id", timestamp: Column | None = None,
                keep_nulls: bool = True) -> DataFrame:
    """Key and JSON value; ``timestamp`` only matters to the folder stand-in."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": str(not keep_nulls).lower()})
    stamp = F.lit(None).cast("timestamp") if timestamp is None else timestamp
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"), stamp.alias("timestamp"))


def publish(envelope: DataFrame, config: Mapping, topic: str | None = None) -> None:
    """Batch write of the envelope. A folder may be a retried target, so it is overwritten, not appended."""
    if is_folder(config):
        envelope.write.mode("overwrite").json(config["path"])
        return
    (envelope.select("key", "value").write.format("kafka")
     .options(**sink_options(config, topic or config.get("topic"))).save())


def stream_sink(envelope: DataFrame, config: Mapping, checkpoint: str, topic: str | None = None) -> DataStreamWriter:
    """Append writer with a checkpoint; the caller picks the trigger and starts it."""
    writer = envelope.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if is_folder(config):
        return writer.format("json").option("path", config["path"])
    return writer.format("kafka").options(**sink_options(config, topic))
