"""Per-card profiles in versions: a running stream sees a new snapshot from its next micro-batch on.

A snapshot is written whole under its version, then its pointer, a table of one row; a version without a pointer does not exist. Each
micro-batch reads the newest pointer, notes the version it used under its batch id, and joins that snapshot, so a replayed batch joins
what it joined before and replaces its own output. Both sides of the join grow, so it is a merge join at every size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


@dataclass
class ProfileStore:
    """Snapshots, pointers and the versions that batches used, below ``path``. One writer publishes at a time."""

    path: str
    key: str = "card_number"

    def _pointers(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("published timestamp, version long").parquet(f"{self.path}/pointers")

    def newest(self, spark: SparkSession) -> int:
        """The newest version, -1 while there is none."""
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/pointers")
        if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return -1
        found = self._pointers(spark).agg(F.max("version")).first()[0]
        return -1 if found is None else int(found)

    def publish(self, profile: DataFrame) -> int:
        """Write ``profile``, one row per card, as the next version; the snapshot first, its pointer after it."""
        spark = profile.sparkSession
        version = self.newest(spark) + 1
        profile.write.mode("overwrite").parquet(f"{self.path}/snapshots/{version}")
        pointer = spark.range(1).select(F.current_timestamp().alias("published"), F.lit(version).cast("long").alias("version"))
        pointer.coalesce(1).write.mode("append").parquet(f"{self.path}/pointers")
        return version

    def snapshot(self, spark: SparkSession, version: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/snapshots/{version}")

    def version_of(self, spark: SparkSession, used: str, batch_id: int) -> int:
        """The version of a batch: the one it noted when it ran first, else the newest, which it notes."""
        place = f"{used}/{batch_id}"
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
        if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return int(spark.read.schema("version long").parquet(place).first()[0])
        version = self.newest(spark)
        spark.range(1).select(F.lit(version).cast("long").alias("version")).coalesce(1).write.mode("overwrite").parquet(place)
        return version


@dataclass
class ProfileJoin:
    """Joins each micro-batch with the snapshot of its time; ``output`` holds the rows by batch, with the version they met."""

    store: ProfileStore
    output: str
    used: str
    columns: str                                   # types of the profile's columns, for batches before the first snapshot

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark, key = batch.sparkSession, self.store.key
        version = self.store.version_of(spark, self.used, batch_id)
        if version < 0:
            empty = spark.createDataFrame([], self.columns)
            joined = batch.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema if f.name != key))
        else:
            joined = batch.join(self.store.snapshot(spark, version).hint("merge"), key, "left")
        (joined.withColumns({"version": F.lit(version).cast("long"), "batch": F.lit(batch_id)}).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.output))

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()
