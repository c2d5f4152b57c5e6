"""Per-card history on a stream.

Keyed operator state would put a card with a third of the traffic into one task for ever. Instead each
micro-batch is written to a history store and its features are computed by the batch operators over the
batch and what the store knows of its cards: the same code, the same skew handling, the same results as a
batch job over rows in arrival order of batches. The store has two parts:

* ``rows`` by day and batch; a batch reads the days that its time frames reach back to.
* ``tails`` by batch: the last rows of each card, however old they are. A batch adds those of its own cards, and
  every ``SNAPSHOT_EVERY`` batches those of all cards, so a batch reads one snapshot and a few additions.

So the cost of a batch follows its own days and cards, not the age of the store. A row that comes late sees what
arrived before its batch within the frames' days and the card's last rows; rows already emitted are not rewritten.

All writes are keyed by batch id and replace themselves, so a replayed batch changes nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.operators.history import Entity, add_behaviour
from ledgerlark.operators.hotkeys import HOT_ROWS

COLUMNS = ["user_activity_24h", "rolling_avg_7d", "time_since_last_txn", "amount_to_avg_ratio"]
FRAME_DAYS = 7           # the longest time frame
TAIL_ROWS = 6            # rows before a row that its row frames need
SNAPSHOT_EVERY = 16      # batches
TAIL_SALTS = 32


@dataclass
class HistoryStream:
    """``store`` holds past rows, ``output`` the enriched rows, both as parquet folders."""

    store: str
    output: str
    entity: Entity = field(default_factory=Entity)
    hot_rows: int = HOT_ROWS

    def _replace(self, df: DataFrame, path: str, partitions: list[str]) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partitions).parquet(path))

    def _last_rows(self, rows: DataFrame) -> DataFrame:
        """The last rows of each card: first of each salt of a card, so that no task holds a hot card."""
        e = self.entity
        order = [F.desc(e.time), F.desc(e.row_id)]
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("uid"), F.lit(TAIL_SALTS)))
        for group in ([e.key, "_salt"], [e.key]):
            nth = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
            salted = salted.withColumn("_nth", nth).filter(F.col("_nth") <= TAIL_ROWS).drop("_nth")
        return salted.drop("_salt")

    def _tails(self, spark: SparkSession, batch_id: int, layout: str) -> DataFrame:
        """The last rows of all cards before the batch, from the newest addition of each card."""
        e = self.entity
        snapshot = (batch_id - 1) // SNAPSHOT_EVERY * SNAPSHOT_EVERY
        held = spark.read.schema(layout).parquet(f"{self.store}/tails").filter(
            (F.col("added") >= snapshot) & (F.col("added") < batch_id))
        newest = held.groupBy(e.key).agg(F.max("added").alias("added"))
        return held.join(newest, [e.key, "added"]).drop("added")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark, e = batch.sparkSession, self.entity
        uid = F.concat_ws("-", F.lit(batch_id), F.monotonically_increasing_id())
        self._replace(batch.withColumns({"day": F.to_date(e.time), "batch": F.lit(batch_id), "uid": uid}),
                      f"{self.store}/rows", ["day", "batch"])
        kinds = {f.name: f.dataType.simpleString() for f in batch.schema}
        layout = ", ".join(f"`{c}` {kinds[c]}" for c in batch.columns) + ", uid string, day date, batch int"
        held = spark.read.schema(layout).parquet(f"{self.store}/rows")
        new = held.filter(F.col("batch") == batch_id)
        days = new.agg(F.min("day"), F.max("day")).first()
        needed = list(dict.fromkeys([e.key, e.time, e.row_id, e.amount]))
        cards = new.filter(F.col(e.key).isNotNull() & F.col(e.time).isNotNull()).select(e.key).distinct()
        known = new.select(*needed, "uid").filter(F.col(e.key).isNotNull() & F.col(e.time).isNotNull())
        both = new.select(*needed, "uid", F.lit(True).alias("_new"))
        tail_layout = ", ".join(f"`{c}` {kinds[c]}" for c in needed) + ", uid string, added int"
        tails = self._tails(spark, batch_id, tail_layout) if batch_id else None
        if days[0] is not None and batch_id:
            near = held.filter((F.col("batch") < batch_id) & (F.col("day") <= F.lit(days[1]))
                               & (F.col("day") >= F.lit(days[0] - dt.timedelta(days=FRAME_DAYS)))).select(*needed, "uid")
            past = near.unionByName(tails).join(cards, e.key, "left_semi").dropDuplicates(["uid"])
            both = both.unionByName(past.withColumn("_new", F.lit(False)))
        found = add_behaviour(both, e, hot_rows=self.hot_rows).filter("_new")
        self._replace(found.select(e.row_id, *COLUMNS).withColumn("batch", F.lit(batch_id)), self.output, ["batch"])

        if tails is not None:
            whole = batch_id % SNAPSHOT_EVERY == 0
            known = known.unionByName(tails if whole else tails.join(cards, e.key, "left_semi"))
        self._replace(self._last_rows(known).withColumn("added", F.lit(batch_id)), f"{self.store}/tails", ["added"])

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()


@dataclass
class LateRouter:
    """Routes rows older than the watermark of the earlier batches to a folder of their own.

    The largest event time so far is kept with each batch id; a batch reads the one before it.
    """

    on_time: str
    late: str
    clock: str
    lateness: dt.timedelta = dt.timedelta(hours=24)
    time: str = "transaction_time"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            seen = None
            if batch_id:
                before = spark.read.schema("highest timestamp, batch int").parquet(self.clock).filter(F.col("batch") == batch_id - 1)
                seen = (before.first() or [None])[0]
            highest = batch.agg(F.max(self.time).cast("timestamp").alias("highest"))
            (highest.select(F.greatest("highest", F.lit(seen).cast("timestamp")).alias("highest"), F.lit(batch_id).alias("batch"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self.clock))
            is_late = F.lit(False) if seen is None else F.coalesce(F.col(self.time) < F.lit(seen - self.lateness), F.lit(False))
            tagged = batch.withColumn("batch", F.lit(batch_id))
            for part, path in ((~is_late, self.on_time), (is_late, self.late)):
                (tagged.filter(part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                 .partitionBy("batch").parquet(path))
        finally:
            batch.unpersist()

    def start(self, stream: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()
