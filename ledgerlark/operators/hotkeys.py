"""Finding the keys that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.session import materialise

# Sliding frames re-aggregate the frame for every row, so a long group costs rows x frame; the sliced road is
# linear. A key is therefore hot long before it fills a task. Both roads give the same result.
HOT_ROWS = 20_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """A written table of the keys with at least ``hot_rows`` rows.

    The count is combined map-side, so the shuffle carries one row per key and input partition.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") >= hot_rows)
    return materialise(counts.select(key), "hot-keys")


def flag_hot(df: DataFrame, key: str, hot: DataFrame | None, name: str) -> DataFrame:
    """Marks the rows of the listed keys. The list is a written table, so the planner knows its size and broadcasts it
    only while it is small; a longer one takes a shuffle join whose skewed partitions are split."""
    if hot is None:
        return df.withColumn(name, F.lit(False))
    listed = hot.select(F.col(key), F.lit(True).alias(name))
    return df.join(listed, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
