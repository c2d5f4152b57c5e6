"""Joins with a side that is usually small: written once, then broadcast or shuffled by its size in bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from ledgerlark.session import materialise


def join_small(left: DataFrame, right: DataFrame, on: str | list[str] | Column, how: str) -> DataFrame:
    """``left.join(right)`` with ``right`` written first.

    The planner then knows its size in bytes before anything of the large side is shuffled, and broadcasts it
    below the session's threshold. A larger one takes a shuffle join, whose skewed partitions adaptive execution
    splits. No row passes through the driver.
    """
    return left.join(materialise(right, "small-side"), on, how)
