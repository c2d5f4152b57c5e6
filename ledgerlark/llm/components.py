"""Connected components of links between ids, as alternating large-star and small-star steps on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlark.session import materialise


def _fingerprint(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(20,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """(high, low): each linked id but the smallest of its component, with that smallest one.

    ``links`` has columns a and b; loops, repeated links and links in both directions are fine, links with a
    null end are ignored. Each step is written to the shared folder; the number of steps grows with the
    logarithm of the longest path.
    """
    pairs = links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).filter(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    now = materialise(pairs, "links")
    seen = _fingerprint(now)
    while seen[0]:
        # Large star: every larger neighbour is tied to the smallest id around.
        both = now.select(F.col("high").alias("u"), F.col("low").alias("v")).unionAll(
            now.select(F.col("low").alias("u"), F.col("high").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        # Small star: an id and its smaller neighbours are tied to the smallest of them.
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high").select(
            F.when(F.col("low") == F.col("m"), F.col("high")).otherwise(F.col("low")).alias("high"), F.col("m").alias("low"),
            F.col("high").alias("from"))
        small = small.select("high", "low").unionAll(
            small.filter(F.col("high") != F.col("from")).select(F.col("from").alias("high"), "low"))
        now = materialise(small.distinct(), "links")
        before, seen = seen, _fingerprint(now)
        if seen == before:
            break
    return now
