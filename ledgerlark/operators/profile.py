"""Data profile: missing values, descriptions, frequent values, label rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlark.operators.bounded import join_small
from ledgerlark.operators.features import add_haversine
from ledgerlark.operators.orderstats import quantiles
from ledgerlark.operators.sampling import HashOrder, take


def _wide_to_long(one_row: DataFrame, columns: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """One row of ``<column>::<stat>`` values to one row per column."""
    packed = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}::{s}`").alias(s) for s in stats]) for c in columns]
    return one_row.select(F.explode(F.array(*packed)).alias("r")).select("r.*")


def missing_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, their number and rate, worst first."""
    columns = list(columns or df.columns)
    aggregates = [F.count("*").alias("rows")]
    aggregates += [F.count_if(F.col(c).isNull()).alias(f"{c}::missing_count") for c in columns]
    one_row = df.agg(*aggregates)
    packed = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}::missing_count`").alias("missing_count"),
                       F.col("rows")) for c in columns]
    return (one_row.select(F.explode(F.array(*packed)).alias("r")).select("r.*")
            .filter("missing_count > 0")
            .select("column", "missing_count", (F.col("missing_count") / F.col("rows")).alias("missing_rate"))
            .orderBy(F.desc("missing_count"), "column"))


def describe_numeric(df: DataFrame, columns: Sequence[str], decimals: int = 1, exact: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, rounded."""
    quartiles = quantiles(df, list(columns), [0.25, 0.5, 0.75], exact)
    aggregates = []
    for c in columns:
        aggregates += [F.count(c).alias(f"{c}::count"), F.avg(c).alias(f"{c}::mean"),
                       F.stddev_samp(c).alias(f"{c}::std"),
                       F.min(F.col(c).cast("double")).alias(f"{c}::min"),
                       F.max(F.col(c).cast("double")).alias(f"{c}::max")]
    one_row = df.agg(*aggregates)
    for c in columns:
        one_row = one_row.withColumns({f"{c}::{n}": F.lit(q).cast("double") for n, q in
                                       zip(("p25", "p50", "p75"), quartiles[c])})
    stats = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    described = _wide_to_long(one_row, columns, stats)
    return described.withColumns({s: F.round(s, decimals) for s in stats if s != "count"})


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, count) of several text columns in one pass; NULLs left out.

    Rows fan out per column inside the map task only: counts are combined before the shuffle.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return (df.select(F.explode(pairs).alias("p")).select("p.*")
            .filter(F.col("value").isNotNull()).groupBy("column", "value").count())


def describe_categorical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, most frequent value (ties to the smallest) and its frequency per column."""
    counts = value_counts(df, columns)
    best = F.min_by(F.col("value"), F.struct(-F.col("count"), F.col("value")))
    return counts.groupBy("column").agg(F.sum("count").alias("count"), F.count("*").alias("unique"),
                                        best.alias("top"), F.max("count").alias("freq"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent values, ties to the smallest value."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("transactions"))
            .orderBy(F.desc("transactions"), column).limit(n))


def label_rate_by_top(df: DataFrame, column: str = "category", label: str = "is_fraud", n: int = 10) -> DataFrame:
    """Size, label sum and label rate of the ``n`` most frequent values, highest rate first.

    Every value is aggregated once and the top is cut from the aggregate, so the table is read once.
    """
    per_value = (df.filter(F.col(column).isNotNull()).groupBy(column)
                 .agg(F.count("*").alias("transactions"), F.sum(label).alias("fraud_cases")))
    return (per_value.orderBy(F.desc("transactions"), column).limit(n)
            .withColumn("fraud_rate", F.col("fraud_cases") / F.col("transactions"))
            .orderBy(F.desc("fraud_rate"), column))


def members(df: DataFrame, column: str, listed: DataFrame) -> DataFrame:
    """Rows whose value is in a computed list: a semi join."""
    return join_small(df, listed.select(column).distinct(), column, "left_semi")


def label_density(df: DataFrame, value: str = "amount", label: str = "is_fraud", width: float = 10.0) -> DataFrame:
    """Histogram of ``value`` per label, each label normalised on its own."""
    bins = (df.filter(F.col(value).isNotNull())
            .groupBy(label, F.floor(F.col(value) / width).cast("bigint").alias("bin"))
            .agg(F.count("*").alias("transactions")))
    totals = bins.groupBy(F.col(label).alias("_label")).agg(F.sum("transactions").alias("_total"))
    return (bins.join(F.broadcast(totals), F.col(label) == F.col("_label"))   # one row per label
            .select(label, "bin", (F.col("bin") * width).alias("bin_start"), "transactions",
                    (F.col("transactions") / F.col("_total")).alias("share"),
                    (F.col("transactions") / F.col("_total") / width).alias("density")))


def label_rate(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Label rate in percent."""
    return df.agg((F.avg(label) * 100).alias("fraud_rate_percent"))


def split_stats(df: DataFrame, label: str = "is_fraud", split: str = "is_test") -> DataFrame:
    """Rows, positives and positive ratio of each part and of the whole."""
    stats = [F.count("*").alias("samples"), F.sum(label).alias("positives"), F.avg(label).alias("positive_ratio")]
    part = F.when(F.grouping(split) == 1, "all").when(F.col(split), "test").otherwise("train")
    return df.rollup(split).agg(*stats, part.alias("part")).select("part", "samples", "positives", "positive_ratio")


def check_positives(df: DataFrame, label: str = "is_fraud", low: int = 10) -> int:
    """Number of positives; none is an error, few is a warning."""
    import warnings

    positives = df.agg(F.sum(label)).first()[0] or 0
    if positives == 0:
        raise ValueError("no positive rows to train on")
    if positives < low:
        warnings.warn(f"only {positives} positive rows", stacklevel=2)
    return positives


def amount_distance_sample(df: DataFrame, n: int = 5000, order: HashOrder = HashOrder(row_id="trans_num"),
                           merchant_lat: str = "merch_lat", merchant_long: str = "merch_long") -> DataFrame:
    """``n`` random rows with complete coordinates and their great-circle distance."""
    complete = df.dropna(subset=["lat", "long", merchant_lat, merchant_long])
    return add_haversine(take(complete, n, order), merchant_lat=merchant_lat, merchant_long=merchant_long)
