"""Cleaning of raw rows: duplicates, outliers, categorical tidying, constraint rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.functions.scalar import is_member, to_event_timestamp
from ledgerlark.operators.bounded import join_small
from ledgerlark.operators.orderstats import quantiles
from ledgerlark.schema import HIGH_RISK_MERCHANTS, WINSORISED_COLUMNS


# --- duplicates -----------------------------------------------------------------------------

def drop_duplicates_keep_first(df: DataFrame, key: str = "trans_num", order: str = "record_id") -> DataFrame:
    """The row with the smallest ``order`` of each key; missing keys count as one key.

    Rows without an order come last; of equal ones the row with the smallest content hash is first. An aggregation rather than a window: copies collapse before the shuffle, so a key with a third of
    all rows sends one row per input partition.
    """
    others = [c for c in df.columns if c != key]
    content = F.xxhash64(*[F.col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()])
    place = F.struct(F.col(order).isNull(), F.col(order), content)
    firsts = df.groupBy(key).agg(F.min_by(F.struct(*others), place).alias("first"))
    return firsts.select(*[F.col(key) if c == key else F.col(f"first.{c}").alias(c) for c in df.columns])


def duplicate_count(df: DataFrame, key: str = "trans_num") -> DataFrame:
    """How many rows keep-first removes."""
    return (df.groupBy(key).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates_removed")))


# --- outliers -------------------------------------------------------------------------------

def iqr_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5,
               exact: bool = True) -> dict[str, tuple[float, float]]:
    """Fences ``[q1 - k * iqr, q3 + k * iqr]``; an all-NULL column has none."""
    quartiles = quantiles(df, list(columns), [0.25, 0.75], exact)
    return {c: (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
            for c, (q1, q3) in quartiles.items() if q1 is not None}


def clip(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """NULL stays NULL: ``least`` and ``greatest`` would turn it into a bound."""
    return df.withColumns({c: F.when(F.col(c).isNotNull(),
                                     F.least(F.greatest(F.col(c), F.lit(low)), F.lit(high)))
                           for c, (low, high) in bounds.items()})


def winsorise(df: DataFrame, columns: Sequence[str] = tuple(WINSORISED_COLUMNS), k: float = 1.5,
              exact: bool = True) -> DataFrame:
    return clip(df, iqr_bounds(df, columns, k, exact))


def absolute(df: DataFrame, column: str = "amt") -> DataFrame:
    return df.withColumn(column, F.abs(F.col(column)))


# --- categoricals ---------------------------------------------------------------------------

def standard_gender(c: Column) -> Column:
    tidy = F.upper(F.trim(c))
    return F.when(tidy == "FEMALE", "F").when(tidy == "MALE", "M").otherwise(tidy)


def standard_category(c: Column) -> Column:
    return F.lower(F.trim(c))


def standard_state(c: Column) -> Column:
    """Two letters, else ``UNK``; a missing state is ``UNK`` too."""
    tidy = F.upper(F.trim(c))
    return F.when(F.length(tidy) == 2, tidy).otherwise("UNK")


def standardise(df: DataFrame) -> DataFrame:
    return df.withColumns({"gender": standard_gender(F.col("gender")),
                           "category": standard_category(F.col("category")),
                           "state": standard_state(F.col("state"))})


def collapse_rare(df: DataFrame, column: str = "merchant", min_rows: int = 5, other: str = "other") -> DataFrame:
    """Values on fewer than ``min_rows`` rows become ``other``; NULL stays NULL.

    Counts are combined map-side and only the rare values are joined back.
    """
    rare = (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).count()
            .filter(F.col("count") < min_rows).select("_value", F.lit(True).alias("_rare")))
    return (join_small(df, rare, F.col(column) == F.col("_value"), "left")
            .withColumn(column, F.when(F.col("_rare"), other).otherwise(F.col(column)))
            .drop("_value", "_rare"))


# --- constraint rules -----------------------------------------------------------------------

@dataclass(frozen=True)
class Rule:
    """One field's constraints. A missing value breaks only ``required``."""

    field: str
    required: bool = False
    pattern: str | None = None
    minimum: float | None = None
    maximum: float | None = None
    date_time: bool = False
    allowed: tuple | None = None

    def broken(self) -> Column:
        c = F.col(self.field)
        bad = F.lit(False)
        if self.pattern is not None:
            bad = bad | ~c.rlike(self.pattern)
        if self.minimum is not None:
            bad = bad | (c < self.minimum)
        if self.maximum is not None:
            bad = bad | (c > self.maximum)
        if self.date_time:
            bad = bad | to_event_timestamp(c).isNull()
        if self.allowed is not None:
            bad = bad | ~c.isin(*self.allowed)
        return F.when(c.isNull(), F.lit(self.required)).otherwise(bad)


# --- Fixed values: constraints of the older event payload ---
EVENT_RULES = (
    Rule("transaction_id", required=True),
    Rule("user_id", required=True, minimum=1000, maximum=9999),
    Rule("amount", required=True, minimum=0.01, maximum=100000),
    Rule("currency", required=True, pattern="^[A-Z]{3}$"),
    Rule("merchant"),
    Rule("timestamp", required=True, date_time=True),
    Rule("location", pattern="^[A-Z]{2}$"),
    Rule("is_fraud", required=True, minimum=0, maximum=1),
)
# --- end of fixed values ---


def check_rules(df: DataFrame, rules: Sequence[Rule] = EVENT_RULES, name: str = "violations") -> DataFrame:
    """Array of the broken fields, in rule order."""
    return df.withColumn(name, F.array_compact(F.array(*[F.when(r.broken(), F.lit(r.field)) for r in rules])))


def split_valid(df: DataFrame, rules: Sequence[Rule] = EVENT_RULES) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violations)."""
    checked = check_rules(df, rules)
    return checked.filter(F.size("violations") == 0).drop("violations"), checked.filter(F.size("violations") > 0)


def flag_patterns(df: DataFrame, compromised: DataFrame, merchants: Sequence[str] = HIGH_RISK_MERCHANTS) -> DataFrame:
    """The four suspicious patterns as 0/1 columns.

    ``compromised`` is a table with one column ``user_id``.
    """
    listed = compromised.select("user_id").distinct().withColumn("_listed", F.lit(True))
    amount, user = F.col("amount"), F.col("user_id").cast("bigint")
    flags = {
        "account_takeover": F.col("_listed") & (amount > 500),
        "card_testing": (amount < 2.0) & (user % 1000 == 0),
        "merchant_collusion": (is_member(F.col("merchant"), merchants) == 1) & (amount > 300),
        "geo_anomaly": user % 500 == 0,
    }
    return (join_small(df, listed, "user_id", "left")
            .withColumns({n: F.coalesce(c, F.lit(False)).cast("int") for n, c in flags.items()})
            .drop("_listed"))
