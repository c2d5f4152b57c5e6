"""One path from any accepted payload to the normalised transaction row, for batch and stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerlark.functions.scalar import as_double, event_time, to_event_timestamp
from ledgerlark.schema import (
    COERCED_COLUMNS, COLUMN_ALIASES, FILLED_CATEGORICALS, REQUIRED_COLUMNS, TRANSACTION_SCHEMA,
)


def parse_payload(messages: DataFrame, schema: T.StructType = TRANSACTION_SCHEMA) -> DataFrame:
    """Flatten the JSON value. A bad field becomes NULL, the other fields of the row survive."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def apply_aliases(df: DataFrame) -> DataFrame:
    """Create each missing target from its first alias present; source columns are kept."""
    present = set(df.columns)
    created = {}
    for target, sources in COLUMN_ALIASES.items():
        source = next((s for s in sources if s in present), None)
        if target not in present and source is not None:
            created[target] = F.col(source)
    return df.withColumns(created) if created else df


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"the rows lack {', '.join(missing)}")
    return df


def coerce_numbers(df: DataFrame, columns: Sequence[str] = COERCED_COLUMNS) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    return df.withColumns({c: as_double(F.col(c), types[c]) for c in columns if c in types})


def coerce_time(df: DataFrame, column: str = "transaction_time", source: str | None = None) -> DataFrame:
    source = source or column
    return df.withColumn(column, to_event_timestamp(F.col(source), df.schema[source].dataType))


def cast_label(df: DataFrame, column: str = "is_fraud") -> DataFrame:
    """Label to int; an unreadable label counts as missing."""
    return df.withColumn(column, as_double(F.col(column), df.schema[column].dataType).cast("int"))


def normalise(df: DataFrame) -> DataFrame:
    """Alias, check, coerce, and keep the rows usable for training."""
    df = require_columns(apply_aliases(df))
    df = cast_label(coerce_numbers(coerce_time(df)))
    return df.dropna(subset=["transaction_time", "amount", "is_fraud"])


def fill_categoricals(df: DataFrame, columns: Sequence[str] = FILLED_CATEGORICALS,
                      value: str = "unknown") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def normalise_messages(messages: DataFrame) -> DataFrame:
    """Serving side: parse, derive the event time (text, else epoch seconds), fill categoricals."""
    df = parse_payload(messages)
    df = df.withColumn("transaction_time", event_time(F.col("transacted_at"), F.col("unix_time")))
    return fill_categoricals(coerce_numbers(df))


def drop_unusable(df: DataFrame) -> DataFrame:
    """Serving rows need a time and an amount."""
    return df.dropna(subset=["transaction_time", "amount"])
