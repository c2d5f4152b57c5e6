"""Gaussian noise on numeric features, drawn per row from the row's id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlark.functions.hashing import gaussian
from ledgerlark.schema import NUMERIC_FEATURES

ZERO_DEVIATION = 1e-8


def _deviations(df: DataFrame, columns: Sequence[str], population: bool) -> dict[str, float | None]:
    measure = F.stddev_pop if population else F.stddev_samp
    row = df.agg(*[measure(c).alias(c) for c in columns]).first()
    return row.asDict()


def _add(df: DataFrame, scales: dict[str, float], row_id: str, seed: int, method: str) -> DataFrame:
    return df.withColumns({c: F.col(c) + gaussian(F.col(row_id), seed, c, method) * scale
                           for c, scale in scales.items()})


def add_sample_noise(df: DataFrame, columns: Sequence[str] = tuple(NUMERIC_FEATURES), scale: float = 0.05,
                     row_id: str = "transaction_id", seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """Noise of ``scale`` times the sample deviation; constant columns are left alone."""
    columns = [c for c in columns if c in df.columns]
    deviations = _deviations(df, columns, population=False)
    return _add(df, {c: d * scale for c, d in deviations.items() if d is not None and d > 0}, row_id, seed, method)


def add_fold_noise(df: DataFrame, columns: Sequence[str], level: float, row_id: str = "transaction_id",
                   seed: int = 42, method: str = "xxhash64") -> DataFrame:
    """Noise of ``level`` times the population deviation, for training rows only; a constant column
    gets a tiny deviation. Use a seed per fold."""
    deviations = _deviations(df, columns, population=True)
    return _add(df, {c: (d or ZERO_DEVIATION) * level for c, d in deviations.items()}, row_id, seed, method)
