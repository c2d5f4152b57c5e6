"""The exploration job: raw rows to cleaned rows and their profile tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerlark.operators import clean, profile
from ledgerlark.operators.normalise import cast_label, coerce_numbers, coerce_time
from ledgerlark.session import materialise

RAW_NUMERIC = ["amt", "zip", "lat", "long", "city_pop", "merch_lat", "merch_long", "unix_time"]


def typed(raw: DataFrame) -> DataFrame:
    """Event time and the eight numeric columns, leniently parsed."""
    return coerce_numbers(coerce_time(raw, "transacted_at", "trans_date_trans_time"), RAW_NUMERIC)


def cleaned(raw: DataFrame, order: str = "record_id", outlier_columns: Sequence[str] = clean.WINSORISED_COLUMNS,
            exact: bool = True) -> DataFrame:
    """Types, keep-first, winsorise, absolute amounts, standard categories, rare merchants, int label.

    The deduplicated rows are written once: fences and merchant counts read them again.
    """
    rows = materialise(clean.drop_duplicates_keep_first(typed(raw), "trans_num", order), "deduplicated")
    rows = clean.absolute(clean.winsorise(rows, outlier_columns, exact=exact))
    return cast_label(clean.collapse_rare(clean.standardise(rows)))


def report(rows: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the exploration's prints and charts."""
    categorical = [c for c in ("merchant", "category", "gender", "city", "state") if c in rows.columns]
    numeric = [c for c in [*RAW_NUMERIC, "is_fraud"] if c in rows.columns]
    return {
        "missing": profile.missing_summary(rows),
        "numeric": profile.describe_numeric(rows, numeric),
        "categorical": profile.describe_categorical(rows, categorical),
        "amount_density": profile.label_density(rows, "amt"),
        "category_rates": profile.label_rate_by_top(rows),
        "amount_distance": profile.amount_distance_sample(rows),
    }
