"""Imputation, scaling and ordinal encoding, fitted with exact distributed aggregates.

Fitted values are frozen into stock MLlib stages, so the result is an ordinary ``PipelineModel`` that
saves, loads and runs on streams without custom code. Values come from our own aggregates because the
stock estimators differ: median imputation there is approximate, scaling uses the sample deviation, and
unseen categories get an extra index instead of -1.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlark.operators.orderstats import quantiles
from ledgerlark.operators.profile import value_counts
from ledgerlark.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from ledgerlark.session import materialise

MAX_LABELS = 100_000   # largest vocabulary kept inside the model; larger ones are joined
FEATURES = "features"


@dataclass
class Fitted:
    """What the training rows taught: per-column numbers, and the code table for large vocabularies."""

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    labels: dict[str, list[str]] = field(default_factory=dict)
    code_table: DataFrame | None = None   # (column, value, code) of vocabularies beyond MAX_LABELS
    unseen: float = -1.0                  # code of a value that the table does not hold

    @property
    def joined(self) -> list[str]:
        return [c for c in self.categorical if c not in self.labels]


# --- fitting --------------------------------------------------------------------------------

def fit_medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict[str, float]:
    return {c: q[0] if q[0] is not None else 0.0
            for c, q in quantiles(df, list(columns), [0.5], exact).items()}


def fit_scaling(df: DataFrame, medians: dict[str, float]) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population deviation after imputation; a constant column scales by 1."""
    aggregates = []
    for c, m in medians.items():
        filled = F.coalesce(F.col(c).cast("double"), F.lit(m))
        flat = F.min(filled) == F.max(filled)        # merged sums of a constant are not exact
        aggregates += [F.when(flat, F.min(filled)).otherwise(F.avg(filled)), F.when(~flat, F.stddev_pop(filled))]
    row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first() if aggregates else []
    means = {c: row[2 * i] if row[2 * i] is not None else 0.0 for i, c in enumerate(medians)}
    return means, {c: row[2 * i + 1] or 1.0 for i, c in enumerate(medians)}


def fit_modes(counts: DataFrame) -> dict[str, str]:
    """Most frequent value per column of a ``value_counts`` frame, ties to the smallest."""
    best = F.min_by(F.col("value"), F.struct(-F.col("count"), F.col("value")))
    return {r["column"]: r["mode"] for r in counts.groupBy("column").agg(best.alias("mode")).collect()}


def code_table(counts: DataFrame) -> DataFrame:
    """(column, value, code): values sorted ascending get 0, 1, 2, ... per column.

    For vocabularies of any size: values are range partitioned and written once, so that range borders
    are fixed; each part ranks its own values and adds the number of values in the parts before it.
    """
    parts = materialise(counts.select("column", "value").repartitionByRange("column", "value")
                        .withColumn("part", F.spark_partition_id()), "vocabulary")
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (parts.groupBy("column", "part").count()
               .withColumn("below", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"))
    nth = F.row_number().over(Window.partitionBy("column", "part").orderBy("value"))
    return (parts.withColumn("nth", nth).join(offsets, ["column", "part"])
            .select("column", "value", (F.col("nth") - 1 + F.col("below")).cast("double").alias("code")))


def _fit_categories(df: DataFrame, fitted: Fitted, max_labels: int) -> None:
    """Modes and vocabularies from one count of all values.

    The counts are kept while they are read; a lost block is counted again. Vocabularies within the limit
    come to the driver, larger ones become a code table.
    """
    counts = value_counts(df, fitted.categorical).persist()
    try:
        best = F.min_by(F.col("value"), F.struct(-F.col("count"), F.col("value")))
        found = {r["column"]: r for r in
                 counts.groupBy("column").agg(best.alias("mode"), F.count("*").alias("size")).collect()}
        fitted.modes = {c: found[c]["mode"] if c in found else "" for c in fitted.categorical}
        kept = [c for c in fitted.categorical if c not in found or found[c]["size"] <= max_labels]
        words: dict[str, list[str]] = {c: [] for c in kept}
        if kept:
            for r in counts.filter(F.col("column").isin(kept)).select("column", "value").collect():
                words[r["column"]].append(r["value"])
        fitted.labels = {c: sorted(w, key=str.encode) or [""] for c, w in words.items()}
        if fitted.joined:
            fitted.code_table = materialise(code_table(counts.filter(F.col("column").isin(fitted.joined))), "codes")
    finally:
        counts.unpersist()


def fit(df: DataFrame, numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
        categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES), exact: bool = True,
        scale: bool = True, max_labels: int = MAX_LABELS) -> Fitted:
    numeric, categorical = list(numeric), list(categorical)
    fitted = Fitted(numeric, categorical)
    if numeric and scale:
        fitted.medians = fit_medians(df, numeric, exact)
        fitted.means, fitted.deviations = fit_scaling(df, fitted.medians)
    if categorical:
        _fit_categories(df, fitted, max_labels)
    return fitted


# --- applying -------------------------------------------------------------------------------

def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scaled_name(c: str) -> str:
    return f"{c}_scaled"


def code_name(c: str) -> str:
    return f"{c}_code"


def encode_by_join(df: DataFrame, columns: Sequence[str], codes: DataFrame, modes: dict[str, str] | None = None,
                   unseen: float = -1.0) -> DataFrame:
    """Codes by left join with the code table; unseen values get ``unseen``, missing ones the mode's code.

    Spark broadcasts the table when it is small; otherwise the join is a shuffle whose skewed
    partitions adaptive execution splits.
    """
    for c in columns:
        table = codes.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        value = F.coalesce(F.col(c), F.lit(modes[c])) if modes else F.col(c)
        df = (df.join(table, value == F.col("_value"), "left")
              .withColumn(code_name(c), F.coalesce("_code", F.lit(unseen))).drop("_value", "_code"))
    return df


def stages(fitted: Fitted, output: str = FEATURES) -> PipelineModel:
    """Impute, scale, encode and assemble: numeric columns first, then codes, in the given order."""
    columns, names = [], []
    for c in fitted.numeric:
        if c in fitted.medians:
            columns.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {_number(fitted.medians[c])}) - {_number(fitted.means[c])})"
                           f" / {_number(fitted.deviations[c])} AS `{scaled_name(c)}`")
        else:
            columns.append(f"CAST(`{c}` AS DOUBLE) AS `{scaled_name(c)}`")
        names.append(scaled_name(c))
    indexed = [c for c in fitted.categorical if c in fitted.labels]
    columns += [f"coalesce(`{c}`, {_text(fitted.modes[c])}) AS `_{c}`" for c in indexed]
    steps = [SQLTransformer(statement="SELECT *" + "".join(f", {c}" for c in columns) + " FROM __THIS__")]
    if indexed:
        # One indexer a column: an indexer of several gives what is unseen the size of the first column's vocabulary in all.
        steps += [StringIndexerModel.from_labels(fitted.labels[c], inputCol=f"_{c}", outputCol=f"_{c}_index", handleInvalid="keep")
                  for c in indexed]
        shifted = [f"CASE WHEN `_{c}_index` = {len(fitted.labels[c])} THEN -1D ELSE `_{c}_index` END AS `{code_name(c)}`"
                   for c in indexed]
        steps.append(SQLTransformer(statement="SELECT *, " + ", ".join(shifted) + " FROM __THIS__"))
    names += [code_name(c) for c in fitted.categorical]
    steps.append(VectorAssembler(inputCols=names, outputCol=output, handleInvalid="keep"))
    return PipelineModel(stages=steps)


def transform(df: DataFrame, fitted: Fitted, output: str = FEATURES) -> DataFrame:
    require_features(df, fitted.numeric + fitted.categorical)
    if fitted.joined:
        df = encode_by_join(df, fitted.joined, fitted.code_table, fitted.modes, fitted.unseen)
    helpers = [f"_{c}" for c in fitted.categorical] + [f"_{c}_index" for c in fitted.categorical]
    return stages(fitted, output).transform(df).drop(*helpers)


def require_features(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Columns in the model's order; a missing one is an error at plan time."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"the model needs {', '.join(missing)}; the rows have {', '.join(df.columns)}")
    return df.select(*expected)
