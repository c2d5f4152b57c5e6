"""Run records: parameters and metrics of training runs as rows of one parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.schema import RUN_SCHEMA


def append_run(spark: SparkSession, path: str, run_name: str, params: dict, metrics: dict,
               fold_metrics: DataFrame | None = None) -> None:
    """Append one run: ``param`` and ``metric`` rows, and ``metric`` rows per fold."""
    rows = [(run_name, "param", k, None, str(v)) for k, v in params.items()]
    rows += [(run_name, "metric", k, None, repr(float(v))) for k, v in metrics.items() if v is not None]
    records = spark.createDataFrame(rows, RUN_SCHEMA)
    if fold_metrics is not None:
        records = records.unionByName(fold_metrics.select(
            F.lit(run_name).alias("run_name"), F.lit("metric").alias("kind"), F.col("metric").alias("key"),
            F.col("fold").cast("int").alias("fold"), F.col("value").cast("string").alias("value")))
    records.coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)
