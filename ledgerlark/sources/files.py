"""CSV sources: header scan, merge of two files, fallback when the message source is empty or fails."""

from __future__ import annotations

import logging
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

logger = logging.getLogger(__name__)

# Blanks belong to the value; the writer would trim them by default.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header scan with a declared schema; the empty field is NULL.

    Columns are found by their name in the header, wherever they stand; others are left out, so a leading index column
    shifts nothing. Declared columns that the header lacks are left out too, and the check for required columns sees
    that they are missing. A file without any declared column, or files with different headers, are errors.
    """
    header = spark.read.options(**CSV_OPTIONS).csv(path).schema
    found = [f for f in schema if f.name in header.names]
    if not found:
        raise ValueError(f"the header of {path} has none of the columns {', '.join(schema.names)}")
    rows = spark.read.options(**CSV_OPTIONS, enforceSchema="false").schema(header).csv(path)
    return rows.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in found])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def merge_csv(spark: SparkSession, first: str, second: str, schema: T.StructType, output: str,
              index: str | None = None) -> DataFrame:
    """Both files under one header, without the index column."""
    both = read_csv(spark, first, schema).unionByName(read_csv(spark, second, schema), allowMissingColumns=True)
    merged = both.drop(index) if index else both
    write_csv(merged, output)
    return read_csv(spark, output, merged.schema).select(merged.columns)


def read_with_fallback(primary: Callable[[], DataFrame], fallback: Callable[[], DataFrame]) -> DataFrame:
    """The primary source, or the fallback when it cannot be read or is empty.

    Any failure of Spark or its connector counts, also one that is only known as a Java exception. Emptiness is tested
    with a limit-1 read, not a count.
    """
    try:
        df = primary()
        if not df.isEmpty():
            return df
        logger.warning("no messages retrieved; using the fallback source")
    except (PySparkException, Py4JError, OSError) as failure:
        logger.warning("message source failed (%s); using the fallback source", str(failure).partition("\n")[0])
    return fallback()
