"""The corpus operators as named queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bestposition, decontam, language, licenses, linededup, neardup, pages, pieces, prefixtrie, quality, secrets, tokencounts,
    tokenfiles)

TOKENIZERS = os.environ.get("LEDGERLARK_TOKENIZERS", "/opt/tokenizers")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rows(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_rows(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group_rows(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digests(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_file_digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.section_rows(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op7_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_rows(table(spark, sf_dir, "documents"))


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leak_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_rows(table(spark, sf_dir, "documents"))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_rows(table(spark, sf_dir, "pages"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestposition.search_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.node_rows(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality_rules, op2_secret_scan, op3_near_duplicates, op4_line_dedup, op5_token_files, op6_token_counts,
    op7_piece_encoding, op8_license_scan, op9_benchmark_leaks, op10_language, op11_html_text, op12_ranked_search,
    op13_prefix_trie)}

SQL: dict[str, str] = {
    "op1_quality_rules": quality.SQL,
    "op3_near_duplicates": neardup.SQL,
    "op4_line_dedup": linededup.SQL,
    "op9_benchmark_leaks": decontam.SQL,
    "op12_ranked_search": bestposition.SQL,
    "op13_prefix_trie": prefixtrie.SQL,
}
