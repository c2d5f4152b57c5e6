"""From raw documents to encoded training text: the stages, in order, and the whole run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.llm import decontam, linededup, neardup, pieces, quality
from ledgerlark.llm.registry import TOKENIZERS
from ledgerlark.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and whose source is not rejected."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share."""
    return linededup.clean_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near duplicates, of a similarity of 0.8 or more in windows of five words."""
    return neardup.keep_one(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document as digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return pieces.piece_digests(docs, f"{TOKENIZERS}/piece_bpe_32k.model")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: Not expressible in SQL: the stages need a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = scratch_path(spark, f"corpus-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
