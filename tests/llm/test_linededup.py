import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest_llm import SCHEMA, UNTIDY, prose
from pyspark.sql import functions as F

from ledgerlark.llm import linededup


def brute(rows):
    """(doc_id, n_lines, n_dropped, sha) per row."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for doc, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(doc)
    out = []
    for doc, text, _ in rows:
        lines = (text or "").split("\n")
        order = lambda d: (d is not None, d if d is not None else 0)
        kept = [x for x in lines if len(holders.get(key(x), ())) < 5 or doc == max(holders[key(x)], key=order)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture
def rows(rng):
    shared = [prose(rng, 12) + f" {n}" for n in range(6)]
    shared.append("é" * 39)
    shared.append("é" * 40)
    texts = []
    for n in range(80):
        lines = [rng.choice(shared) for _ in range(rng.randint(0, 4))] + [prose(rng, rng.randint(0, 12)) for _ in range(3)]
        lines = [f" \t{x.upper() if rng.random() < 0.3 and x.isascii() else x}\r" for x in lines] + ["hot line, " * 5]
        rng.shuffle(lines)
        texts.append("\n".join(lines))
    return [(n, t, "s") for n, t in enumerate(UNTIDY + texts)]


@pytest.mark.parametrize("parts", [1, 13])
def test_equals_brute_force(spark, make, rows, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = linededup.line_digests(make(rows, parts=4)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_a_hot_line_spreads_over_ranges(spark, make):
    line = "the very same line that stands in every document of the table"
    rows = [(n, f"{line}\nown line number {n} that nobody else has in the table", "s") for n in range(400)]
    hashes = linededup.line_hashes(make(rows).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("digest"), "text"))
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranges = hashes.repartitionByRange("h1", "h2", F.col("doc").desc())
        key = hashes.groupBy("h1", "h2").count().filter("count > 1").first()
        hot = ranges.filter((F.col("h1") == key["h1"])).select(F.spark_partition_id().alias("p")).distinct().count()
        got = linededup.line_digests(make(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert hot > 3
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_repeated_rows_and_missing_ids(make):
    line = "a line of more than forty characters, shared by all of them"
    rows = [(1, line, "s")] * 3 + [(2, line, "s"), (2, f"{line}\nmore", "s"), (3, line, "s"), (None, line, "s"), (None, line, "s")]
    got = sorted(map(tuple, linededup.line_digests(make(rows)).collect()), key=repr)
    assert got == brute(rows)
    assert sum(g[2] for g in got) == 0        # four documents only: 1, 2, 3 and the one without id
    rows.append((4, line.upper(), "s"))
    got = sorted(map(tuple, linededup.line_digests(make(rows)).collect()), key=repr)
    assert got == brute(rows) and sum(g[2] for g in got) == 8


def test_bitmaps_hold_no_text(make):
    line = "a line of more than forty characters, shared by all of them"
    rows = [(n, f"one\n{line}\ntwo", "s") for n in range(6)]
    docs = make(rows).select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("digest"), "text")
    bitmaps = linededup.keep_bitmaps(docs).collect()
    assert sorted(b["doc"] for b in bitmaps) == [0, 1, 2, 3, 4]
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmaps[0]["keep"]), np.uint8)).tolist()
    assert bits[:3] == [1, 0, 1]


def test_columns_and_empty_table(spark, make):
    line = "a line of more than forty characters, shared by all of them"
    df = make([(n, line, "s") for n in range(5)]).withColumn("n_lines", F.lit("mine")).withColumn("keep", F.lit(1))
    done = linededup.clean_lines(df)
    assert done.columns == df.columns
    assert sorted((r["doc_id"], r["text"], r["n_chars"], r["n_lines"]) for r in done.collect())[3:] == [
        (3, "", 0, "mine"), (4, line, len(line), "mine")]
    assert linededup.line_digests(spark.createDataFrame([], SCHEMA)).count() == 0
