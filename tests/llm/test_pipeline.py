import hashlib
import os
import sys

import pytest
from conftest_llm import SF, UNTIDY, prose
from compare import connect, difference
from test_decontam import brute as leaks
from test_linededup import brute as lines
from test_neardup import brute as copies
from test_quality import counts, failed, verdicts

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402
from ledgerlark.llm import linededup, pieces, quality, registry  # noqa: E402


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_queries_equal_their_sql(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    assert difference(got, connect(SF).execute(registry.SQL[name]).df()) is None


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with the troubles of all stages."""
    import random
    rng = random.Random(11)
    items = [(n, prose(rng, 20)) for n in range(5)]
    base = prose(rng, 80)
    shared = "this very line of text stands in many of the documents here"
    texts = [t for t in UNTIDY if t is None or len(t) < 5000]
    texts += [base, base, base + " end"] + [prose(rng, 25) + "\n" + shared + "\n" + prose(rng, 20) for _ in range(8)]
    texts += [prose(rng, 15) + " " + items[n][1] + " " + prose(rng, 15) for n in range(3)] + ["same words again and again " * 6] * 2
    texts += [prose(rng, rng.randint(12, 60)) for _ in range(15)]
    for n in range(4):                                            # pairs from 80 to 85 percent, and just below 80
        common = prose(rng, 94)
        texts += [common + "".join(f" {side}{n}w{k}" for k in range(10 if n < 3 else 13)) for side in ("left", "right")]
    rows = [(n, t, "en", "bad" if n < 5 else f"s{n % 3}", len(t) if t is not None else None) for n, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_every_stage_equals_brute_force(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "encode"]

    docs = stages["quality_rules"](spark, docs, path).cache()
    assert docs.columns == columns
    rates = verdicts([(i, t, s) for i, t, _, s, _ in rows])
    kept = [r for r in rows if not failed(counts(r[1])) and rates[r[3]] <= quality.MAX_HOST_RATE]
    assert sorted(map(tuple, docs.collect())) == sorted(kept) and len(kept) < len(rows)

    docs = stages["line_dedup"](spark, docs, path).cache()
    assert docs.columns == columns
    shas = {d: sha for d, _, _, sha in lines([(r[0], r[1], r[3]) for r in kept])}
    after = [tuple(r) for r in docs.collect()]
    assert {r[0]: hashlib.sha256(r[1].encode()).hexdigest() for r in after} == shas
    assert all(r[4] == len(r[1]) for r in after) and {r[1] for r in after} != {r[1] for r in kept}

    docs = stages["near_dedup"](spark, docs, path).cache()
    assert docs.columns == columns
    single = {d for d, _, _, kept in copies([(r[0], r[1], r[3]) for r in after], 80) if kept}
    stricter = {d for d, _, _, kept in copies([(r[0], r[1], r[3]) for r in after]) if kept}
    assert len(stricter - single) == 3
    after = [r for r in after if r[0] in single]
    assert sorted(map(tuple, docs.collect())) == sorted(after)

    docs = stages["decontaminate"](spark, docs, path).cache()
    assert docs.columns == columns
    dirty = {after[n][0] for n, *_, hit in leaks([r[1] for r in after], items) if hit}
    after = [r for r in after if r[0] not in dirty]
    assert sorted(map(tuple, docs.collect())) == sorted(after) and dirty

    codec = pieces.PieceCodec(f"{registry.TOKENIZERS}/piece_bpe_32k.model")
    wanted = {r[0]: hashlib.sha256(",".join(map(str, codec.library.encode(r[1]))).encode()).hexdigest() for r in after}
    last = stages["encode"](spark, docs, path).collect()
    assert {r["doc_id"]: r["ids_sha256"] for r in last} == wanted
    assert sorted(map(tuple, corpus_pipeline.run(spark, path).collect())) == sorted(map(tuple, last))


def test_near_dedup_drops_pairs_from_a_similarity_of_80_percent(spark, make, rng):
    base = prose(rng, 94)
    texts = [f"{base} {' '.join(f'{side}{n}' for n in range(10))}" for side in ("left", "right")]
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, make(texts), "")
    assert [r["doc_id"] for r in kept.collect()] == [0]


def test_empty_documents(spark, folder, tmp_path):
    path, _, _ = folder
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_query_is_registered():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
