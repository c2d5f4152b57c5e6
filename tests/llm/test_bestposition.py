import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import SF, UNTIDY, prose

from ledgerlark.llm import bestposition
from ledgerlark.llm.registry import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(documents, items, k=20):
    """Every document scored for every item."""
    docs = [(i, Counter(split(t))) for i, t in documents]
    n_docs, n_terms = sum(bool(c) for _, c in docs), sum(sum(c.values()) for _, c in docs)
    held = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts in docs:
            score, n = 0, sum(counts.values())
            for w in split(text):
                if counts[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[w] + 1)))
                    score += weight * (1_000_000_000 * counts[w] // (1000 * counts[w] + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))
            if score > 0:
                found.append((-score, doc is None, 0 if doc is None else doc))
        out += [(item, rank, None if null else doc, -score) for rank, (score, null, doc) in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.fixture
def case(rng):
    words = [prose(rng, 1) for _ in range(300)]
    def text(n):
        return rng.choice([" ", ", ", "\n", "_"]).join(w.upper() if rng.random() < .2 else w for w in rng.choices(words, [1 / (r + 1) for r in range(300)], k=n))
    texts = [text(rng.choice([1, 5, 40, 200])) for _ in range(300)]
    rows = [(n, t, "s") for n, t in enumerate(texts + texts[:30] + list(UNTIDY))]
    rows += [(None, texts[3], "s"), (None, texts[3], "s"), (7, texts[9], "s"), (7, texts[9], "t")]
    items = [(n, text(rng.randint(1, 40))) for n in range(12)] + [(50, None), (51, ""), (52, "!?"), (53, "word word x"), (4, text(9)), (None, text(5))]
    items += [(60, texts[0]), (61, "unheard of words")]
    return rows, items


@pytest.mark.parametrize("chunk,step,block", [(1 << 21, 64, 1_000_000), (500, 1, 1_000_000), (2000, 7, 400)])
def test_equals_brute_force(spark, make, case, monkeypatch, chunk, step, block):
    rows, items = case
    monkeypatch.setattr(bestposition, "CHUNK_POSTINGS", chunk)
    monkeypatch.setattr(bestposition, "STEP", step)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumnsRenamed({"text": "words"})
    got = bestposition.search(make(rows, 5), bench, item_text="words", block_chars=block).collect()
    wanted = brute([(i, t) for i, t, _ in rows], items)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(wanted, key=key)


def test_text_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "one two", 1), ("a", "two one", 2), ("c", None, 3), ("d", "three", 4), ("e", "four", 5)], "doc_id string, text string, score int")
    items = spark.createDataFrame([("x", "one")], "item_id string, text string")
    got = bestposition.search(docs, items).orderBy("rank").collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in got] == [("x", 1, "a"), ("x", 2, "b")] and got[0]["score"] == got[1]["score"]
    assert bestposition.search(docs.limit(0), items).collect() == bestposition.search(docs, items.limit(0)).collect() == []
    assert bestposition.search(docs.filter("text IS NULL"), items).collect() == []


def _chunk(rng, n_docs, n_terms=6):
    depth = rng.exponential(1.0, n_docs)                      # some documents are about the terms, most are not
    held = [(d, t, 1 + int(rng.poisson(depth[d]))) for d in range(n_docs) for t in range(n_terms) if rng.random() < 0.6]
    docs, codes, counts = map(np.array, zip(*held))
    return bestposition.Chunk(pa.array(range(n_docs)), np.full(n_docs, 50), docs, codes, counts, n_docs, 50 * n_docs)


def test_stops_early_and_exactly():
    rng = np.random.default_rng(5)
    chunk = _chunk(rng, 20_000)
    query = [(t, w) for t, w in enumerate((900, 700, 650, 300, 20, 0))]
    top = bestposition.Top(20)
    scored = chunk.search(query, top)
    scores = np.zeros(20_000, dtype=np.int64)
    for code, weight in query:
        found = chunk.list_of(code)
        scores[found.docs] += weight * found.impacts
    best = np.lexsort((np.arange(20_000), -scores))[:20]
    assert top.pairs == list(zip(scores[best].tolist(), best.tolist()))
    assert scored < 10_000                                    # most documents are never looked at
    again = bestposition.Top(20)
    again.pairs = [(top.pairs[0][0] + 1, -1)] * 20            # an earlier chunk had better ones
    assert chunk.search(query, again) <= scored and {d for _, d in again.pairs} == {-1}


def test_equal_scores_are_read_to_the_end():
    n = 5000
    docs, ones = np.arange(n), np.ones(n, dtype=np.int64)
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    chunk = bestposition.Chunk(pa.array(ids), ones * 4, docs, np.zeros(n, dtype=np.int64), ones, n + 1, 4 * n)
    top = bestposition.Top(20)
    assert chunk.search([(0, 10)], top) == n and [d for _, d in top.pairs] == list(range(20))


def test_query_on_the_tables(spark):
    got = QUERIES["op12_ranked_search"](spark, SF).collect()
    docs, items = (list(map(tuple, spark.read.parquet(f"{SF}/{t}.parquet").select(c, "text").collect())) for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == sorted(brute(docs, items))
