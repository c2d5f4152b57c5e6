import hashlib
import re

import pytest
from conftest_llm import SCHEMA, UNTIDY, prose

from ledgerlark.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(texts, items):
    out = []
    for n, text in enumerate(texts):
        w, hit, met = split(text), set(), set()
        for item, words in items:
            iw = split(words)
            size = min(10, len(iw))
            windows = {tuple(iw[i:i + size]) for i in range(len(iw) - size + 1)} if iw else set()
            for i in range(len(w) - size + 1 if size else 0):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    met.add(item)
        listed = ",".join(sorted(str(m) for m in met if m is not None))
        out.append((n, len(w), len(hit), len([m for m in met if m is not None]), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


@pytest.fixture
def case(rng):
    items = [(n, prose(rng, rng.randint(8, 30))) for n in range(25)]
    items += [(90, "Short one."), (91, "short"), (91, "other words here"), (92, None), (93, "!!"), (None, prose(rng, 14)), (94, items[0][1])]
    texts = list(UNTIDY)
    for _ in range(60):
        text = prose(rng, rng.randint(0, 60)).split(" ")
        item = rng.choice(items)[1] or ""
        words = item.split(" ")
        at = rng.randint(0, len(text))
        lo = rng.randint(0, len(words))
        text[at:at] = [w.upper() if rng.random() < 0.2 else f"({w})" for w in words[lo:lo + rng.randint(5, 25)]]
        texts.append(rng.choice((" ", "\n", " — ")).join(text))
    return texts, items


@pytest.mark.parametrize("block", [8_000_000, 300])
def test_equals_brute_force(spark, make, case, block, monkeypatch):
    texts, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "find_leaks", _with_block(decontam.find_leaks, block))
    got = decontam.leak_digests(make(texts), bench).collect()
    assert sorted(map(tuple, got)) == brute(texts, items)


def _with_block(find, block):
    return lambda df, items, **more: find(df, items, block_chars=block, **more)


def test_spans_point_into_the_original(spark, make):
    item = "one two three four five six seven eight nine ten eleven"
    text = "Ünd — ONE, two three: four five six seven eight nine ten! eleven. after"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = decontam.find_leaks(make([text]), bench).first()
    (span,) = row["leak_spans"]
    assert text[span["begin"]:span["end"]] == "ONE, two three: four five six seven eight nine ten! eleven"
    assert (span["first_word"], span["last_word"]) == (2, 12)       # the dash is a word of its own
    assert row["leak_items"] == ["1"]


def test_empty_tables_and_columns(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontam.leak_digests(make(UNTIDY), none).collect())
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontam.leak_digests(spark.createDataFrame([], SCHEMA), some).count() == 0
    clean = decontam.clean_rows(make(["a", "b", "A"]).withColumnRenamed("lang", "n_words"), some)
    assert [(r["doc_id"], r["n_words"]) for r in clean.collect()] == [(1, "en")]
