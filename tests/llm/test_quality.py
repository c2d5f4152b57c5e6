import re
from collections import Counter

import pytest
from conftest_llm import SCHEMA, UNTIDY, prose
from pyspark.sql import functions as F

from ledgerlark.llm import quality


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def failed(c):
    return c[0] < 10 or 100 * c[4] > 20 * c[0]


@pytest.fixture
def rows(rng):
    texts = list(UNTIDY)
    for _ in range(60):
        line = prose(rng, rng.randint(1, 9))
        extra = [line] * rng.randint(0, 3) + [prose(rng, rng.randint(0, 30)) + rng.choice(("", " ##", "$<>"))]
        texts.append("\n".join([prose(rng, rng.randint(0, 40)), *extra, rng.choice(("", "  ", " "))]))
    out = [(n, t, rng.choice(("a", "b", "c", None))) for n, t in enumerate(texts)]
    out += [(500 + n, "junk", "bad") for n in range(60)] + [(580 + n, prose(rng, 30), "bad") for n in range(4)]
    return out + [(600, "junk", "tiny"), (601, prose(rng, 30), "lone")]


def verdicts(rows):
    hosts = {}
    for _, text, host in rows:
        if host is not None:
            n, k = hosts.get(host, (0, 0))
            hosts[host] = (n + 1, k + failed(counts(text)))
    docs = sum(n for n, _ in hosts.values())
    mean = sum(k for _, k in hosts.values()) / docs
    _, weight = quality.prior(len(hosts), docs, mean, sum(k * k / n for n, k in hosts.values()) / docs)
    return {h: (k + mean * weight) / (n + weight) for h, (n, k) in hosts.items()}


def test_equals_brute_force(make, rows):
    rates = verdicts(rows)
    assert rates["bad"] > quality.MAX_HOST_RATE > rates["a"]
    got = sorted(tuple(r) for r in quality.quality_rows(make(rows)).collect())
    wanted = []
    for doc, text, host in rows:
        c = counts(text)
        good = not failed(c) and rates.get(host, 0) <= quality.MAX_HOST_RATE
        wanted.append((doc, *c, failed(c), good))
    assert got == sorted(wanted)


def test_shrinking(spark):
    """One failure in one document proves less than sixty in sixty."""
    rows = [("tiny", True)] + [("good", False)] * 95 + [("good", True)] * 5 + [("fair", False)] * 90 + [("fair", True)] * 10 + [("bad", True)] * 60
    rates = {r["host"]: r["rate"] for r in quality.host_rates(spark.createDataFrame(rows, "h string, f boolean"), "h", "f").collect()}
    assert 0.05 < rates["good"] < rates["fair"] < rates["tiny"] < rates["bad"] < 1
    assert quality.prior(1, 10, 0.3, 0.09) == (0.3, 1e6)       # a single host: no spread


def test_keep_good_keeps_columns(make, rows, spark):
    df = make(rows).withColumnRenamed("lang", "failed").withColumn("counts", F.lit(1))
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in quality.quality_rows(make(rows)).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == ids and 601 in ids and 581 not in ids
    assert quality.quality_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(make, rows):
    plan = quality.judged(make(rows))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
