import hashlib
import random
import re

import pytest
from conftest_llm import SCHEMA, UNTIDY, prose
from pyspark.sql import functions as F

from ledgerlark.llm import secrets

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")


def planted(rng, n, start=0):
    """Documents with real and false candidates, and which are real by (doc, candidate)."""
    rows, real = [], {}
    for doc in range(start, start + n):
        parts = [prose(rng, 12)]
        for _ in range(rng.randint(0, 3)):
            kind = rng.choice(("secret", "digest", "word", "path", "number"))
            if kind == "secret":
                run = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=rng.randint(24, 40)))
                parts.append(rng.choice(('api_key = "{}"', "password: {}", 'token="{}"')).format(run))
            elif kind == "digest":
                run = "".join(rng.choices("0123456789abcdef", k=40))
                parts.append(f"see commit {run} of it")
            elif kind == "word":
                run = "internationalization_of_the_function"
                parts.append(f"about {run} and more")
            elif kind == "path":
                run = "/usr/local/lib/python3/site-packages/" + str(rng.randint(10, 99))
                parts.append(f"in {run} there")
            else:
                run = "".join(rng.choices("0123456789", k=16))
                parts.append(f"number {run} of")
            real[doc, run] = int(kind == "secret")
        rows.append((doc, "\n".join(parts), "s"))
    return rows, real


def test_findings_equal_a_plain_scan(make, rng):
    rows, _ = planted(rng, 40)
    rows += [(100 + n, t, "s") for n, t in enumerate(UNTIDY)] + [(200, "a" * 16 + " " + "b=" * 9, "s"), (201, "é中" + "c" * 20 + "é", "s")]
    got = sorted((r["doc"], r["number"], r["begin"], r["end"], r["candidate"]) for r in secrets.findings(make(rows)).collect())
    wanted = sorted((d, n, m.start(), m.end(), m.group()) for d, t, _ in rows for n, m in enumerate(RUN.finditer(t or "")))
    assert got == wanted


@pytest.mark.parametrize("form", ['aws_secret_access_key = "{}"', "TOKEN={}", "?user=me&access_token={}", "GITHUB_ENTERPRISE_AUTH_TOKEN={}",
                                  "export MY_VERY_LONG_SERVICE_API_KEY='{}'", "secret_key ={}", "x=1_token={}"])
def test_assigned_values_are_candidates_with_their_name(make, form):
    value = "ab12CD34ef56GH78ij90=="
    text = "so " + form.format(value) + " ends"
    found = {r["candidate"]: r for r in secrets.rule_label(secrets.findings(make([text]))).collect()}
    row = found[value]
    assert text[row["begin"]:row["end"]] == value and row["label"] == 1
    assert row["before"] == text[max(0, row["begin"] - 48):row["begin"]] and row["after"] == text[row["end"]:row["end"] + 48]
    told = secrets.described(secrets.findings(make([text]))).filter(F.col("candidate") == value).first()["features"]
    assert told[secrets.FEATURES.index("named")] == told[secrets.FEATURES.index("assigned")] == 1


def test_context_is_a_slice_of_the_text(make, rng):
    texts = ["".join(rng.choice(("a1" * rng.randint(1, 20), " ", "=", "é", "token=", "b" * 16, "/", "\n")) for _ in range(60)) for _ in range(40)]
    texts += ["k=" * 50000, "=" * 50000, "a" * 50000 + "=" + "b" * 50000]
    got = secrets.findings(make(texts)).collect()
    assert len(got) > 200
    for r in got:
        text = texts[r["doc"]]
        assert text[r["begin"]:r["end"]] == r["candidate"]
        assert r["before"] == text[max(0, r["begin"] - 48):r["begin"]] and r["after"] == text[r["end"]:r["end"] + 48]


def test_runs_that_assign_a_short_value_are_no_negatives(make):
    rows = secrets.rule_label(secrets.findings(make(["password=abcdefghijkl here", "plainlettersaloneinalongword"]))).collect()
    assert {r["candidate"]: r["label"] for r in rows} == {"password=abcdefghijkl": None, "plainlettersaloneinalongword": 0}


def test_held_out_accuracy(spark, make):
    rows, real = planted(random.Random(5), 400)
    found = secrets.findings(make(rows))
    labels = spark.createDataFrame([(d, c, y) for (d, c), y in real.items()], "doc long, candidate string, label int")
    labelled = found.join(labels, ["doc", "candidate"])
    forest = secrets.fit(labelled.filter("doc % 4 <> 2"), trees=20)
    told = secrets.score(labelled.filter("doc % 4 = 2"), forest).collect()
    assert len(told) > 80 and {r["label"] for r in told} == {0, 1}
    assert sum((r["score"] > 0.5) == bool(r["label"]) for r in told) >= 0.97 * len(told)


def test_rows(make, rng):
    rows, _ = planted(rng, 60)
    got = secrets.secret_rows(make(rows)).collect()
    texts = {d: t for d, t, _ in rows}
    for r in got:
        assert r["sha256"] == hashlib.sha256(texts[r["doc_id"]][r["begin"]:r["end"]].encode()).hexdigest()
        assert 0 <= r["score"] <= 1 and r["secret"] == (r["score"] > secrets.THRESHOLD)
    assert all(r["secret"] for r in got if r["label"] == 1) and not any(r["secret"] for r in got if r["label"] == 0)


def test_few_positives_among_many_negatives_are_all_used(make, rng):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rows = [(n, 'token = "a1' + "".join(rng.choices(letters, k=30)) + '"', "s") for n in range(5)]
    rows += [(10 + n, "number " + "".join(rng.choices("0123456789", k=20)) + " of", "s") for n in range(3000)]
    found = secrets.rule_label(secrets.findings(make(rows)))
    told = secrets.score(found, secrets.fit(found, max_rows=60)).collect()
    assert len(told) == 3005 and all((r["score"] > 0.5) == bool(r["label"]) for r in told)


@pytest.mark.parametrize("texts,scores", [([], set()), (["plain words only"], set()), ([None, ""], set()),
                                          (["number 1234567890123456"], {0.0}), (["token = a1b2c3d4e5f6a7b8c9"], {1.0})])
def test_without_two_kinds_of_labels(spark, make, texts, scores):
    df = make(texts) if texts else spark.createDataFrame([], SCHEMA)
    assert {r["score"] for r in secrets.secret_rows(df).collect()} == scores


def test_no_python_in_the_plan(make, rng):
    rows, _ = planted(rng, 60)
    plan = secrets.secret_rows(make(rows).withColumn("features", F.lit(1)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
