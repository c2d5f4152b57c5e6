import itertools
import zlib

import numpy as np
import pytest
from conftest_llm import SCHEMA, SF, UNTIDY
from pyspark.sql import functions as F

from ledgerlark.llm import language


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.learn(docs.filter(~language.held_out(F.col("doc_id"))).select("lang", "text"))


def test_held_out_accuracy(docs):
    told = language.language_rows(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in told)
    tested = [r for r in told if r["held_out"]]
    assert len(told) == docs.count() and len(tested) > 30
    assert sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in told)


def test_a_mixture_is_found(docs, model):
    rows = {lang: [r["text"] for r in docs.filter((F.col("lang") == lang) & (F.col("n_chars") > 2000)).orderBy("doc_id").limit(3).collect()]
            for lang in ("en", "fr", "de")}
    shares = model.shares(rows["en"][0][:2000] + " " + rows["fr"][0][:1000])
    assert set(shares) == {"en", "fr"} and 0.5 < shares["en"] < 0.8 and abs(sum(shares.values()) - 1) < 1e-6
    assert set(model.shares(rows["de"][0])) == {"de"}


def test_the_held_out_rows_teach_nothing(docs):
    changed = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    told = language.language_rows(changed)
    assert told.filter("lang_pred = 'xx'").count() == 0
    assert sorted(map(tuple, told.collect())) == sorted(map(tuple, language.language_rows(docs).collect()))


def test_counts_are_exact_and_summed(spark, docs):
    rows = docs.filter("lang = 'es'").select("lang", "text").repartition(5)
    import numpy as np
    total = sum(np.bincount(language.trigrams(r["text"]), minlength=language.BUCKETS) for r in rows.collect())
    got = np.zeros(language.BUCKETS, dtype=np.int64)
    for r in language.count_trigrams(rows).collect():
        got[r["part"] * language.RANGE:(r["part"] + 1) * language.RANGE] += np.frombuffer(r["counts"], "<i8")
    assert (got == total).all()


def test_untidy_and_empty(spark, make, model):
    rows = language.predict(make(UNTIDY + ["123 !?", "é"]).withColumn("score", F.lit("old")), model).collect()
    told = {r["doc_id"]: r for r in rows}
    assert [told[n]["lang_pred"] for n in (0, 1, 2, 3, len(UNTIDY))] == ["und"] * 5
    assert all(r["score"] == 0.0 for r in rows if r["lang_pred"] == "und")
    assert told[len(UNTIDY) + 1]["lang_pred"] in ("de", "en", "es", "fr")
    empty = spark.createDataFrame([], SCHEMA)
    assert language.language_rows(empty).count() == 0
    unlabelled = make(["some words here"]).withColumn("lang", F.lit(None).cast("string"))
    assert language.language_rows(unlabelled).first()["lang_pred"] == "und"
    no_id = make([(None, "some words here", "s"), (1, "some words", "s"), (2, "more words", "s")])
    assert {r["held_out"] for r in language.language_rows(no_id).filter("doc_id IS NULL").collect()} == {False}


def brute_selection(likely, counts):
    """The set of up to four languages with the greatest penalised likelihood, shares by many small steps."""
    cost = language.PENALTY * 0.5 * np.log(counts.sum() + 1)
    best = None
    for size in range(1, 5):
        for chosen in itertools.combinations(range(likely.shape[1]), size):
            shares = np.full(size, 1 / size)
            for _ in range(600):
                joint = likely[:, chosen] * shares
                shares = (counts / joint.sum(axis=1)) @ joint / counts.sum()
            value = counts @ np.log(likely[:, chosen] @ shares) - cost * size
            if best is None or value > best[0]:
                best = (value, chosen, shares)
    return best


@pytest.mark.parametrize("weights", [(1,), (3, 1), (1, 1, 1), (5, 2, 2, 1), (20, 1), (60, 1)])
def test_selection_equals_the_best_of_all_subsets(weights):
    rng = np.random.default_rng(len(weights) + weights[0])
    models = rng.dirichlet(np.full(400, 0.15), 6)
    models = (models + 1e-5) / (models + 1e-5).sum(axis=1, keepdims=True)
    models[5] = 0.5 * models[0] + 0.5 * models[1]              # tempting at first, not needed in the end
    for n in (30, 300, 3000):
        drawn = rng.choice(400, n, p=np.average(models[:len(weights)], axis=0, weights=weights))
        buckets, counts = np.unique(drawn, return_counts=True)
        likely = models[:, buckets].T
        value, chosen, shares = brute_selection(likely, counts)
        got, own = language.select(likely, counts)
        # The fifth model makes different sets equally good; what counts is the penalised likelihood.
        cost = language.PENALTY * 0.5 * np.log(counts.sum() + 1)
        assert abs(counts @ np.log(likely[:, got] @ own) - cost * len(got) - value) < 0.05
        if 5 not in got and 5 not in chosen:
            assert sorted(got) == sorted(chosen) and np.abs(own[np.argsort(got)] - shares).max() < 0.02


def test_estimate_reaches_the_maximum():
    rng = np.random.default_rng(4)
    likely, counts = rng.random((50, 2)) + 0.01, rng.integers(1, 9, 50)
    shares, fit = language.estimate(likely, counts)
    grid = [(float(counts @ np.log(likely @ np.array([s, 1 - s]))), s) for s in np.linspace(0, 1, 2001)]
    assert abs(fit - max(grid)[0]) < 0.02 and abs(shares[0] - max(grid)[1]) < 0.05


def test_more_languages_than_a_block_holds(spark, docs, model):
    rows = docs.select(F.concat("lang", F.lit("-"), F.pmod("doc_id", F.lit(3)).cast("string")).alias("lang"), "text")
    parts = {size: language.learn(rows, size) for size in (500, 5)}
    assert [m.n_blocks for m in parts.values()] == [1, 3]
    told = {size: {r["doc_id"]: r for r in language.predict(docs.select("doc_id", "text", "lang"), m).collect()} for size, m in parts.items()}
    assert all(told[500][d]["lang_pred"][:2] == told[5][d]["lang_pred"][:2] for d in told[5])
    same = sum(told[500][d]["lang_shares"].keys() == told[5][d]["lang_shares"].keys() for d in told[5])
    assert same > 0.9 * len(told[5])
    text = docs.filter("lang = 'fr' AND n_chars > 3000").first()["text"]
    assert set(model.shares(text)) == {"fr"}


def test_six_hundred_languages(spark):
    rng = np.random.default_rng(6)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(1200)]
    rows = [(4 * n + k, " ".join(words[2 * n:2 * n + 2] * 8), f"l{n:03}", "s", 1) for n in range(600) for k in range(2)]
    told = language.language_rows(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    lang = {r[0]: r[2] for r in rows}
    taught = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2}
    right = [r["lang_pred"] == lang[r["doc_id"]] for r in told if lang[r["doc_id"]] in taught]
    assert len(told) == 1200 and sum(right) > 0.99 * len(right)


def test_clashing_names(make, model):
    clashing = make(["the words of this text are here"]).withColumnsRenamed({"lang": "language_text", "source": "language_set"})
    row = language.predict(clashing, model).first()
    assert row["language_text"] == "en" and row["language_set"] == "s0" and row["lang_pred"] == "en"
    replaced = language.predict(make(["the words of this text are here"]), model, lang="text")
    assert replaced.columns.count("text") == 1 and replaced.first()["text"] == "en"
