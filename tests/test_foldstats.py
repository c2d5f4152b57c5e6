import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerlark.operators import foldstats, preprocess


def table(spark, n=3000):
    """A third of the values equal, missing ones, a constant, a value that one fold alone holds, and rows of no fold."""
    rng = np.random.default_rng(3)
    heavy = np.where(rng.random(n) < 1 / 3, 7.25, np.exp(rng.normal(size=n) * 3))
    rows = []
    for i in range(n):
        fold = int(rng.integers(0, 4))
        rows.append((i, None if rng.random() < .2 else float(heavy[i]), float(rng.integers(-5, 5)), 0.1, None,
                     None if rng.random() < .1 else f"w{rng.zipf(1.5) % 50}", "only" if fold == 2 and i % 100 else "é'x", None, fold if i % 100 else None))
    return spark.createDataFrame(rows, "id long, heavy double, small double, flat double, empty double, word string, lone string, none string, fold int").repartition(5)


NUMERIC, CATEGORICAL = ["heavy", "small", "flat", "empty"], ["word", "lone", "none"]


def same(got, wanted):
    assert got.medians == wanted.medians and got.modes == wanted.modes and got.labels == wanted.labels
    for c in wanted.means:
        assert got.means[c] == pytest.approx(wanted.means[c], rel=1e-12, abs=1e-12)
        assert got.deviations[c] == pytest.approx(wanted.deviations[c], rel=1e-10)


@pytest.mark.parametrize("fetch", [5000, 40])
def test_equal_to_separate_fits(spark, fetch):
    df = table(spark)
    fits = foldstats.fit_folds(df, NUMERIC, CATEGORICAL, "fold", 4, fetch=fetch)
    assert len(fits) == 5
    for m, got in enumerate(fits):
        rows = df.filter(F.coalesce("fold", F.lit(-1)) != m) if m < 4 else df
        same(got, preprocess.fit(rows, NUMERIC, CATEGORICAL))
    assert fits[2].labels["lone"] == ["é'x"] and fits[0].labels["lone"] == ["only", "é'x"]


def test_long_vocabularies_by_code_table(spark):
    df = table(spark)
    small, long = (foldstats.fit_folds(df, [], ["word", "lone"], "fold", 4, max_labels=m) for m in (100, 10))
    for m, (a, b) in enumerate(zip(small, long)):
        assert b.joined == ["word"] and a.joined == []
        codes = [{r["id"]: tuple(r["f"]) for r in preprocess.transform(df, f).select("id", vector_to_array("features").alias("f")).collect()}
                 for f in (a, b)]
        assert codes[0] == codes[1], m


def test_empty_tables_and_folds(spark):
    df = table(spark)
    for rows in (df.limit(0), df.filter("fold = 1")):
        fits = foldstats.fit_folds(rows, NUMERIC, CATEGORICAL, "fold", 4)
        same(fits[1], preprocess.fit(df.limit(0), NUMERIC, CATEGORICAL))
        same(fits[4], preprocess.fit(rows, NUMERIC, CATEGORICAL))
