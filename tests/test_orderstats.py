import numpy as np
import pytest

from ledgerlark.operators.clean import clip, iqr_bounds, winsorise
from ledgerlark.operators.orderstats import order_statistics, quantiles

CASES = {
    "uniform": lambda r: r.uniform(-5, 5, 3000),
    "third_is_one_value": lambda r: np.where(r.random(3000) < 0.34, 7.25, r.normal(7, 2, 3000)),
    "few_values": lambda r: r.integers(0, 4, 3000).astype(float),
    "constant": lambda r: np.full(3000, 3.5),
    "tiny": lambda r: np.array([1.0, 2.0, 4.0, 9.0]),
}
PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("case", CASES)
def test_narrowing_search_equals_numpy(spark, case):
    values = CASES[case](np.random.default_rng(3))
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    wanted = np.percentile(values, [100 * p for p in PROBABILITIES])
    for small in (10, 10**6):   # forced search, then the one-buffer road
        got = quantiles(df, ["x"], PROBABILITIES, small=small, accuracy=50)["x"]
        assert got == pytest.approx(list(wanted), abs=1e-9)


def test_ranks_of_integers_stay_integers(spark):
    df = spark.createDataFrame([(2**60 + i,) for i in range(500)], "x long")
    got = order_statistics(df, {"x": [0, 250, 499]}, small=5, accuracy=20)["x"]
    assert got == {0: 2**60, 250: 2**60 + 250, 499: 2**60 + 499}


def test_empty_column_has_no_quantiles(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    assert quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [1.0]}
    assert "x" not in iqr_bounds(df, ["x", "y"])


def test_winsorised_values_lie_in_the_fences_and_nulls_stay(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 1000, -500]] + [(None,)], "amt double")
    low, high = iqr_bounds(df, ["amt"])["amt"]
    got = [r[0] for r in winsorise(df, ["amt"]).collect()]
    assert got.count(None) == 1
    assert all(low <= v <= high for v in got if v is not None)
    assert [r[0] for r in clip(df, {"amt": (2.0, 3.0)}).collect()][:3] == [2.0, 2.0, 3.0]


def test_sketch_is_close(spark):
    df = spark.range(100_000).selectExpr("cast(id as double) x")
    assert quantiles(df, ["x"], [0.5], exact=False)["x"][0] == pytest.approx(50_000, abs=50)
