import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import ordered, preprocess
from ledgerlark.operators.sampling import HashOrder
from ledgerlark.functions.hashing import order_hash

ORDER = HashOrder("id", 7)


def table(spark, n=1500):
    """A value with a third of the rows, missing categories and labels, a repeated id, rows without an id."""
    rng = np.random.default_rng(5)
    rows = [(None if i % 97 == 0 else int(i // 2 if i < 40 else i), "hot" if rng.random() < 1 / 3 else f"v{rng.integers(0, 300)}",
             None if rng.random() < .1 else ["a", "é", ""][rng.integers(0, 3)], None if rng.random() < .1 else int(rng.random() < .3), "x")
            for i in range(n)]
    return spark.createDataFrame(rows, "id long, k string, j string, label int, k_code string").repartition(6)


def brute(rows, column, prior, weight):
    out = []
    for r in rows:
        if r[column] is None:
            out.append(prior)
            continue
        before = [q["label"] for q in rows if q[column] == r[column] and q["label"] is not None and q["key"] < r["key"]]
        out.append((sum(before) + prior * weight) / (len(before) + weight))
    return out


@pytest.mark.parametrize("bucket_rows", [100, 10_000])
def test_equal_to_brute_force(spark, bucket_rows):
    df = table(spark)
    got = ordered.ordered_statistics(df, ["k", "j"], "label", ORDER, 0.3, 2.0, bucket_rows)
    assert got.columns == ["id", "k", "j", "label", "k_code", "j_code"]
    hashed = got.withColumn("hash", F.coalesce(order_hash(F.col("id"), 7), F.lit(0))).collect()
    rows = [{**r.asDict(), "key": (r["hash"], "" if r["id"] is None else f"i{r['id']}")} for r in hashed]
    assert len(rows) == 1500
    for c in ("k", "j"):
        assert np.allclose([r[f"{c}_code"] for r in rows], brute(rows, c, 0.3, 2.0))


def test_own_label_is_not_seen(spark):
    df = table(spark)
    turned = df.withColumn("label", F.when(F.col("id") == 800, 1 - F.col("label")).otherwise(F.col("label")))
    a, b = ({r["id"]: r["k_code"] for r in ordered.ordered_statistics(d, ["k"], "label", ORDER).filter("id >= 40").collect()} for d in (df, turned))
    assert a[800] == b[800]


def test_new_rows_get_the_statistic_of_all_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 1), ("b", None), (None, 1)], "k string, label int")
    codes = ordered.target_statistics(df, ["k"], "label")
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "k string")
    got = {r["k"]: r["k_code"] for r in preprocess.encode_by_join(new, ["k"], codes, unseen=0.5).collect()}
    assert got == {"a": 2.5 / 4, "b": 0.5, "z": 0.5, None: 0.5}


def test_empty_table_and_one_row(spark):
    df = table(spark).limit(0)
    assert ordered.ordered_statistics(df, ["k", "j"], "label", ORDER).count() == 0
    one = spark.createDataFrame([(1, None, 1)], "id long, k string, label int")
    assert ordered.ordered_statistics(one, ["k"], "label", ORDER).first()["k_code"] == 0.5
