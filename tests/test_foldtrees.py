import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.functions.hashing import order_hash
from ledgerlark.operators import boosting, foldtrees, models, ordered, scoring
from ledgerlark.operators.sampling import HashOrder
from ledgerlark.plans import training
from ledgerlark.session import scratch_path
from ledgerlark.views import txn

SF = "/root/testdata/sf0.001"
ORDER = HashOrder("id", 7)


def table(spark, n=900, folds=3):
    rng = np.random.default_rng(3)
    x, z = rng.integers(0, 20, n), rng.integers(0, 9, n)
    y = ((x > 12) ^ (z > 5) ^ (rng.random(n) < .1)).astype(int)
    rows = [(f"r{i}", float(a) if i % 11 else None, float(b), int(c), i % folds) for i, (a, b, c) in enumerate(zip(x, z, y))]
    return spark.createDataFrame(rows, "id string, x double, z double, y int, fold int").repartition(5)


def grown(df, p, values, folds=3, boosted=True, weights={0: 1.0, 1: 2.0}):
    lessons = [foldtrees.Lesson(weights, [0, 1], [0, 1], np.array(values)) for _ in range(folds + 1)]
    return foldtrees.grow(foldtrees.written(df, "id", ["x", "z"], [0, 1], "y", "fold", lessons, p.bins), p, boosted)


def test_equal_to_the_booster_by_passes_of_its_own(spark):
    df, p = table(spark), boosting.BoostingParams(7, .3, 3, row_share=.7, column_share=.5, min_rows=3, seed=5)
    want = boosting.boost(df.withColumn("w", F.when(F.col("y") == 1, 2.0).otherwise(1.0)), ["x", "z"], "y", p, "id", "w", "fold", 3)
    got = grown(df, p, [np.nan, np.nan])
    a = {r["id"]: r["score"] for r in want.score(df, fold="fold").collect()}
    b = {r["id"]: r["score"] for r in got.held_out("id").collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-5


def test_early_stop_is_the_booster_s(spark):
    df, p = table(spark), boosting.BoostingParams(30, .5, 3, patience=3, seed=5)
    want = boosting.boost(df, ["x", "z"], "y", p, "id", None, "fold", 3)
    got = grown(df, p, [np.nan, np.nan], weights={0: 1.0, 1: 1.0})
    assert [len(t) for t in got.trees[:3]] == [len(t) for t in want.trees[:3]] and len(got.trees[0]) < 30
    for a, b in zip(got.losses[:3], want.losses):
        assert np.allclose(a[:len(b)], b[:len(a)], atol=1e-6)


@pytest.mark.parametrize("gathered", [foldtrees.GATHERED, 0])
def test_single_tree_is_that_of_a_recursion_by_gini(spark, monkeypatch, gathered):
    monkeypatch.setattr(foldtrees, "GATHERED", gathered)
    df = table(spark)
    rows = np.array([[4.0 if r["x"] is None else r["x"], r["z"], r["y"], r["fold"]] for r in df.collect()])
    p = boosting.BoostingParams(max_depth=4, min_rows=5, l2=0.0, min_child_weight=0.0)
    got = {r["id"]: r["score"] for r in grown(df, p, [4.0, np.nan], boosted=False).held_out("id").collect()}

    def gini(part):
        w1, w0 = 2.0 * part[:, 2].sum(), (1 - part[:, 2]).sum()
        return 2 * w0 * w1 / (w0 + w1) if len(part) else 0.0

    def leaf(part, row, depth):
        best = None
        for f in (0, 1):
            for edge in np.unique(part[:, f])[:-1]:
                sides = part[part[:, f] <= edge], part[part[:, f] > edge]
                gain = round((gini(part) - gini(sides[0]) - gini(sides[1])) / 4, 9)
                if min(map(len, sides)) >= 5 and gain > 0 and (best is None or gain > best[0] + 1e-7):
                    best = gain, f, edge, sides
        if depth == 4 or best is None:
            return 2.0 * part[:, 2].sum() / (2.0 * part[:, 2].sum() + (1 - part[:, 2]).sum())
        return leaf(best[3][0 if row[best[1]] <= best[2] else 1], row, depth + 1)

    for r in df.limit(40).collect():
        row = np.array([4.0 if r["x"] is None else r["x"], r["z"]])
        assert got[r["id"]] == pytest.approx(leaf(rows[rows[:, 3] != r["fold"]], row, 0), abs=1e-9)


def test_a_model_is_judged_by_what_its_rows_taught(spark):
    lesson = foldtrees.Lesson({}, [0, 1], [0, 1], np.array([2.5, 1.0]), {1: np.array([True, True, False])})
    x = np.array([[np.nan, 0.0], [1.0, 2.0], [3.0, np.nan], [3.0, -1.0]])
    assert lesson.judged(x).tolist() == [[2.5, 0.0], [1.0, -1.0], [3.0, 1.0], [3.0, -1.0]]


def test_ordered_statistics_of_all_folds_are_those_of_each(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i // 2 if i < 40 else i), "hot" if rng.random() < .3 else None if rng.random() < .1 else f"v{rng.integers(0, 60)}",
             None if rng.random() < .1 else int(rng.random() < .3), int(i % 3)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k string, y int, fold int").repartition(4)
    got = ordered.fold_statistics(df, ["k"], "y", ORDER, "fold", 4, bucket_rows=90).collect()
    for m in range(4):
        inside = df.filter(F.col("fold") != m)
        want = ordered.ordered_statistics(inside, ["k"], "y", ORDER, bucket_rows=90).collect()
        assert (sorted((r["id"], r["k"] or "", round(r["k_code"], 12)) for r in want)
                == sorted((r["id"], r["k"] or "", round(r[f"k_code{m}"], 12)) for r in got if r["fold"] != m))
        codes = {r["value"]: r["code"] for r in ordered.target_statistics(inside, ["k"], "y").collect()}
        assert all(r["k_held"] == pytest.approx(codes.get(r["k"], ordered.PRIOR)) for r in got if r["fold"] == m)


@pytest.mark.parametrize("name, settings", [("decision_tree", {}), ("behaviour", {}), ("xgboost", {}), ("catboost", {"ordered": True})])
def test_training_grows_all_folds_together_and_the_stored_model_scores_alike(spark, monkeypatch, name, settings):
    for kind in (models.GBTClassifier, models.DecisionTreeClassifier):
        monkeypatch.setattr(kind, "fit", lambda *rest: pytest.fail("a fold was fitted by a job of its own"))
    params = {"iterations": 6, "max_depth": 3}
    trained = training.train(txn(spark, SF), name, params, {**settings, "n_folds": 4, "test_size": 0.2})
    rows = training.rows_for(txn(spark, SF), models.family(name))
    path = scratch_path(spark, "trees")
    trained.model.save(path)
    loaded = scoring.ScoringModel.load(spark, path)
    a, b = ({r["transaction_id"]: (r["fraud_probability"], r["prediction"]) for r in m.score(rows).collect()} for m in (trained.model, loaded))
    assert a == b and len(set(a.values())) > 3
    found = trained.fold_scores.agg(F.count("*"), F.count_distinct("transaction_id"), F.count_distinct("fold")).first()
    assert found[0] == found[1] and found[2] == 4
    assert trained.metrics["test_roc_auc"] > 0.65 and trained.metrics["cv_roc_auc_mean"] > 0.65


def test_every_job_of_the_rounds_is_a_pass(spark, monkeypatch):
    df, p, passes, own = table(spark), boosting.BoostingParams(7, .3, 3, seed=5), [], foldtrees._gathered
    lessons = [foldtrees.Lesson({0: 1.0, 1: 2.0}, [0, 1], [0, 1], np.array([np.nan, np.nan])) for _ in range(4)]
    blocks = foldtrees.written(df, "id", ["x", "z"], [0, 1], "y", "fold", lessons, p.bins)
    monkeypatch.setattr(foldtrees, "_gathered", lambda rdd, size: passes.append(1) or own(rdd, size))
    spark.sparkContext.setJobGroup("rounds", "rounds")
    try:
        foldtrees.grow(blocks, p)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("rounds")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(passes) > 7 and len(jobs) == len(passes)


def test_only_the_wanted_columns_are_picked():
    bins = np.arange(24, dtype=np.uint8).reshape(4, 6)
    out = foldtrees._picked(bins, [3, 1, 0], np.array([5, 2]), {0, 2})
    assert out.shape == (3, 2) and out[0].tolist() == [23, 20] and out[2].tolist() == [5, 2]
