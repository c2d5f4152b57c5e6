import numpy as np
import pytest

from ledgerlark.operators import boosting
from ledgerlark.operators.boosting import BoostingParams, boost

FEATURES = ["a", "b", "c"]


def table(seed=1, n=500, missing=0.15):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[:, 2] = rng.integers(0, 4, n)
    odds = 1.5 * x[:, 0] - 1.0 * (x[:, 1] > 0.3) + 0.7 * (x[:, 2] == 2)
    x[rng.random((n, 3)) < missing] = np.nan
    odds = odds + np.where(np.isnan(x[:, 1]), 2.0, 0.0)
    y = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(int)
    return x, y, rng.integers(0, 3, n), np.where(y == 1, 2.0, 1.0)


def frame(spark, x, y, fold, w, parts=4):
    rows = [(f"t{n}", *(None if np.isnan(v) else float(v) for v in x[n]), int(y[n]), int(fold[n]), float(w[n])) for n in range(len(y))]
    return spark.createDataFrame(rows, "transaction_id string, a double, b double, c double, label int, fold int, weight double").repartition(parts)


def brute(x, y, w, p, used):
    """Boosting on the rows themselves: every distinct value a threshold, both sides tried for missing values."""
    margin, trees = np.zeros(len(y)), []

    def weight(g, h):
        v = -np.sign(g) * max(abs(g) - p.l1, 0) / (h + p.l2)
        return float(np.clip(v, -p.max_delta_step, p.max_delta_step)) if p.max_delta_step else v

    def score(g, h):
        v = weight(g, h)
        return -(2 * g * v + (h + p.l2) * v * v + 2 * p.l1 * abs(v))

    for _ in range(p.rounds):
        chance = 1 / (1 + np.exp(-margin))
        g, h = w * (chance - y), w * chance * (1 - chance)

        def best(rows):
            top, own = None, rows & used
            for f in range(x.shape[1]):
                lost = own & np.isnan(x[:, f])
                for to_left in ((False, True) if lost.any() else (False,)):
                    for edge in np.unique(x[~np.isnan(x[:, f]), f]):
                        left = own & ((x[:, f] <= edge) | (lost if to_left else False))
                        right = own & ~left
                        if min(left.sum(), right.sum()) < max(1, p.min_rows) or min(h[left].sum(), h[right].sum()) < p.min_child_weight:
                            continue
                        gain = round(.5 * (score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - score(g[own].sum(), h[own].sum())), 9)
                        if gain > p.min_gain and (top is None or gain > top[0]):
                            top = (gain, f, edge, to_left)
            return top

        leaves = [(np.ones(len(y), dtype=bool), 0)]
        while True:
            splits = [(best(rows), n) for n, (rows, depth) in enumerate(leaves) if depth < p.max_depth]
            splits = [(s, n) for s, n in splits if s]
            if not splits or (p.max_leaves and len(leaves) >= p.max_leaves):
                break
            (_, f, edge, to_left), n = max(splits, key=lambda s: s[0][0])
            rows, depth = leaves.pop(n)
            left = rows & ((x[:, f] <= edge) | (np.isnan(x[:, f]) & to_left))
            leaves += [(left, depth + 1), (rows & ~left, depth + 1)]
        for rows, _ in leaves:
            own = rows & used
            margin[rows] += p.learning_rate * weight(g[own].sum(), h[own].sum())
        trees.append(len(leaves))
    return 1 / (1 + np.exp(-margin)), trees


def every_value(x):
    return [np.unique(x[~np.isnan(x[:, f]), f])[:-1] for f in range(x.shape[1])]


@pytest.mark.parametrize("p", [
    BoostingParams(rounds=4, max_depth=3, learning_rate=0.3), BoostingParams(rounds=3, max_depth=2, l1=2.0, l2=5.0, min_gain=0.5, min_child_weight=3.0),
    BoostingParams(rounds=3, max_depth=3, max_delta_step=0.2, min_rows=20, l2=0.5), BoostingParams(rounds=3, max_depth=6, max_leaves=5, learning_rate=0.5)])
def test_equals_brute_force_on_all_folds_at_once(spark, p):
    x, y, fold, w = table()
    df = frame(spark, x, y, fold, w)
    model = boost(df, FEATURES, "label", p, weight="weight", fold="fold", n_folds=3, edges=every_value(x))
    by_all = {r["transaction_id"]: r["score"] for r in model.score(df).collect()}
    by_fold = {r["transaction_id"]: r["score"] for r in model.score(df, fold="fold").collect()}
    for m in range(4):
        want, sizes = brute(x, y, w, p, (fold != m) | (m == 3))
        assert [sum(f < 0 for f in t.feature) for t in model.trees[m]] == sizes
        rows = range(len(y)) if m == 3 else np.flatnonzero(fold == m).tolist()
        got = np.array([(by_all if m == 3 else by_fold)[f"t{n}"] for n in rows])
        assert np.abs(got - want[list(rows)]).max() < 1e-9


def test_partitions_and_scores_tables_change_nothing(spark, monkeypatch):
    x, y, fold, w = table(2)
    p = BoostingParams(rounds=5, max_depth=3, row_share=0.7, column_share=0.7)
    scores = []
    for parts, advance in ((1, 10), (5, 2)):
        monkeypatch.setattr(boosting, "ADVANCE", advance)
        df = frame(spark, x, y, fold, w, parts)
        model = boost(df, FEATURES, "label", p, fold="fold", n_folds=3, edges=every_value(x))
        scores.append([r["score"] for r in model.score(df, fold="fold").orderBy("transaction_id").collect()])
    assert np.allclose(*scores, atol=1e-9) and len(set(scores[0])) > 50


def test_early_stopping_cuts_each_fold_to_its_best_round(spark):
    x, y, fold, w = table(3, 300)
    df = frame(spark, x, y, fold, w)
    p = BoostingParams(rounds=25, max_depth=4, learning_rate=0.8, l2=0.01, min_child_weight=0.0, patience=3)
    model = boost(df, FEATURES, "label", p, fold="fold", n_folds=3)
    whole = boost(df, FEATURES, "label", BoostingParams(**{**p.__dict__, "patience": None, "rounds": 8}), fold="fold", n_folds=3)
    for m in range(3):
        assert len(model.trees[m]) == max(1, int(np.argmin(model.losses[m]))) < 25
        assert len(model.losses[m]) <= int(np.argmin(model.losses[m])) + 1 + p.patience
        shared = min(len(model.losses[m]), len(whole.losses[m]))
        assert np.allclose(model.losses[m][:shared], whole.losses[m][:shared])


def test_untidy_rows(spark):
    x, y, fold, w = table(4, 120)
    df = frame(spark, x, y, fold, w)
    odd = spark.createDataFrame([("n1", 1.0, 1.0, 1.0, None, 0, 1.0), ("n2", 1.0, None, 1.0, 1, 0, None), ("n3", 0.0, 0.0, 0.0, 1, 1, -1.0)], df.schema)
    p = BoostingParams(rounds=2, max_depth=2)
    args = dict(weight="weight", fold="fold", n_folds=3, edges=every_value(x))
    one, two = boost(df, FEATURES, "label", p, **args), boost(df.unionAll(odd), FEATURES, "label", p, **args)
    assert all(np.allclose(a.value, b.value) for s, t in zip(one.trees, two.trees, strict=True) for a, b in zip(s, t, strict=True))
    assert all(0 < r["score"] < 1 for r in two.score(odd).collect())
    assert sum(one.importances().values()) > 0
    empty = boost(df.limit(0), FEATURES, "label", p, fold="fold", n_folds=3, edges=every_value(x))
    assert {r["score"] for r in empty.score(df).collect()} == {0.5}


def test_leaves_of_a_tree_row_by_row():
    rng, tree = np.random.default_rng(5), boosting.Tree()
    missing, waiting = np.array([7, 7, 3]), [0]
    for n in range(6):
        f = int(rng.integers(0, 3))
        waiting += tree.split(waiting.pop(0), f, int(rng.integers(0, missing[f])), bool(n % 2), (0.1 * n, -0.1 * n))
    bins = np.stack([rng.integers(0, m + 1, 300) for m in missing], axis=1).astype(np.uint16)

    def leaf(row):
        node = 0
        while tree.feature[node] >= 0:
            value = row[tree.feature[node]]
            left = tree.missing_left[node] if value == missing[tree.feature[node]] else value <= tree.bin[node]
            node = tree.left[node] if left else tree.right[node]
        return node

    wanted = [leaf(row) for row in bins]
    assert tree.nodes_of(bins, missing).tolist() == tree.nodes_of(np.asfortranarray(bins), missing).tolist() == wanted
    assert tree.nodes_of(bins[:0], missing).tolist() == [] and boosting.Tree().nodes_of(bins, missing).tolist() == [0] * 300


def test_training_rows_of_one_file_are_spread_over_the_cores(spark):
    from ledgerlark.plans.training import spread
    one = spark.range(0, 4000, 1, 1).selectExpr("concat('t', id) AS transaction_id")
    found = spread(one, "transaction_id").selectExpr("spark_partition_id() AS part").groupBy("part").count().collect()
    assert len(found) == 2 * spark.sparkContext.defaultParallelism and max(r["count"] for r in found) < 2000


def test_small_folds_are_boosted_side_by_side_in_few_tasks(spark, monkeypatch):
    from ledgerlark.operators import models
    from ledgerlark.operators.sampling import HashOrder
    from ledgerlark.plans import training
    spec = models.Family("lightgbm", models.family("lightgbm").build, {"iterations": 2, "learning_rate": 0.1, "max_depth": 2}, ["x"], [])
    rows = spark.range(0, 600, 1, 8).selectExpr("CAST(id AS STRING) AS transaction_id", "CAST(id % 37 AS DOUBLE) AS x", "CAST(id % 37 > 30 AS INT) AS is_fraud",
                                                "CAST(id % 6 AS INT) AS fold")
    seen, used = [], models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, df, *rest: seen.append(df.rdd.getNumPartitions()) or used(self, df, *rest))
    _, scores = training.cross_validate(rows, spec, spec.params, {"n_folds": 6, "seed": 1}, HashOrder("transaction_id", 1))
    assert seen == [1] * 6 and scores.count() == 600
    labels = [{0: 500, 1: 100}] * 7
    assert training.side_by_side(rows, spec, spec.params, labels, 6, 4) == (6, 1)
    assert training.side_by_side(rows, spec, spec.params, [{0: 10**8}] * 7, 6, 4) == (4, None)
