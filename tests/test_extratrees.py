import numpy as np
import pytest

from ledgerlark.operators.extratrees import ExtraParams, drawn_splits, grow, impurity

FEATURES = ["a", "b", "c", "d"]


def table(n=400):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(n, 4)), 2)
    x[:, 2], x[:, 3] = rng.integers(0, 3, n), 1.5
    y = ((x[:, 0] + (x[:, 2] == 1) + rng.normal(size=n) * .4) > .6).astype(int)
    x[rng.random((n, 4)) < .1] = np.nan
    return x, y, rng.integers(0, 3, n), np.where(y == 1, 2.5, 1.0)


def frame(spark, x, y, fold, w, parts):
    rows = [(*(None if np.isnan(v) else float(v) for v in x[i]), int(y[i]), int(fold[i]), float(w[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, label int, fold int, weight double").repartition(parts)


def brute(x, y, w, tree, p):
    """The same tree by recursion over the rows: {path: (feature, threshold) or share of the label in a leaf}."""
    out = {}

    def node(rows, path):
        sums = np.array([w[rows & (y == 0)].sum(), w[rows & (y == 1)].sum(), rows.sum()])
        out[path] = sums[1] / (sums[0] + sums[1])
        if len(bin(path)) - 3 >= p.max_depth or not sums[0] or not sums[1] or rows.sum() < 2 * p.min_rows:
            return
        known = [x[rows, f][~np.isnan(x[rows, f])] for f in range(x.shape[1])]
        low, high = (np.array([getattr(v, side)() if len(v) else np.nan for v in known]) for side in ("min", "max"))
        best = None
        for f, threshold in drawn_splits(low, high, tree, path, p):
            left = rows & (x[:, f] <= threshold)
            if min(left.sum(), rows.sum() - left.sum()) < p.min_rows:
                continue
            part = np.array([w[left & (y == 0)].sum(), w[left & (y == 1)].sum(), left.sum()])
            score = float(impurity(part, sums))
            if best is None or score < best[0]:
                best = (score, f, threshold, left)
        if best:
            out[path] = best[1:3]
            node(best[3], 2 * path)
            node(rows & ~best[3], 2 * path + 1)

    node(np.ones(len(y), dtype=bool), 1)
    return out


@pytest.mark.parametrize("min_rows,open_nodes", [(1, 20_000), (7, 5)])
def test_equal_to_brute_force_in_every_fold(spark, min_rows, open_nodes):
    x, y, fold, w = table()
    p = ExtraParams(n_trees=4, max_depth=6, min_rows=min_rows, columns=2, seed=3)
    forest = grow(frame(spark, x, y, fold, w, 5), FEATURES, "label", p, "weight", "fold", 3, open_nodes)
    for m, trees in enumerate(forest.trees):
        used = fold != m
        for t, tree in enumerate(trees):
            wanted = brute(x[used], y[used], w[used], m * p.n_trees + t, p)
            assert sorted(tree.path) == sorted(wanted)
            for i, path in enumerate(tree.path):
                got = (tree.feature[i], tree.threshold[i]) if tree.feature[i] >= 0 else tree.value[i]
                assert got == pytest.approx(wanted[path], abs=1e-12)


def test_scores_by_the_model_that_has_not_seen_the_fold(spark):
    x, y, fold, w = table()
    df = frame(spark, x, y, fold, w, 3)
    forest = grow(df, FEATURES, "label", ExtraParams(n_trees=20, max_depth=8), "weight", "fold", 3)
    rows = forest.score(df, fold="fold").collect()
    score, label = np.array([r["score"] for r in rows]), np.array([r["label"] for r in rows])
    assert len(rows) == 400 and ((0 <= score) & (score <= 1)).all()
    ranks = score.argsort().argsort()
    auc = (ranks[label == 1].sum() - (label == 1).sum() * ((label == 1).sum() - 1) / 2) / ((label == 1).sum() * (label == 0).sum())
    assert auc > 0.8


def test_empty_table_and_one_class(spark):
    x, y, fold, w = table(30)
    df = frame(spark, x, y * 0, fold, w, 2)
    for rows in (df, df.limit(0)):
        forest = grow(rows, FEATURES, "label", ExtraParams(n_trees=2))
        assert [len(t.feature) for t in forest.trees[0]] == [1, 1]
        assert {r["score"] for r in forest.score(df).collect()} == {0.0}
