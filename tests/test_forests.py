from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import boosting, foldtrees, forests, models, scoring
from ledgerlark.plans import training
from ledgerlark.session import scratch_path
from ledgerlark.views import txn

SF = "/root/testdata/sf0.001"


def table(spark, n=900, folds=3, parts=5):
    rng = np.random.default_rng(3)
    x, z, u = rng.integers(0, 20, n), rng.integers(0, 9, n), rng.integers(0, 40, n)
    y = ((x > 12) ^ (z > 5) ^ (rng.random(n) < .1)).astype(int)
    rows = [(i, float(a) if i % 11 else None, float(b), float(d), int(c) if i % 50 else None, i % folds) for i, (a, b, d, c) in enumerate(zip(x, z, u, y))]
    return spark.createDataFrame(rows, "id long, x double, z double, u double, y int, fold int").repartition(parts)


def blocks(df, weights={0: 1.0, 1: 2.5}, folds=3):
    lessons = [foldtrees.Lesson(weights, [0, 1, 2], [0, 1, 2], np.array([9.0, np.nan, np.nan])) for _ in range(folds + 1)]
    return foldtrees.written(df, "id", ["x", "z", "u"], [0, 1, 2], "y", "fold", lessons, 16)


def recursion(x, y, times, path, depth, weights, p, out, where=()):
    """The nodes of a plain recursion over the rows: (way from the root) -> (feature, bin, share)."""
    w = times * np.where(y, weights[1], weights[0])
    best = (0.0, -1, 0)
    if depth < p.max_depth and y.any() and not y.all() and times.sum() >= 2 * p.min_rows:
        def squares(own):
            a, b = w[own & (y == 0)].sum(), w[own & (y == 1)].sum()
            return (a * a + b * b) / max(a + b, 1e-300)
        for f in forests.drawn_features(path, x.shape[1], p.tries)[0].tolist():
            for b in range(int(x.max())):
                left = x[:, f] <= b
                if min(times[left].sum(), times[~left].sum()) >= p.min_rows:
                    gain = round((squares(left) + squares(~left) - squares(left | True)) / w.sum(), boosting.DIGITS)
                    if gain > best[0]:
                        best = gain, f, b
    out[where] = (best[1], best[2] if best[0] else 0, w[y == 1].sum() / w.sum())
    if best[0]:
        left, paths = x[:, best[1]] <= best[2], forests.child_paths(path)
        for side, own in enumerate((left, ~left)):
            recursion(x[own], y[own], times[own], paths[side:side + 1], depth + 1, weights, p, out, (*where, side))


def nodes(tree, trees, node=0, where=()):
    out = {where: (int(tree.feature[node]), int(tree.bin[node]), float(tree.value[node]) * trees)}
    if tree.feature[node] >= 0:
        for side in (0, 1):
            out |= nodes(tree, trees, int(tree.left[node]) + side, (*where, side))
    return out


@pytest.mark.parametrize("local", [1, 40, 10_000])
@pytest.mark.parametrize("bootstrap", [True, False])
def test_equal_to_a_recursion_over_the_rows(spark, local, bootstrap):
    df, p = table(spark), forests.ForestParams(4, 9, 2, 2, bootstrap, 11)
    made = blocks(df)
    trees, gains = forests.grow(made, 1, p, local)
    kept = [r for r in df.withColumn("key", F.xxhash64("id")).collect() if r["fold"] != 1 and r["y"] is not None]
    values = np.array([[9.0 if r["x"] is None else r["x"], r["z"], r["u"]] for r in kept])
    x = np.stack([foldtrees._bin(v, e) for v, e in zip(values.T, made.edges)], axis=1).astype(int)
    y, keys = np.array([r["y"] for r in kept]), np.array([r["key"] for r in kept])
    for t, tree in enumerate(trees):
        times = forests.drawn_times(keys, p, t).astype(int) if bootstrap else np.ones(len(y), int)
        used, want = times > 0, {}
        recursion(x[used], y[used], times[used], forests.root_path(p, t), 0, (1.0, 2.5), p, want)
        got = nodes(tree, p.trees)
        assert got.keys() == want.keys() and len(got) > 20
        for where, (f, b, share) in want.items():
            assert got[where][:2] == (f, b) and abs(got[where][2] - share) < 1e-6
    assert len(trees) == 4 and abs(gains.sum() - 4) < 1e-9


def test_groups_and_partitions_change_nothing(spark, monkeypatch):
    p, made = forests.ForestParams(5, 8, 1, 2, True, 3), blocks(table(spark))
    want, _ = forests.grow(made, 3, p, 100)
    monkeypatch.setattr(forests, "GROUP", 2_000)
    monkeypatch.setattr(foldtrees, "GATHERED", 0)
    monkeypatch.setattr(forests, "SHORT", 3)
    got, _ = forests.grow(replace(made, table=made.table.repartition(2)), 3, p, 100)
    assert [nodes(a, 5) for a in want] == [nodes(b, 5) for b in got]


def test_nodes_looked_at_in_turns_are_the_same(monkeypatch):
    rng, p = np.random.default_rng(1), forests.ForestParams(1, 12, 1, 2, False, 3)
    x, y = rng.integers(0, 30, (600, 4)).astype(np.uint8), rng.integers(0, 2, 600).astype(np.uint8)
    want, _ = forests.finished(x, y, None, 0, forests.root_path(p, 0), 30, np.ones(2), p)
    monkeypatch.setattr(forests, "LOOK", 3)
    got, _ = forests.finished(x, y, None, 0, forests.root_path(p, 0), 30, np.ones(2), p)
    assert len(want[0]) > 100 and all((a == b).all() for a, b in zip(want, got))


def test_times_are_a_poisson_sample():
    times = forests.drawn_times(np.arange(200_000), forests.ForestParams(1, 1), 0)
    assert abs(times.mean() - 1) < .01 and abs(times.var() - 1) < .02


@pytest.mark.parametrize("name", ["extra_tree", "random_forest"])
def test_training_grows_no_mllib_forest(spark, monkeypatch, name):
    def none(*args, **kwargs):
        raise AssertionError("MLlib's road")
    monkeypatch.setattr(training, "fit_model", none)
    trained = training.train(txn(spark, SF), name, {"trees": 12}, {"n_folds": 3})
    rows = trained.fold_scores.collect()
    assert {r["fold"] for r in rows} == {0, 1, 2} and len({r["transaction_id"] for r in rows}) == len(rows)
    assert trained.metrics["cv_roc_auc_mean"] > .6
    scored = trained.model.score(training.rows_for(txn(spark, SF), models.family(name)))
    path = scratch_path(spark, "forest")
    trained.model.save(path)
    loaded = scoring.ScoringModel.load(spark, path)
    again = loaded.score(training.rows_for(txn(spark, SF), models.family(name)))
    a, b = ({r["record_id"]: (r["prediction"], r["fraud_probability"]) for r in df.collect()} for df in (scored, again))
    assert a == b and len(a) == txn(spark, SF).count() and len({v for _, v in a.values()}) > 5
