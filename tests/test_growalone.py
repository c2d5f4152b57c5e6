"""Models that grow in the same passes, or alone in a task, are those that grow by themselves."""

import numpy as np
import pytest
from test_foldtrees import table

from ledgerlark.operators import boosting, foldtrees
from ledgerlark.plans import search
from ledgerlark.views import txn

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def blocks(spark):
    lessons = [foldtrees.Lesson({0: 1.0, 1: 2.0}, [0, 1], [0, 1], np.array([3.0, np.nan])) for _ in range(4)]
    return foldtrees.written(table(spark), "id", ["x", "z"], [0, 1], "y", "fold", lessons, 64)


@pytest.mark.parametrize("alone", [True, False])
def test_settings_grown_together_are_those_of_their_own(blocks, alone):
    some = [boosting.BoostingParams(9, .3, 3, row_share=.7, seed=5, patience=3), boosting.BoostingParams(5, .3, 3, row_share=.7, seed=5, patience=3),
            boosting.BoostingParams(6, .5, 2, column_share=.5, min_rows=4, seed=5, patience=3)]
    for p, got in zip(some, foldtrees.grow_all(blocks, some, alone=alone)):
        want = foldtrees.grow(blocks, p)
        assert got.trees == want.trees and np.allclose(got.gains, want.gains)
        assert all(np.allclose(a, b) for a, b in zip(got.losses, want.losses))


def test_sums_of_shared_features_are_those_of_each():
    rng = np.random.default_rng(2)
    widths, n = [30, 9, 12, 5, 40], 20_000
    bins, g, slot = np.stack([rng.integers(0, w, n) for w in widths]).astype(np.uint8), rng.normal(size=n), rng.integers(0, 3, n)
    joint, seen = foldtrees._Joint(bins, widths), []
    for members in foldtrees.grouped(widths, 4_500):
        shape = [widths[f] for f in members]
        at = slot * int(np.prod(shape)) + joint.of(members, range(5))
        for f, part in zip(members, foldtrees._by_feature(np.bincount(at, g, 3 * int(np.prod(shape))).reshape(3, *shape))):
            assert np.allclose(part, np.bincount(slot * widths[f] + bins[f], g, 3 * widths[f]).reshape(3, -1))
            seen.append(f)
    assert sorted(seen) == list(range(5)) and len(foldtrees.grouped(widths, 4_500)) < 5


def test_places_are_the_leaves(blocks):
    rng = np.random.default_rng(4)
    missing = np.array([len(e) + 1 for e in blocks.edges])
    x = np.stack([rng.integers(0, m + 1, 500) for m in missing]).astype(np.uint8)
    for tree in foldtrees.grow(blocks, boosting.BoostingParams(4, .3, 5, seed=1)).trees[0]:
        walk = foldtrees._Walk(tree, missing)
        assert (walk.table(np.arange(len(tree.feature)))[walk.places(x, [0, 1])] == tree.nodes_of(x.T, missing)).all()


def test_a_search_grows_its_candidates_in_one_go(spark, monkeypatch):
    grown, own = [], foldtrees.grow_all
    monkeypatch.setattr(foldtrees, "grow_all", lambda blocks, params, *rest: grown.append(len(params)) or own(blocks, params, *rest))
    candidates = [{"iterations": 5, "max_depth": 2, "learning_rate": .1}, {"iterations": 3, "max_depth": 2, "learning_rate": .1}, {"iterations": 4, "max_depth": 3, "learning_rate": .2}]
    together = search.search(txn(spark, SF), "xgboost", candidates, settings={"n_folds": 3}).collect()
    assert grown == [3]
    for candidate, row in zip(candidates[1:], sorted(together)[1:]):
        alone = search.search(txn(spark, SF), "xgboost", [candidate], settings={"n_folds": 3}).first()
        assert alone[2:] == row[2:]
