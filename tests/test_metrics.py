import numpy as np
import pytest

from ledgerlark.operators import metrics

RNG = np.random.default_rng(5)
CASES = {
    "ties": ([1, 0, 1, 0, 0, 1], [0.9, 0.9, 0.5, 0.5, 0.2, 0.2]),
    "all_equal": ([1, 0, 0, 1], [0.5] * 4),
    "perfect": ([1, 1, 0, 0], [0.9, 0.8, 0.2, 0.1]),
    "no_positives": ([0, 0, 0], [0.1, 0.5, 0.9]),
    "no_negatives": ([1, 1], [0.3, 0.6]),
    "random": (RNG.integers(0, 2, 500).tolist(), np.round(RNG.random(500), 2).tolist()),
    "third_shares_a_score": ((RNG.random(600) < 0.1).astype(int).tolist(),
                             np.where(RNG.random(600) < 0.34, 0.25, RNG.random(600)).tolist()),
}


def points(labels, scores):
    """(threshold, precision, recall) by ascending threshold, straight from the definition."""
    y, s = np.array(labels), np.array(scores)
    out = []
    for t in np.unique(s):
        tp, predicted = int(y[s >= t].sum()), int((s >= t).sum())
        out.append((t, tp / predicted, tp / y.sum() if y.sum() else 1.0))
    return out


def frame(spark, case):
    labels, scores = CASES[case]
    return spark.createDataFrame(list(zip(labels, map(float, scores))), "label int, score double").repartition(3)


@pytest.mark.parametrize("ranges", [None, 3])
@pytest.mark.parametrize("case", CASES)
def test_curve(spark, case, ranges):
    got = sorted((r["threshold"], r["precision"], r["recall"]) for r in metrics.curve(frame(spark, case), ranges=ranges).collect())
    wanted = points(*CASES[case])
    assert len(got) == len(wanted)
    assert np.allclose(np.array(got), np.array(wanted), atol=1e-12)


@pytest.mark.parametrize("case", CASES)
def test_areas(spark, case):
    y, s = map(np.array, CASES[case])
    row = metrics.evaluate(frame(spark, case), target=0.9).first()
    below, step = 0.0, 0.0
    for _, p, r in reversed(points(y, s)):
        step, below = step + (r - below) * p, r
    assert row["avg_precision"] == pytest.approx(step if y.sum() else 0.0)
    pairs = [(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]]
    assert row["roc_auc"] == (pytest.approx(np.mean(pairs)) if pairs else None)


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("target", [0.5, 0.9, 1.5])
def test_threshold_for_recall(spark, case, target):
    row = metrics.threshold_at_recall(frame(spark, case), target).first()
    known = points(*CASES[case])
    reaching = [p for p in known if p[2] >= target]
    if reaching:
        best = max(reaching, key=lambda p: p[1])
    else:
        best = known[int(np.argmax([2 * p * r / max(p + r, 1e-12) for _, p, r in known]))]
    assert (row["decision_threshold"], row["threshold_precision_at_target"]) == (best[0], pytest.approx(best[1]))


@pytest.mark.parametrize("case", CASES)
def test_counts_at_threshold(spark, case):
    y, s = map(np.array, CASES[case])
    df, hit = frame(spark, case), np.array(CASES[case][1]) >= 0.5
    tp, fp, fn, tn = (int(((y == a) & (hit == b)).sum()) for a, b in ((1, True), (0, True), (1, False), (0, False)))
    row = metrics.threshold_metrics(df, 0.5).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (tp, fp, fn, tn)
    assert row["precision"] == pytest.approx(tp / (tp + fp) if tp + fp else 0)
    assert row["f_beta"] == pytest.approx(5 * tp / (5 * tp + 4 * fn + fp) if tp + fp + fn else 0)
    cells = {(r["label"], r["prediction"]): r["count"] for r in metrics.confusion_matrix(df, 0.5).collect()}
    assert cells == {(0, 0): tn, (0, 1): fp, (1, 0): fn, (1, 1): tp}
    fixed = metrics.evaluate(df, threshold=0.5).first()
    assert (fixed["precision"], fixed["recall"], fixed["f1"]) == pytest.approx((row["precision"], row["recall"], row["f1"]))
    assert fixed["f2"] == pytest.approx(row["f_beta"])


def test_groups_are_independent(spark):
    parts = [(f, y, float(s)) for f, c in enumerate(CASES) for y, s in zip(*CASES[c])]
    df = spark.createDataFrame(parts, "fold int, label int, score double")
    got = {r["fold"]: r for r in metrics.evaluate(df, target=0.9, by=["fold"]).collect()}
    for f, case in enumerate(CASES):
        alone = metrics.evaluate(frame(spark, case), target=0.9).first()
        assert (got[f]["avg_precision"], got[f]["decision_threshold"]) == pytest.approx(
            (alone["avg_precision"], alone["decision_threshold"]))


def test_summary_and_best(spark):
    df = spark.createDataFrame([(0, "f1", 1.0), (1, "f1", 3.0)], "fold int, metric string, value double")
    row = metrics.cv_summary(df).first()
    assert (row["mean"], row["std"]) == (2.0, 1.0)
    results = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.7)], "candidate int, ap double")
    assert metrics.best_candidate(results, "ap").first()["candidate"] == 2


def test_rows_without_a_score_count_as_lowest(spark):
    rows = [(1, 0.9), (0, 0.2), (1, None), (0, float("nan"))]
    df = spark.createDataFrame(rows, "label int, score double")
    lowest = spark.createDataFrame([(y, s if s is not None and s == s else -1.0) for y, s in rows], "label int, score double")
    for found in (metrics.average_precision, metrics.roc_auc):
        assert found(df).first()[0] == pytest.approx(found(lowest).first()[0])
    at = metrics.threshold_metrics(df, 0.5).first()
    assert (at["tp"], at["fp"], at["fn"], at["tn"]) == (1, 0, 1, 2) and at["recall"] == 0.5
    assert sum(r["count"] for r in metrics.confusion_matrix(df).collect()) == 4
    assert metrics.evaluate(df, threshold=0.5).first()["recall"] == 0.5
