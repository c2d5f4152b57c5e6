"""Threshold-free and threshold metrics of a scored table (label 0/1, score), optionally per group.

The curve is one cumulative sum over the distinct scores from high to low. Scores are first counted,
then cut into ranges of similar row count; sums run inside each range, and every range gets the total
of the ranges above it. No task sees more than one range, whatever the number of scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

MIN_RANGES = 256


def present(score: Column) -> Column:
    """A missing or NaN score is the lowest: such a row is found last and never predicted positive."""
    return F.coalesce(F.nanvl(score.cast("double"), F.lit(None)), F.lit(float("-inf")))


def _plan_ranges(scored: DataFrame, score: str, ranges: int | None) -> list[float]:
    """Range borders, from one sketch pass.

    Borders are literals fixed before the curve is planned, so a retried task cuts the same ranges. There
    are as many ranges as shuffle partitions: a larger cluster gets smaller ranges.
    """
    ranges = ranges or max(MIN_RANGES, int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = [i / ranges for i in range(1, ranges)]
    found = scored.agg(F.percentile_approx(score, at, max(10_000, 4 * ranges))).first()[0] or []
    return sorted({v for v in found if abs(v) != float("inf")})


def _with_range(counted: DataFrame, score: str, splits: list[float]) -> DataFrame:
    if not splits:
        return counted.withColumn("_range", F.lit(0))
    bucketizer = Bucketizer(splits=[float("-inf"), *splits, float("inf")], inputCol=score, outputCol="_range")
    return bucketizer.transform(counted).withColumn("_range", F.col("_range").cast("int"))


def curve(scored: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
          ranges: int | None = None) -> DataFrame:
    """One row per (group, distinct score) as threshold, with the counts at ``score >= threshold``.

    Columns: ``by``, threshold, pos and neg at exactly this score, tp, fp, positives, negatives,
    precision, recall. Without positives recall is 1, as nothing can be missed. Rows without a score count at
    the threshold minus infinity.
    """
    by = list(by)
    scored = scored.withColumn(score, present(F.col(score)))
    splits = _plan_ranges(scored, score, ranges)
    counted = (scored.groupBy(*by, F.col(score).alias("threshold"))
               .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))
    counted = _with_range(counted, "threshold", splits)

    group = Window.partitionBy(*(by or [F.lit(0)]))
    before = group.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per group and range.
    offsets = (counted.groupBy(*by, "_range").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
               .withColumns({"_tp_above": F.coalesce(F.sum("p").over(before), F.lit(0)),
                             "_fp_above": F.coalesce(F.sum("n").over(before), F.lit(0)),
                             "positives": F.sum("p").over(group), "negatives": F.sum("n").over(group)})
               .drop("p", "n"))
    inside = (Window.partitionBy(*by, "_range").orderBy(F.desc("threshold"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (counted.withColumns({"_tp": F.sum("pos").over(inside), "_fp": F.sum("neg").over(inside)})
            .join(offsets, [*by, "_range"])
            .withColumns({"tp": F.col("_tp") + F.col("_tp_above"), "fp": F.col("_fp") + F.col("_fp_above")})
            .withColumns({"precision": F.col("tp") / (F.col("tp") + F.col("fp")),
                          "recall": F.when(F.col("positives") > 0, F.try_divide("tp", "positives")).otherwise(1.0)})
            .select(*by, "threshold", "pos", "neg", "tp", "fp", "positives", "negatives", "precision", "recall"))


def precision_recall_curve(scored: DataFrame, **names) -> DataFrame:
    """Thresholds with precision and recall, plus the closing point (1, 0) without threshold."""
    by = list(names.get("by", ()))
    points = curve(scored, **names).select(*by, "threshold", "precision", "recall")
    closing = (points.select(*by).distinct() if by else points.limit(1).select()).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(closing)


def _average_precision() -> Column:
    return F.coalesce(F.try_divide(F.sum(F.col("pos") * F.col("precision")), F.max("positives")), F.lit(0.0))


def _roc_auc() -> Column:
    won = F.col("neg") * (F.col("tp") - F.col("pos") / 2)
    return F.try_divide(F.sum(won), F.max(F.col("positives").cast("double") * F.col("negatives")))


def average_precision(scored: DataFrame, **names) -> DataFrame:
    """Sum of precision times recall step; 0 without positives."""
    return curve(scored, **names).groupBy(*names.get("by", ())).agg(_average_precision().alias("avg_precision"))


def roc_auc(scored: DataFrame, **names) -> DataFrame:
    """Chance that a positive outscores a negative, ties counting half; NULL with one class only."""
    return curve(scored, **names).groupBy(*names.get("by", ())).agg(_roc_auc().alias("roc_auc"))


def _confusion(label: str, predicted: Column) -> dict[str, Column]:
    positive = F.col(label) == 1
    return {"tp": F.count_if(positive & predicted), "fp": F.count_if(~positive & predicted),
            "fn": F.count_if(positive & ~predicted), "tn": F.count_if(~positive & ~predicted)}


def _zero_divide(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def threshold_metrics(scored: DataFrame, threshold: float | Column = 0.5, label: str = "label", score: str = "score",
                      by: Sequence[str] = (), beta: float = 2.0) -> DataFrame:
    """Confusion counts, precision, recall, F1 and F-beta at ``score >= threshold``; 0/0 is 0.

    ``threshold`` may be a column, e.g. a threshold per group.
    """
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    counts = scored.groupBy(*by).agg(*[c.alias(n) for n, c in _confusion(label, present(F.col(score)) >= limit).items()])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    b2 = beta * beta
    return counts.withColumns({
        "precision": _zero_divide(tp, tp + fp), "recall": _zero_divide(tp, tp + fn),
        "f1": _zero_divide(2 * tp, 2 * tp + fp + fn),
        "f_beta": _zero_divide(tp * (1 + b2), tp * (1 + b2) + fn * b2 + fp),
    })


def confusion_matrix(scored: DataFrame, threshold: float = 0.5, label: str = "label", score: str = "score") -> DataFrame:
    """Four rows (label, prediction, count), zero-filled."""
    counts = scored.agg(*[c.alias(n) for n, c in _confusion(label, present(F.col(score)) >= threshold).items()])
    cells = [F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(n).alias("count"))
             for n, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))]
    return counts.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def _f1() -> Column:
    return 2 * F.col("precision") * F.col("recall") / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-12))


def _best_points(target: float) -> list[Column]:
    reaches = F.col("recall") >= target
    point = F.struct("threshold", "precision", "recall")
    return [F.max_by(point, F.when(reaches, F.struct(F.col("precision"), -F.col("threshold")))).alias("at_target"),
            F.max_by(point, F.struct(_f1(), -F.col("threshold"))).alias("at_f1")]


def threshold_at_recall(scored: DataFrame, target: float = 0.9, **names) -> DataFrame:
    """Among thresholds reaching the recall target the most precise one, ties to the lowest; when none
    reaches it, the threshold of the best F1."""
    by = list(names.get("by", ()))
    best = curve(scored, **names).groupBy(*by).agg(*_best_points(target))
    chosen = F.coalesce("at_target", "at_f1")
    return best.select(*by, chosen["threshold"].alias("decision_threshold"),
                       chosen["precision"].alias("threshold_precision_at_target"),
                       chosen["recall"].alias("threshold_recall_at_target"))


def threshold_at_best_f1(scored: DataFrame, **names) -> DataFrame:
    """The threshold of the best F1, ties to the lowest."""
    by = list(names.get("by", ()))
    best = F.max_by(F.struct("threshold", _f1().alias("f1")), F.struct(_f1(), -F.col("threshold")))
    return curve(scored, **names).groupBy(*by).agg(best.alias("b")).select(
        *by, F.col("b.threshold").alias("decision_threshold"), F.col("b.f1").alias("f1"))


def evaluate(scored: DataFrame, target: float | None = None, threshold: float | None = None,
             label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """All metrics of a trainer, one row per group, from a single curve.

    The threshold is the given one, or chosen per group for the recall target; the counts at a threshold
    are the curve's own, so nothing is scored twice.
    """
    by = list(by)
    points = curve(scored, label, score, by)
    free = [_average_precision().alias("avg_precision"), _roc_auc().alias("roc_auc")]
    if threshold is not None:
        at = F.col("threshold") >= threshold
        sums = points.groupBy(*by).agg(
            *free, F.coalesce(F.sum(F.when(at, F.col("pos"))), F.lit(0)).alias("_tp"),
            F.coalesce(F.sum(F.when(at, F.col("neg"))), F.lit(0)).alias("_fp"), F.max("positives").alias("_p"))
        tp, fp, p = F.col("_tp"), F.col("_fp"), F.col("_p")
        return sums.withColumns({
            "precision": _zero_divide(tp, tp + fp), "recall": _zero_divide(tp, p),
            "f1": _zero_divide(2 * tp, tp + fp + p), "f2": _zero_divide(5 * tp, tp + fp + 4 * p),
            "decision_threshold": F.lit(float(threshold)),
        }).drop("_tp", "_fp", "_p")
    best = points.groupBy(*by).agg(*free, *_best_points(target)).withColumn("b", F.coalesce("at_target", "at_f1"))
    precision, recall = F.col("b.precision"), F.col("b.recall")
    return best.select(
        *by, "avg_precision", "roc_auc", precision, recall,
        _zero_divide(2 * precision * recall, precision + recall).alias("f1"),
        F.col("b.threshold").alias("decision_threshold"),
        precision.alias("threshold_precision_at_target"), recall.alias("threshold_recall_at_target"))


def to_long(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, metric, value) rows from a wide metric frame."""
    names = [c for c in metrics.columns if c not in by]
    cells = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    return metrics.select(*by, F.explode(F.array(*cells)).alias("m")).select(*by, "m.*")


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean and population deviation over folds of a long metric frame (fold, metric, value)."""
    return fold_metrics.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def best_candidate(results: DataFrame, metric: str, order: str = "candidate") -> DataFrame:
    """The first candidate with the highest metric."""
    return results.orderBy(F.desc(metric), order).limit(1)
