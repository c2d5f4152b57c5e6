"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   folder of parquet tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores                (default all)
    BENCH_QUERIES  space-separated names, or "all" for every query with a SQL equivalent
    BENCH_REPEAT   timed runs per query after one warm-up; the median counts (default 1)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlark.plans.registry import REGISTRY  # noqa: E402
from ledgerlark.session import build_session  # noqa: E402

HEADLINE = [
    "fraud_rate_by_top_category", "normalised_rows", "first_of_duplicates", "winsorised", "collapsed_merchants",
    "cleaned_rows", "training_features", "serving_features", "haversine_distances", "user_activity_24h",
    "amount_to_avg_ratio", "behaviour_history", "behaviour_history_of_hot_cards", "missing_values",
    "numeric_description", "categorical_description", "amount_quantiles", "stratified_split", "stratified_folds",
    "random_sample", "downsampled_negatives", "most_recent_rows", "feature_vectors", "average_precision", "roc_auc",
    "threshold_at_recall", "fold_metrics", "foreign_model_scores", "streamed_scores", "streamed_history",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    wanted = os.environ.get("BENCH_QUERIES", "").split()
    names = [n for n, q in REGISTRY.items() if q.sql] if wanted == ["all"] else wanted or HEADLINE
    cores = str(os.cpu_count() if cpus == "*" else cpus)
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cores, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, name, sf_dir)
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeat)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
