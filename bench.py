"""Bench: wall time of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is fully executed by writing its result to Spark's ``noop`` sink
(the whole plan runs on the executors, nothing is shipped to the driver),
after one warm-up of the session.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "class_distribution",
    "numeric_quantiles",
    "describe_by_class",
    "spearman_target",
    "tree_preparation",
    "domain_features",
    "stratified_split",
    "percentile_rank_features",
    "histogram_root_split",
    "gini_root_split",
    "threshold_search_rainfall",
    "cv_leaderboard",
    "robust_scaled_numeric",
    "model_decision_tree_test_metrics",
    "knn_embeddings_within_label",
    "smote_embeddings_class_counts",
    "booster_first_round",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tabrisk.plans.catalog import QUERIES
    from tabrisk.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="tabrisk-bench")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["class_distribution"](spark, sf_dir).collect()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
