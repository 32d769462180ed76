"""Times the headline queries on ``$BENCH_SF_DIR`` and prints one JSON line.

Every query runs to the end into the no-op sink, so all its rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from pairloom.catalog.queries import QUERIES

HEADLINE = [
    "action_table", "valid_profiles", "range_filter", "attribute_distribution", "class_distribution",
    "log_moments", "log_zscore", "one_hot_matrix", "freq_encode", "profile_vectors", "match_pairs",
    "match_matrix_rules", "unmatched_actions", "dataset_descriptor", "gower_pairs", "top_matches", "payment_split",
    "roi_grouped_sum", "nearest_centre", "distance_bands", "distance_profile", "kmeans_step", "item_distance",
    "cluster_cohesion", "distance_histogram", "split_step", "confusion_matrix", "auc", "regression_report",
    "rule_top_matches", "forest_match_scores", "forest_match_totals", "cluster_users", "logistic_propensity", "payment_forest_eval", "kmeans_assignments", "roi_model",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    # start the JVM's and the Python workers' first-use work outside the timings
    spark.range(1000).mapInPandas(lambda it: it, "id long").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
