"""Time the headline queries: python bench.py. Prints one JSON line.

Environment: BENCH_SF_DIR (folder with the tables), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

from riskloom.catalog import ENTRIES
from riskloom.session import clear_staged

HEADLINE = (
    "unit_table",
    "risk_ranking",
    "group_profile",
    "evolution_by_age",
    "segment_matrix",
    "column_profile",
    "contract_failures_raw",
    "cleaned_units",
    "unit_features",
    "numeric_description",
    "tukey_outliers",
    "pearson_matrix",
    "spearman_matrix",
    "correlation_with_target",
    "chi_square_group",
    "variance_inflation",
    "fold_metrics",
    "model_comparison",
    "paired_tests",
    "cost_sensitivity",
    "roc_curve",
    "precision_recall_curve",
    "calibration",
    "gain_curve",
    "stratified_folds",
    "logistic_out_of_fold",
    "experiment_comparison",
    "permutation_importance",
    "partial_dependence",
    "priority_list",
    "forest_fold_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    # Session start-up and class loading belong to no query.
    ENTRIES["fleet_totals"].query(spark, sf_dir).collect()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        ENTRIES[name].query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    clear_staged(spark)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
