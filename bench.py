"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_ONLY
(comma-separated query names, default the list below).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from checks.all_queries import QUERIES

HEADLINE = [
    "j9_fallback_forecast",
    "j9_fallback_forecast_by_month",
    "a8_recency_weighted_mean",
    "o6_exponent_sweep",
    "j2_sum_and_mean_in_one",
    "a3_store_weekday_profile",
    "a5_area_month_weekday_profile",
    "a12_distinct_counts",
    "o1_chronological_sort",
    "o3_tail_fraction",
    "e2_codes_fit_and_transform",
    "e3_token_codes",
    "e4_min_max_scale",
    "e6_anova_f",
    "e6_anova_f_vector",
    "e9_baseline_as_feature",
    "j5_train_feature_frame",
    "j5_test_feature_frame",
    "v1_chronological_holdout",
    "v3_expanding_fold_sizes",
    "v4_stratified_folds",
    "ml3_knn_regression",
    "v5_grid_scores",
    "v8_repeated_random_search",
    "m1_rmsle",
    "b3_null_aware_blend",
    "s1_read_csv",
    "ml1_boosted_trees",
    "ml6_linear_regression",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().collect()  # JVM warm-up
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
