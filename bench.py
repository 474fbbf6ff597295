"""Seconds per headline query. Prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores, BENCH_QUERIES a
comma-separated choice of queries ('all' for every registered one)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelwise.plans import QUERIES  # noqa: E402
from parcelwise.session import build_session  # noqa: E402

HEADLINE = (
    "flagship_feature_job",
    "s1_parquet_scan",
    "s5_parquet_round_trip",
    "s10_online_features",
    "c1_keep_first",
    "c4_impute_by_group_median",
    "c6_trim_upper_quantiles",
    "f16_row_fingerprint",
    "e1_frequency_index",
    "e4_robust_scale",
    "a1_group_stats",
    "a3_table_profile",
    "a5_correlation_matrix",
    "a9_segment_metrics",
    "w1_rolling_rows_property",
    "w2_rolling_rows_zipcode",
    "w3_percent_rank",
    "w4_rolling_days",
    "w5_seasonal_and_yearly",
    "w6_latest_per_entity",
    "w7_chronological_position",
    "j2_point_in_time",
    "j6_reuse_or_score",
    "v7_expectation_suite",
    "v9_outliers_iqr",
    "v12_kolmogorov_smirnov",
    "d1_stability_index",
    "d2_drift_per_day",
    "d8_bucket_quantile_per_window",
    "d12_requests_in_progress",
    "m3_time_series_folds",
    "m7_random_forest",
    "m11_batch_scoring",
    "m17_permutation_importance",
    "k6_windowed_requests",
    "k7_admissions_table",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build_session(
        "parcelwise-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM and the first scans are not part of any query.
    for name in ("s1_parquet_scan", "c9_column_selection"):
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder),
            }
        )
    )


if __name__ == "__main__":
    main()
