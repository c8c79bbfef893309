"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
local cores. Every query is planned, run and drained to the noop sink, after one warm-up.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tabwork.plans.catalogue import QUERIES

HEADLINE = [
    "latest_txn_enriched", "latest_txn_first_only", "describe_numeric", "describe_by_group", "value_counts_all", "crosstab_wide",
    "simpson_reversal", "quantiles_exact", "quantiles_by_cells", "describe_missing_orders", "missing_per_row_orders", "drop_sparse_orders",
    "impute_plan", "property_prepared", "upper_outliers_columns", "outlier_summary_columns", "qcut_means", "ttest_two_sample",
    "anova_oneway", "chi2_independence", "pearson_by_group", "ttest_by_group_vs_overall", "split_rows", "split_stratified",
    "scale_minmax", "scale_robust", "scale_quantile", "scale_normal", "scale_yeojohnson_fit", "kmeans_profile", "kmeans_fit_planted",
    "hist_numeric", "box_by_group", "violin_density", "line_by_group", "scatter_by_group",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tabwork-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.python.sql.dataFrameDebugging.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["latest_txn_enriched"](spark, sf).write.format("noop").mode("overwrite").save()
    only = os.environ.get("BENCH_ONLY")
    times = {}
    for name in only.split(",") if only else HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
