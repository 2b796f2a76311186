"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the parquet folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` an optional comma list.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketmart.catalog import DERIVED_FROM, QUERIES, staged  # noqa: E402

HEADLINE = [
    "stg_transactions",
    "mart_baskets",
    "kpi_summary",
    "mart_products",
    "mart_categories",
    "mart_category_period",
    "mart_category_diagnostics",
    "mart_household_period",
    "customer_period_summary",
    "customer_retention_matrix",
    "customer_segments",
    "value_concentration",
    "mart_campaigns",
    "campaign_bias_comparison",
    "campaign_segment_analysis",
    "campaign_prepost",
    "mart_promotion_performance",
    "mart_customer_features",
    "validation_checks",
    "basket_descriptives",
    "basket_spearman",
    "bootstrap_ci",
    "nearest_households",
    "model_holdout",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("basketmart-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # writing the staged tables and the marts that queries share is timed by itself, the session's start with it
    seconds = {}
    start = time.perf_counter()
    tables = staged(spark, folder)
    for name in DERIVED_FROM:
        tables[name]
    seconds["staging_and_shared_marts"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
