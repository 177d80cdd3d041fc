"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated keys, default: the table builders below).
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from registry.catalog import QUERIES

HEADLINES = (
    "t01_account_l2_events", "t02_item_orders", "t04_item_prices", "t06_search_funnel_daily", "t07_product_top_queries",
    "t08_query_item_daily_conversions", "t09_query_item_orders", "t10_score_change_log", "t14_completion_by_category",
    "t17_delivery_unit_cost", "t18_hex_user_activity", "t22_hex_neighbour_orders", "t30_feedback_by_item", "t31_discounted_prices",
    "t35_price_features", "t36_stock_features", "t39_search_conversion_v2", "t41_query_features_canonical",
    "t43_pair_features_v2", "t44_pair_features_canonical", "t45_pair_conversions_legacy", "t49_item_buyout_signal",
    "t50_sku_buyout_online", "t53_account_buyout_history", "t54_hex_forecast_mart", "t55_search_ranking_dataset",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("featuremill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # One machine: its temporary folder is shared by all threads.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="featuremill-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small query first, so that class loading is not charged to the first headline.
    QUERIES["t05_sku_stock_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names.split(",") if names else HEADLINES:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
