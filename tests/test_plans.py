"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from featuremill.functions.dates import Bound
from featuremill.sources import scan
from registry.catalog import QUERIES
from registry.silver_queries import D

TABLE_QUERIES = sorted(n for n in QUERIES if re.match(r"t\d\d_", n))


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TABLE_QUERIES)
def test_no_product_joins_and_no_python(spark, sf_dir, name):
    plan = physical(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert not re.search(r"Python|Pandas|MapInArrow", plan)
    assert "NestedLoopJoin" not in plan


def test_partition_filter_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-31')) as date, 1 as x").write.partitionBy("date").parquet(path)
    plan = physical(scan.trailing(spark.read.parquet(path), D, 7, Bound.HALF_OPEN))
    assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2024-01-24.*date#\d+ <= 2024-01-30", plan)


def test_time_range_is_pushed_to_the_scan(spark, sf_dir):
    from datetime import datetime

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = physical(scan.instants(events, datetime(2024, 1, 3), datetime(2024, 1, 4), "ts").select("event_id"))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>", plan)


def test_stock_features_aggregate_before_the_join(spark, sf_dir):
    """Two aggregations lie below the catalogue join, one above it."""
    plan = physical(QUERIES["t36_stock_features"](spark, sf_dir))
    join = min(i for i in (plan.find("SortMergeJoin"), plan.find("BroadcastHashJoin")) if i >= 0)
    assert plan[join:].count("HashAggregate") >= 4


def test_attribution_reuses_its_shuffle(spark, sf_dir):
    df = QUERIES["t06_search_funnel_daily"](spark, sf_dir)
    df.collect()
    assert physical(df).split("== Initial Plan ==")[0].count("ReusedExchange") >= 1


def test_plans_hold_without_broadcasts(spark, sf_dir, oracle):
    """Results are the same when nothing is small enough to broadcast."""
    from registry.catalog import ORACLES
    from registry.compare import compare

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("t06_search_funnel_daily", "t09_query_item_orders", "t44_pair_features_canonical", "t53_account_buyout_history"):
            df = QUERIES[name](spark, sf_dir)
            # The list of hot groups is bounded by a constant and stays broadcast.
            assert physical(df).count("BroadcastHashJoin") <= (0 if name in ("t09_query_item_orders", "t53_account_buyout_history") else 3)
            assert compare(df, oracle, ORACLES[name])[0] == "exact"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_ansi_is_left_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        spark.range(1).select(F.lit(1.0) / F.lit(0.0)).collect()
