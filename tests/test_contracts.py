"""Contracts of the tables: keys are unique, publication is repeatable."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from featuremill.plans.publish import duplicate_keys, publish
from featuremill.plans.tables import TABLES
from registry.catalog import QUERIES
from registry.silver_queries import D

# Table name -> registered query, where they are not called alike.
OTHER_NAMES = {"account_category_events": "t01_account_l2_events"}


def query_of(name):
    if name in OTHER_NAMES:
        return OTHER_NAMES[name]
    return next(q for q in QUERIES if q.split("_", 1)[1] == name and q[0] == "t")


@pytest.mark.parametrize("name", sorted(set(TABLES) - {"account_history_online", "city_cost_online"}))
def test_primary_key_is_unique(spark, sf_dir, name):
    frame = QUERIES[query_of(name)](spark, sf_dir)
    assert set(TABLES[name].primary_key) <= set(frame.columns)
    assert duplicate_keys(TABLES[name], frame).count() == 0


def test_publish_daily_table_twice(spark, sf_dir, tmp_path):
    table, path = TABLES["stock_features"], str(tmp_path / "t")
    frame = QUERIES["t36_stock_features"](spark, sf_dir)
    for _ in range(2):
        publish(table, frame, path, D, str(tmp_path / "s"))
    assert spark.read.parquet(path).count() == frame.count()
    with pytest.raises(ValueError, match="partition date"):
        publish(table, frame, path, date(2024, 1, 1), str(tmp_path / "s"))
    with pytest.raises(ValueError, match="key columns missing"):
        publish(table, frame.drop("sku_group_id"), path, D, str(tmp_path / "s"))


def test_publish_snapshots_and_dictionary(spark, sf_dir, tmp_path):
    prices, path = TABLES["discounted_prices"], str(tmp_path / "p")
    frame = QUERIES["t31_discounted_prices"](spark, sf_dir).withColumn("calculated_at", F.col("calculated_at").cast("string"))
    n = frame.count()
    publish(prices, frame, path, D, "")
    publish(prices, frame.where("promotion_id = '0'"), path, D, "")
    assert spark.read.parquet(path).count() == n
    words, path = TABLES["query_dictionary"], str(tmp_path / "d")
    frame = QUERIES["t48_query_dictionary"](spark, sf_dir)
    for _ in range(2):
        publish(words, frame, path, D, "")
    assert spark.read.parquet(path).count() == frame.count() > 0
