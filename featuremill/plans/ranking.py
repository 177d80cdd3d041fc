"""Labelled ranking dataset."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.functions.dates import between_instants, day, day_start
from featuremill.functions.jsonpaths import double_array_or_nulls
from featuremill.functions.text import has_text
from featuremill.operators.rows import sliced_row_number
from featuremill.plans.search_silver import IMPRESSION, SCORE_MODEL_LIKE, SEARCH, SEARCH_SPACES, UNPLACED
from featuremill.sources.scan import received_on

LABEL_DELAY_DAYS = 14
SCORES = ("normalized_linear_score", "linear_score", "dssm_score")


def shown_positions(events: DataFrame, on: date) -> DataFrame:
    """Search impressions of a day, one per position, re-ranked within the search.

    The earliest impression of a position is kept, with the number of
    impressions it had. Duplicates fold in a map-side combined aggregation; the
    re-rank then runs over distinct positions, cut into slices of 1000.
    """
    used = received_on(events, on).where(
        (F.col("event_type") == IMPRESSION)
        & (F.col("widget_space_name") == SEARCH)
        & (F.col("widget_section_name") == SEARCH)
        & has_text(F.col("query"))
        & ~F.coalesce("is_full_catpred", F.lit(False))
    ).select(
        "logged_at", "received_at", "install_id", "session_id",
        F.col("sku_group_id").cast("bigint").alias("sku_group_id"),
        F.trim(F.lower("query")).alias("query"),
        F.col("position").cast("int").alias("position"),
        "widget_section_name", "widget_space_name",
    )
    search = ["install_id", "session_id", "query"]
    # Struct fields are compared in order, so the least struct is the earliest impression.
    first = F.min(F.struct("received_at", "logged_at", "sku_group_id", "widget_section_name", "widget_space_name"))
    one = (
        used.groupBy(*search, "position")
        .agg(first.alias("e"), F.count(F.lit(1)).alias("position_duplicate_count"))
        .select(*search, "position", "e.*", "position_duplicate_count")
    )
    return sliced_row_number(
        one,
        search,
        F.coalesce(F.floor(F.col("position") / 1000), F.lit(-1)),
        [F.col("position"), F.col("received_at"), F.col("logged_at"), F.col("sku_group_id")],
        "deduplicate_rank",
    )


def mean_scores(ranking_events: DataFrame, on: date) -> DataFrame:
    """Day means of the model scores per query and item."""
    used = ranking_events.where(
        between_instants(F.col("fired_at"), day_start(on), day_start(on + timedelta(days=1)))
        & F.col("model_name").like(SCORE_MODEL_LIKE)
        & (F.size("ranking_candidates") > 0)
        & has_text(F.col("search_query"))
        & F.col("external_features").isNotNull()
    )
    arrays = used.select(
        F.trim(F.lower("search_query")).alias("query"),
        "ranking_candidates",
        *[
            double_array_or_nulls(F.col("external_features"), f"$.{s}", F.col("ranking_candidates")).alias(s)
            for s in SCORES
        ],
    )
    return (
        arrays.select("query", F.explode(F.arrays_zip("ranking_candidates", *SCORES)).alias("z"))
        .select("query", F.col("z.ranking_candidates").try_cast("bigint").alias("sku_group_id"), *[f"z.{s}" for s in SCORES])
        .where("sku_group_id is not null")
        .groupBy("query", "sku_group_id")
        .agg(*[F.avg(s).alias(s) for s in SCORES])
    )


def ordered_items(attribution: DataFrame, order_items: DataFrame, sku: DataFrame, on: date) -> DataFrame:
    """(install, session, query, item) with an order attributed to a search of the day."""
    next_day = on + timedelta(days=1)
    credited = attribution.where(
        (F.col("query") != "")
        & F.col("widget_space_name").isin(*SEARCH_SPACES)
        & between_instants(F.col("event_received_at"), day_start(on), day_start(next_day))
        & (F.coalesce("is_full_catpred", F.lit("false")) == "false")
    ).select(
        "order_item_id", "install_id", F.col("last_search_session_id").alias("session_id"),
        F.trim(F.lower("query")).alias("query"),
    )
    placed = order_items.where(
        between_instants(F.col("generated_at"), day_start(on - timedelta(days=15)), day_start(next_day))
        & ~F.col("order_item_status").isin(*UNPLACED)
    ).select("order_item_id", "sku_id")
    groups = sku.select(F.col("id").alias("sku_id"), F.col("sku_group_id").cast("bigint").alias("sku_group_id"))
    return (
        credited.join(placed, "order_item_id").join(groups, "sku_id")
        .select("install_id", "session_id", "query", "sku_group_id").distinct()
        .withColumn("is_generated_order", F.lit(1))
    )


def search_ranking_dataset(
    events: DataFrame,
    attribution: DataFrame,
    order_items: DataFrame,
    sku: DataFrame,
    ranking_events: DataFrame,
    collection_date: date,
) -> DataFrame:
    """Impressions of the day two weeks before collection, with label and model scores."""
    on = collection_date - timedelta(days=LABEL_DELAY_DAYS)
    return (
        shown_positions(events, on)
        .join(ordered_items(attribution, order_items, sku, on), ["install_id", "session_id", "query", "sku_group_id"], "left")
        .join(mean_scores(ranking_events, on), ["query", "sku_group_id"], "left")
        .select(
            day(collection_date).alias("collection_date"), day(on).alias("event_date"),
            "logged_at", "received_at", "install_id", "session_id", "sku_group_id", "query", "position",
            F.col("deduplicate_rank").cast("bigint").alias("deduplicate_rank"),
            F.col("position_duplicate_count").cast("bigint").alias("position_duplicate_count"),
            "widget_section_name", "widget_space_name", *SCORES,
            F.coalesce("is_generated_order", F.lit(0)).alias("is_generated_order"),
        )
    )
