"""Search and click-stream pre-aggregates.

Daily builders take a range of days [start, end) and produce every day's
partition in one plan: the day is part of every key, so the result of a range
equals the union of single-day runs, for one scan instead of many.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremill.functions.dates import (
    BUSINESS_TZ, between_instants, business_date, day, day_start, utc_midnight,
)
from featuremill.functions.jsonpaths import text_array, unquoted
from featuremill.functions.ratios import ratio
from featuremill.functions.text import has_text, lowered_key, non_blank
from featuremill.operators.attribution import last_before
from featuremill.operators.relevance import field_scores
from featuremill.operators.rows import first_row, top_list
from featuremill.operators.skew import lookup_where
from featuremill.operators.state_table import StateTable

# Fixed values of the event model.
IMPRESSION, VIEW, CART, FAVOURITE = "PRODUCT_IMPRESSION", "PRODUCT_VIEW", "ADD_TO_CART", "ADD_TO_FAVORITES"
SEARCH, CATEGORY = "SEARCH_RESULTS", "CATEGORY"
SEARCH_SPACES = ("SHOP_SEARCH_RESULTS", "COLLECTION_SEARCH_RESULTS", "SEARCH", "SEARCH_RESULTS")
UNPLACED = ("CREATED", "NOT_CREATED")
TOP_QUERY_MODEL = "search_unified_model_v9"
SCORE_MODEL_LIKE = "%search_uni%"


def account_category_events(
    events: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    start: date,
    end: date,
    level: int,
    tz: str = BUSINESS_TZ,
) -> DataFrame:
    """Distinct products seen, viewed, carted and liked per account and category level."""
    if level not in (1, 2, 3):
        raise ValueError(f"level must be 1, 2 or 3, got {level}")
    # A missing level falls back to the nearest level above it.
    at_level = F.coalesce(
        *[F.when(F.col(f"l{i}_category") > 0, F.col(f"l{i}_category")) for i in range(level, 1, -1)],
        F.col("l1_category"),
    )
    levels = categories.select(F.col("id").alias("own_category"), at_level.alias("level_category"))
    used = (
        events.where(between_instants(F.col("received_at"), utc_midnight(start, tz), utc_midnight(end, tz)))
        .where((F.col("account_id") > 0) & F.col("event_type").isin(IMPRESSION, VIEW, CART, FAVOURITE))
        .select(
            business_date(F.col("received_at"), tz).alias("date"),
            "account_id", "session_id", "product_id", "event_type", "category_id",
        )
    )
    # Only events without a category of their own ask the product for one.
    lacking = ~F.coalesce(F.col("category_id") > 0, F.lit(False))
    own = products.select(F.col("id").alias("product_id"), F.col("category_id").alias("product_category"))
    placed = (
        lookup_where(used, own, "product_id", lacking, ["account_id", "session_id", "product_id"])
        .withColumn(
            "own_category",
            F.when(F.col("category_id") > 0, F.col("category_id")).otherwise(F.col("product_category")),
        )
        .join(levels, "own_category")
    )
    outs = {"n_imps": IMPRESSION, "n_clicks": VIEW, "n_atcs": CART, "n_atfs": FAVOURITE}
    # One row per product and session first: the distinct counts become sums of flags.
    products_seen = placed.groupBy("date", "account_id", "level_category", "session_id", "product_id").agg(
        *[
            F.max(F.when((F.col("event_type") == kind) & F.col("product_id").isNotNull(), 1).otherwise(0)).alias(name)
            for name, kind in outs.items()
        ]
    )
    return products_seen.groupBy(
        "date", "account_id", F.col("level_category").alias("category_id")
    ).agg(*[F.sum(name).cast("bigint").alias(name) for name in outs])


def _section_or_zero(category: Column, section: Column) -> Column:
    """Category id as text; -1, 0 and NULL fall back to the section id, then to 0."""
    real = F.when(~category.isin(-1, 0), category.cast("bigint"))
    return F.coalesce(real, section.try_cast("bigint"), F.lit(0)).cast("string")


def search_funnel_daily(events: DataFrame, sku: DataFrame, start: date, end: date) -> DataFrame:
    """Impressions, clicks and carts per install, item, space and query (or category).

    Clicks and carts go to the impression that immediately precedes them among
    the impressions and clicks (or carts) of the same session and product.
    """
    used = events.where(
        between_instants(F.col("received_at"), day_start(start), day_start(end))
        & F.col("event_type").isin(IMPRESSION, VIEW, CART)
        & F.col("session_id").isNotNull()
        & F.col("install_id").isNotNull()
    )
    groups = sku.select(F.col("id").alias("sku_id"), F.col("sku_group_id").alias("mapped_group")).distinct()
    param = "$.event_parameters."
    lacking = F.coalesce(F.col("sku_group_id"), F.lit(0)) == 0
    group = [
        F.to_date("received_at").alias("date"),
        "session_id",
        # Events without a product look back at nothing: each is a group of its own.
        F.coalesce(F.col("product_id").cast("string"), F.concat(F.lit("event "), "event_id")).alias("product"),
    ]
    rows = lookup_where(used, groups, "sku_id", lacking, ["event_id"]).select(
        *group,
        "logged_at", "event_id", "event_type",
        F.col("product_id").isNotNull().alias("has_product"),
        F.col("install_id").cast("string").alias("install_id"),
        "widget_space_name",
        F.coalesce("widget_section_name", "widget_space_name").alias("section"),
        F.coalesce(
            F.when(F.col("sku_group_id") != 0, F.col("sku_group_id")), F.col("mapped_group"), F.lit(0)
        ).cast("bigint").alias("sku_group_id"),
        (
            F.coalesce(F.get_json_object("event_properties", param + "is_category_full_matched"), F.lit("false"))
            == "true"
        ).alias("full_match"),
        F.coalesce(
            non_blank(F.col("query")),
            non_blank(F.get_json_object("event_properties", param + "initial_query")),
            F.lit(""),
        ).alias("search_text"),
        _section_or_zero(F.col("category_id"), F.col("widget_section_id")).alias("category_text"),
    )
    looked_back = last_before(
        rows, ["date", "session_id", "product"], "logged_at", "event_id",
        {
            "before_click": lambda r: r["event_type"].isin(IMPRESSION, VIEW),
            "before_cart": lambda r: r["event_type"].isin(IMPRESSION, CART),
        },
    )
    # Each event gives at most one credit: an impression to itself, a click or cart to
    # the impression right before it.
    row, kind = F.col("row"), F.col("row.event_type")
    touch = (
        F.when(kind == IMPRESSION, row)
        .when((kind == VIEW) & row["has_product"], F.col("before_click"))
        .when((kind == CART) & row["has_product"], F.col("before_cart"))
    )
    credited = looked_back.select("date", row["install_id"].alias("install_id"), kind.alias("kind"), touch.alias("t")).where(
        (F.col("t.event_type") == IMPRESSION) & F.col("t.section").isin(SEARCH, CATEGORY)
    )
    # Impressions are told apart by their space, reactions by the section of the impression.
    place = F.when(F.col("kind") == IMPRESSION, F.col("t.widget_space_name")).otherwise(F.col("t.section"))
    in_search = (place == SEARCH) & ~F.col("t.full_match")
    hits = {"sum_atc": CART, "sum_clicks": VIEW, "sum_impressions": IMPRESSION}
    return credited.groupBy(
        "date", "install_id",
        F.col("t.sku_group_id").alias("sku_group_id"),
        F.when(in_search, F.lit(SEARCH)).otherwise(F.lit(CATEGORY)).alias("space"),
        F.when(in_search, F.col("t.search_text")).otherwise(F.col("t.category_text")).alias("uniqs"),
    ).agg(*[F.count_if(F.col("kind") == k).alias(name) for name, k in hits.items()])


def query_item_daily_conversions(
    events: DataFrame, sku: DataFrame, order_items: DataFrame, attribution: DataFrame, start: date, end: date
) -> DataFrame:
    """Distinct sessions with an impression, click or cart, and orders, per query, platform and item.

    A click (cart) counts when the event before it in the session and item was
    in search results. An event without a query takes the query of the event
    before it. The cart side looks at impressions and carts only.
    """
    groups = sku.select(F.col("id").alias("sku_id"), F.col("sku_group_id").alias("mapped_group")).distinct()
    used = events.where(
        between_instants(F.col("received_at"), day_start(start), day_start(end))
        # The empty event type is a real one: it can be the event before.
        & F.col("event_type").isin(IMPRESSION, VIEW, CART, "")
        & F.col("install_id").isNotNull()
        & F.col("session_id").isNotNull()
    )
    rows = (
        lookup_where(used, groups, "sku_id", F.col("sku_group_id").isNull(), ["event_id"])
        .select(
            F.to_date("received_at").alias("date"),
            F.coalesce("sku_group_id", "mapped_group").cast("bigint").alias("sku_group_id"),
            "session_id", "platform", "event_type", "widget_section_name", "logged_at", "event_id",
            F.lower("query").alias("query"),
        )
        # Rows without an item form groups of their own and are not part of the result.
        .where(F.col("sku_group_id").isNotNull())
    )
    looked_back = last_before(
        rows, ["date", "session_id", "sku_group_id"], "logged_at", "event_id",
        {
            "before_click": lambda r: F.lit(True),
            "before_cart": lambda r: r["event_type"].isin(IMPRESSION, CART),
        },
    )
    own = F.col("row")

    def side(prev: str, kind: str, name: str) -> Column:
        seen_before = F.col(prev).isNotNull()
        prev_query = F.when(seen_before, F.col(prev)["query"]).otherwise(F.lit("0"))
        prev_list = F.when(seen_before, F.col(prev)["widget_section_name"]).otherwise(F.lit("0"))
        return F.struct(
            F.lit(name).alias("side"),
            F.when(own["query"].isNull(), prev_query).otherwise(own["query"]).alias("query"),
            F.coalesce(
                (own["event_type"] == IMPRESSION) & (own["widget_section_name"] == SEARCH), F.lit(False)
            ).alias("shown"),
            F.coalesce((own["event_type"] == kind) & (prev_list == SEARCH), F.lit(False)).alias("hit"),
        )

    clicks = side("before_click", VIEW, "click")
    carts = F.when(own["event_type"].isin(IMPRESSION, CART), side("before_cart", CART, "cart"))
    both = looked_back.select(
        "date", own["platform"].alias("platform"), "sku_group_id", "session_id",
        F.explode(F.array(clicks, carts)).alias("s"),
    ).where("s is not null").select(
        "date", "platform", "sku_group_id", "session_id", "s.query",
        (F.col("s.side") == "click").alias("click_side"),
        F.col("s.shown").alias("shown"), F.col("s.hit").alias("hit"),
    )
    per_session = both.groupBy("date", "query", "platform", "sku_group_id", "session_id").agg(
        F.max("click_side").alias("on_click_side"),
        F.min("click_side").alias("only_click_side"),
        F.max(F.col("click_side") & F.col("shown")).alias("shown"),
        F.max(F.col("click_side") & F.col("hit")).alias("clicked"),
        F.max(~F.col("click_side") & F.col("hit")).alias("carted"),
    )
    conversions = (
        per_session.groupBy("date", "query", "platform", "sku_group_id")
        .agg(
            F.max("on_click_side").alias("_has_clicks"),
            F.min("only_click_side").alias("_no_carts"),
            F.count_if("shown").alias("uniq_impressions"),
            F.count_if("clicked").alias("uniq_clicks"),
            F.count_if("carted").alias("uniq_atcs"),
        )
        # Keys must occur on both sides, as with an inner join of the two.
        .where(F.col("_has_clicks") & ~F.col("_no_carts"))
        .where(F.col("query").isNotNull() & F.col("platform").isNotNull() & (F.col("uniq_impressions") != 0))
    )
    in_range = between_instants(F.col("generated_at"), day_start(start), day_start(end))
    credited = (
        attribution.where(in_range & (F.col("widget_section_name") == SEARCH))
        .select("order_item_id", F.to_date("generated_at").alias("date"), "query",
                F.col("last_atc_platform").alias("platform"))
        .distinct()
    )
    items = order_items.where(in_range & ~F.col("order_item_status").isin(*UNPLACED)).select(
        "order_item_id", F.to_date("generated_at").alias("date"), "sku_id"
    )
    orders = (
        credited.join(items, ["order_item_id", "date"])
        .join(groups, "sku_id", "left")
        .select("date", "query", "platform", F.col("mapped_group").cast("bigint").alias("sku_group_id"), "order_item_id")
        .distinct()
        .groupBy("date", "query", "platform", "sku_group_id")
        .agg(F.count(F.lit(1)).alias("uniq_orders"))
    )
    return (
        conversions.join(orders, ["date", "query", "platform", "sku_group_id"], "left")
        .withColumn("query", F.trim("query"))
        .where(~F.col("query").isin("0", ""))
        .select(
            "date", "query", "platform", "sku_group_id",
            *[
                F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                for c in ("uniq_impressions", "uniq_clicks", "uniq_atcs", "uniq_orders")
            ],
        )
    )


def product_top_queries(
    ranking_events: DataFrame,
    sku: DataFrame,
    end: datetime,
    days: int = 14,
    model: str = TOP_QUERY_MODEL,
    limit: int = 200,
) -> DataFrame:
    """The queries that most installs used and that ranked the product, up to ``limit``, best first."""
    used = ranking_events.where(
        between_instants(F.col("fired_at"), end - timedelta(days=days), end)
        & (F.col("model_name") == model)
        & (F.size("ranking_candidates") > 0)
    ).select("search_query", "install_id", "ranking_candidates")
    installs = (
        used.where(F.col("install_id").isNotNull())
        .select("search_query", "install_id").distinct()
        .groupBy("search_query").agg(F.count(F.lit(1)).alias("installs"))
    )
    products = sku.select(
        F.col("sku_group_id").cast("bigint").alias("sku_group_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
    ).where("sku_group_id is not null and product_id is not null").distinct()
    ranked = (
        used.select("search_query", F.explode("ranking_candidates").alias("c"))
        .select("search_query", F.col("c").try_cast("bigint").alias("sku_group_id"))
        .distinct()
        .join(products, "sku_group_id")
        .select("product_id", "search_query").distinct()
        .alias("r")
        # NULL is a query of its own here.
        .join(installs.alias("i"), F.col("r.search_query").eqNullSafe(F.col("i.search_query")), "left")
        .select("product_id", "r.search_query", F.coalesce("installs", F.lit(0)).alias("installs"))
    )
    best = top_list(
        ranked, ["product_id"], [F.col("installs").desc(), F.col("search_query").asc_nulls_first()],
        "search_query", limit, "search_queries",
    )
    return best.select(day(end.date()).alias("date"), "product_id", "search_queries")


def ranking_scores(
    ranking_events: DataFrame, start: datetime, end: datetime, model_like: str = SCORE_MODEL_LIKE,
    path: str = "$.dssm_score",
) -> DataFrame:
    """(fired_at, query, sku_group_id, score): one row per candidate.

    The score is an array parallel to the candidates, or one number for all of
    them. Arrays of another length are ignored.
    """
    used = ranking_events.where(
        between_instants(F.col("fired_at"), start, end)
        & F.col("model_name").like(model_like)
        & (F.size("ranking_candidates") > 0)
        & has_text(F.col("search_query"))
        & F.col("external_features").isNotNull()
    ).select(
        "fired_at", F.col("search_query").alias("query"), "ranking_candidates",
        F.get_json_object("external_features", path).alias("raw"),
    ).withColumn("scores", text_array(F.col("raw")))
    n = F.size("ranking_candidates")
    # One array of texts per event, whichever form the score has: a single explode follows.
    per_item = F.when(F.col("scores").isNotNull(), F.when(F.size("scores") == n, F.col("scores"))).otherwise(
        F.array_repeat(unquoted(F.col("raw")), n)
    )
    return (
        used.select("fired_at", "query", F.explode(F.arrays_zip("ranking_candidates", per_item.alias("s"))).alias("z"))
        .select(
            "fired_at", "query",
            F.col("z.ranking_candidates").try_cast("bigint").alias("sku_group_id"),
            F.col("z.s").try_cast("double").alias("score"),
        )
        .where("sku_group_id is not null and score is not null")
    )


SCORE_KEY = ("query", "sku_group_id")
SCORE_STATE = T.StructType([
    T.StructField("query", T.StringType()), T.StructField("sku_group_id", T.LongType()), T.StructField("dssm_score", T.DoubleType()),
    T.StructField("collected_at", T.TimestampNTZType()), T.StructField("date", T.DateType()),
])


def score_change_log(
    ranking_events: DataFrame,
    logged: DataFrame,
    on: date,
    collected_at: datetime,
    threshold: float = 0.05,
) -> DataFrame:
    """Rows to append for day ``on``: new pairs, and pairs whose score moved by the threshold or more.

    Looks for the newest score of each pair in the whole log; :func:`score_changes` takes them from a state table.
    """
    current = first_row(logged, [*SCORE_KEY], [F.col("collected_at").desc(), F.col("date").desc()])
    return score_changes(ranking_events, current, on, collected_at, threshold)


def score_changes(ranking_events: DataFrame, state: DataFrame, on: date, collected_at: datetime, threshold: float = 0.05) -> DataFrame:
    """As :func:`score_change_log`, from ``state``, which has the newest score of each pair once."""
    scores = ranking_scores(ranking_events, day_start(on), day_start(on + timedelta(days=1)))
    today = first_row(scores, [*SCORE_KEY], [F.col("fired_at").desc(), F.col("score").desc()])
    current = state.select(*SCORE_KEY, F.col("dssm_score").alias("old"))
    old, new = F.col("old"), F.col("score")
    moved = old.isNull() | F.when(old == 0, F.abs(new) > 0).otherwise(
        ratio(F.abs(new - old), F.abs(old)) >= threshold
    )
    return (
        today.join(current, [*SCORE_KEY], "left")
        .where(moved)
        .select(
            day(on).alias("date"), "query", "sku_group_id",
            F.lit(collected_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("collected_at"),
            new.alias("dssm_score"),
        )
    )


def run_score_log(
    ranking_events: DataFrame, state: StateTable, on: date, collected_at: datetime, stage: Callable[[DataFrame], DataFrame], threshold: float = 0.05
) -> DataFrame:
    """One day of the log through the state: the rows to append; afterwards the state is that of the day.

    The rows are staged first, so the log and the state are made of the same ones. Running the day again gives both again.
    """
    before = state.before(ranking_events.sparkSession, on)
    changes = stage(score_changes(ranking_events, before, on, collected_at, threshold))
    state.write(on, state.merged(before, changes))
    return changes


def query_candidate_pairs(
    events: DataFrame, search_logs: DataFrame, on: date, min_installs: int = 2
) -> DataFrame:
    """Distinct (query, sku_group_id): item groups shown for a result query that at least ``min_installs`` installs reached."""
    if min_installs < 1:
        raise ValueError("min_installs must be at least 1")
    lo, hi = day_start(on), day_start(on + timedelta(days=1))
    shown = (
        events.where(
            between_instants(F.col("logged_at"), lo, hi)
            & between_instants(F.col("received_at"), lo, hi)
            & (F.col("event_type") == IMPRESSION)
            & (F.col("widget_space_name") == SEARCH)
            & (F.col("widget_section_name") == SEARCH)
            & has_text(F.col("query"))
            & ~F.coalesce("is_full_catpred", F.lit(False))
            & F.col("sku_group_id").isNotNull()
        )
        .select(lowered_key(F.col("query")).alias("search_query"), F.col("sku_group_id").cast("bigint").alias("sku_group_id"))
        .distinct()
    )
    asked = F.coalesce(F.nullif(F.col("corrected_query_text"), F.lit("")), F.col("query_text"))
    reached = (
        search_logs.where(
            between_instants(F.col("logged_at"), lo - timedelta(days=1), hi) & (F.col("query_text") != "")
        )
        .select(lowered_key(asked).alias("search_query"), F.col("result_query_text").alias("query"), "install_id")
        .where(has_text(F.col("query")) & F.col("install_id").isNotNull())
        .distinct()
        .groupBy("search_query", "query").agg(F.count(F.lit(1)).alias("installs"))
        .where(F.col("installs") >= min_installs)
    )
    return reached.join(shown, "search_query").select("query", "sku_group_id").distinct()


def query_candidates(
    events: DataFrame, search_logs: DataFrame, on: date, min_installs: int = 2
) -> DataFrame:
    """The candidate pairs as one sorted list per query, as the table has them; other builders take the pairs."""
    return (
        query_candidate_pairs(events, search_logs, on, min_installs)
        .groupBy("query").agg(F.sort_array(F.collect_list("sku_group_id")).alias("sku_group_ids"))
        .select(day(on).alias("date"), "query", "sku_group_ids")
    )


def relevance_features(
    pairs: DataFrame,
    items: DataFrame,
    fields: list[str],
    factors: list[str],
    on: date,
) -> DataFrame:
    """BM25 scores per field, field-value factors and total score for candidate pairs (query, sku_group_id).

    ``items`` has one row per sku_group_id with the text ``fields`` and the
    numeric ``factors``; other columns are passed through. Pairs without any
    matching term are not returned. Term scores of a field are listed in term
    order.
    """
    scores = field_scores(items, pairs, "sku_group_id", fields)
    per_pair = scores.groupBy("query", "sku_group_id").agg(
        *[
            F.transform(
                F.sort_array(F.collect_list(F.when(F.col("field") == f, F.struct("term", "score")))),
                lambda s: s["score"],
            ).alias(f"bm25_{f}")
            for f in fields
        ],
    )
    added = F.lit(0.0)
    for f in fields:
        added = added + F.aggregate(f"bm25_{f}", F.lit(0.0), lambda a, x: a + x)
    factor_sum = F.lit(0.0)
    for f in factors:
        factor_sum = factor_sum + F.coalesce(F.col(f).cast("double"), F.lit(0.0))
    rest = [c for c in items.columns if c not in (*fields, *factors, "sku_group_id")]
    return per_pair.join(items, "sku_group_id").select(
        day(on).alias("date"), "query", "sku_group_id", *rest,
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f"{f}_field") for f in factors],
        *[f"bm25_{f}" for f in fields],
        added.alias("bms"),
        (added + factor_sum).alias("total_score"),
    )
