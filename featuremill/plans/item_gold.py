"""Model features of items: reviews, prices, discounts, stock, ads, buy-out."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.functions.dates import (
    BUSINESS_TZ, Bound, day, day_start, trailing_sums, ts, utc_midnight,
)
from featuremill.functions.ratios import prior_mean_smoothed, ratio, ratio_if_positive, ratio_or_zero, shrunk_rate, stable_mean
from featuremill.operators.rows import first_row, with_group_totals
from featuremill.operators.running_sums import RunningSums
from featuremill.operators.staging import Stage, no_stage
from featuremill.plans.item_silver import FAIR_RETURN_CAUSES, PROMOTION_PREFIX, latest_discount_order
from featuremill.plans.search_gold import WINDOWS
from featuremill.sources.scan import live_and_history, partition, trailing

# The mean and weight of the ad revenue prior; the pull of a parent buy-out rate.
AD_PRIOR_MEAN, AD_PRIOR_IMPRESSIONS = 19.9, 50.0
AD_WINDOWS = (7, 14, 30)
AD_SUMS = {"ad_impressions": "imp_{w}", "ad_revenue": "rev_{w}"}
SHRINKAGE_K = 30
DEFAULT_PROMOTION = "0"
# Classes of the price index.
PRICE_INDEX_CLASSES = {
    "CHEAPEST_AMONG_CLUSTER": 0,
    "CHEAPEST_AMONG_COMPETITORS": 1,
    "CHEAPEST_AMONG_COMPETITORS_AND_CLUSTER": 2,
}
_MARKS = {1: "one", 2: "two", 3: "three", 4: "four", 5: "five"}


def feedback_stats(feedback: DataFrame, sku: DataFrame, as_of: date, key: str) -> DataFrame:
    """Review counts and shares of all published reviews before the day, per product or item group."""
    if key not in ("product_id", "sku_group_id"):
        raise ValueError(f"key must be product_id or sku_group_id, got {key!r}")
    used = feedback.where((F.col("status") == "PUBLISHED") & (F.col("date_published") < ts(day_start(as_of))))
    counted = F.col("id").isNotNull()
    rating = F.col("rating")
    counts = {
        "bad_reviews_count": F.count_if(counted & (rating <= 3)),
        "good_reviews_count": F.count_if(counted & (rating > 3)),
        "total_reviews_count": F.count_if(counted),
        **{f"reviews_mark_{n}_count": F.count_if(counted & (rating == m)) for m, n in _MARKS.items()},
        "total_reviews_with_text": F.count_if(counted & (F.coalesce("message", F.lit("")) != "")),
    }
    # Per sku first: the join to the catalogue then handles one row per sku.
    own = ["product_id"] if key == "product_id" else []
    per_sku = used.groupBy("sku_id", *own).agg(
        *[c.alias(n) for n, c in counts.items()],
        F.sum(rating).alias("_sum"), F.count(rating).alias("_rated"),
    )
    attrs = ["sku_group_id"] if key == "sku_group_id" else []
    known = sku.select(F.col("id").alias("sku_id"), *attrs)
    if attrs:
        known = known.where("sku_group_id is not null")
    total = per_sku.join(known, "sku_id").groupBy(F.col(key).cast("bigint").alias(key)).agg(
        *[F.sum(n).cast("bigint").alias(n) for n in counts],
        ratio(F.sum("_sum"), F.sum("_rated")).alias("product_rating"),
    )
    n = "total_reviews_count"
    return total.select(
        day(as_of).alias("date"), key, "product_rating", *counts,
        *[ratio_or_zero(f"reviews_mark_{m}_count", n).alias(f"ratio_reviews_mark_{m}") for m in _MARKS.values()],
        ratio_or_zero("bad_reviews_count", n).alias("ratio_reviews_bad"),
        ratio_or_zero("good_reviews_count", n).alias("ratio_reviews_good"),
    )


def _check_promotion(promotion: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_]+", promotion):
        raise ValueError(f"unsupported promotion id {promotion!r}")
    if promotion != DEFAULT_PROMOTION and not promotion.startswith(PROMOTION_PREFIX):
        raise ValueError(f"promotion id must start with {PROMOTION_PREFIX!r}: {promotion!r}")
    return promotion


def active_promotions(live: DataFrame, history: DataFrame, now: datetime, history_days: int) -> DataFrame:
    """Distinct promotions of the live source and the stored days, in order."""
    both = live_and_history(live, history, now, history_days, ["promotion_id"])
    return both.where(F.col("promotion_id").startswith(PROMOTION_PREFIX)).distinct().orderBy("promotion_id")


def today_discounts(live: DataFrame, calculated_at: datetime, promotion: str) -> DataFrame:
    """Raw discounts of one promotion since midnight."""
    _check_promotion(promotion)
    return live.where(
        (F.col("created_at") >= ts(day_start(calculated_at.date())))
        & (F.col("promotion_id") == promotion)
        & F.col("promotion_id").startswith(PROMOTION_PREFIX)
    ).select(
        F.to_date("created_at").alias("date"),
        F.col("sku_id").cast("bigint").alias("sku_id"),
        "promotion_id",
        F.col("discount_amount").cast("double").alias("discount_amount"),
        F.col("calculated_for_price").cast("double").alias("calculated_for_price"),
        "created_at",
    )


def discounted_prices(
    live: DataFrame,
    history: DataFrame,
    sku: DataFrame,
    calculated_at: datetime,
    promotions: Sequence[str],
    history_days: int,
) -> DataFrame:
    """Price of every sku under every promotion, all promotions in one pass.

    A discount applies only while the price is still the one it was computed
    for. The default promotion has no discounts, so it lists plain prices.
    """
    wanted = [_check_promotion(p) for p in dict.fromkeys(promotions)]
    columns = ["sku_id", "promotion_id", "discount_amount", "calculated_for_price", "created_at"]
    offers = live_and_history(live, history, calculated_at, history_days, columns).where(
        F.col("promotion_id").isin(*wanted) & F.col("promotion_id").startswith(PROMOTION_PREFIX)
    ).select(
        F.col("sku_id").cast("bigint").alias("sku_id"), "promotion_id",
        F.col("discount_amount").cast("double").alias("discount_amount"),
        F.col("calculated_for_price").cast("double").alias("calculated_for_price"),
        "created_at",
    )
    latest = first_row(offers, ["sku_id", "promotion_id"], latest_discount_order())
    # Every sku is listed under every requested promotion: that is the contract of the table.
    listed = sku.select(
        F.col("id").cast("bigint").alias("sku_id"),
        F.col("sku_group_id").cast("bigint").alias("sku_group_id"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("sell_price").cast("double").alias("list_price"),
        F.explode(F.array(*[F.lit(p) for p in wanted])).alias("promotion_id"),
    )
    applies = F.coalesce(F.col("list_price") == F.col("calculated_for_price"), F.lit(False))
    cut = F.when(applies, F.coalesce("discount_amount", F.lit(0.0))).otherwise(F.lit(0.0))
    price = F.when(applies, F.col("list_price") - F.coalesce("discount_amount", F.lit(0.0))).otherwise(
        F.col("list_price")
    )
    return listed.join(latest, ["sku_id", "promotion_id"], "left").select(
        ts(calculated_at).alias("calculated_at"), "sku_id", "promotion_id", "sku_group_id", "product_id",
        "calculated_for_price", cut.alias("discount"), price.alias("sell_price"),
        ratio(cut, price).alias("discount_fraction"),
        F.col("created_at").alias("dynamic_discount_created_at"),
    )


def discounted_prices_by_group(prices: DataFrame, calculated_at: datetime) -> DataFrame:
    """Least, greatest and mean price, discount and discount share per item group and promotion."""
    names = ("sell_price", "discount", "discount_fraction")
    return (
        prices.where(
            (F.col("calculated_at") == ts(calculated_at))
            & F.col("sku_group_id").isNotNull()
            & F.col("promotion_id").isNotNull()
        )
        .groupBy(F.col("sku_group_id").cast("bigint").alias("sku_group_id"), "promotion_id")
        .agg(*[f(c).alias(f"{tag}_{c}") for c in names for tag, f in (("min", F.min), ("max", F.max), ("avg", stable_mean))])
        .select(
            ts(calculated_at).alias("calculated_at"), "sku_group_id", "promotion_id",
            *[f"{tag}_{c}" for c in names for tag in ("min", "max", "avg")],
        )
    )


def price_index_status(index: DataFrame, on: date) -> DataFrame:
    """Price index class as a number; unknown names become NULL, NO_BOOST rows go."""
    classes = F.create_map(*[F.lit(v) for pair in PRICE_INDEX_CLASSES.items() for v in pair])
    return index.where(F.col("price_index_status") != "NO_BOOST").select(
        day(on).alias("date"),
        F.col("sku_group_id").cast("bigint").alias("sku_group_id"),
        classes[F.col("price_index_status")].cast("int").alias("price_index_status"),
    )


def price_features(prices: DataFrame, sku: DataFrame, as_of: date, stage: Stage = no_stage) -> DataFrame:
    """Price level, discount, category mean, and yesterday's least price against its past averages.

    One row per item group and category. The 14- and 30-day averages end two
    days before ``as_of``.
    """
    yesterday = as_of - timedelta(days=1)
    last_past = yesterday - timedelta(days=1)
    first_of = {w: yesterday - timedelta(days=w) for w in (14, 30)}
    d, low = F.col("date"), F.col("min_full_price_eod").cast("double")

    def past(w: int) -> Column:
        return stable_mean(F.when((d >= day(first_of[w])) & (d <= day(last_past)), low)).alias(f"past_{w}")

    today = {"avg_sell": "avg_sell_price_eod", "mid_sell": "median_sell_price_eod", "mid_full": "median_full_price_eod"}
    # One scan of 32 days and one aggregation give today's row, yesterday's price and both averages.
    per_item = (
        prices.where((d >= day(first_of[30])) & (d <= day(as_of)))
        .groupBy(F.col("sku_group_id").cast("bigint").alias("sku_group_id"))
        .agg(
            # One row per item and day, so max only picks it; plain columns keep the aggregation hashed.
            F.max(F.when(d == day(as_of), 1)).alias("here"),
            *[F.max(F.when(d == day(as_of), F.col(c))).alias(n) for n, c in today.items()],
            F.max(F.when(d == day(yesterday), low)).alias("low_yesterday"),
            past(14), past(30),
        )
        .where("here = 1")
    )
    pairs = (
        sku.select(F.col("sku_group_id").cast("bigint").alias("sku_group_id"), F.col("category_id").cast("bigint").alias("category_id"))
        .where("sku_group_id is not null and category_id is not null")
        .distinct()
    )
    placed = with_group_totals(
        stage(per_item.join(pairs, "sku_group_id")), ["category_id"],
        {"category_mean_sell_price": stable_mean("avg_sell")},
    )
    return placed.select(
        day(as_of).alias("date"), "sku_group_id", "category_id", "category_mean_sell_price",
        F.log1p("avg_sell").alias("sell_price_eod"),
        (F.col("mid_full") - F.col("mid_sell")).alias("abs_discount"),
        ratio("mid_sell", "mid_full").alias("fraq_discount"),
        *[ratio("low_yesterday", f"past_{w}").alias(f"ratio_crnt_min_to_avg_min_full_price_{w}") for w in (14, 30)],
    )


def stock_features(stock: DataFrame, sku: DataFrame, as_of: date) -> DataFrame:
    """Stock sums of an item group over eight trailing windows.

    Sums are taken per sku before the catalogue is joined, so the join sees one
    row per sku instead of one per sku and day.
    """
    per_sku = (
        trailing(stock, as_of, max(WINDOWS), Bound.HALF_OPEN)
        .groupBy(F.col("sku_id").cast("bigint").alias("sku_id"))
        .agg(*trailing_sums({"total_stock": "s_{w}"}, WINDOWS, as_of, Bound.HALF_OPEN))
    )
    return _stock_by_group(per_sku, sku, as_of)


def stock_totals(name: str, folder: str, buckets: int = 200) -> RunningSums:
    """Running totals of ``sku_stock_daily`` for ``stock_features_from_totals``."""
    return RunningSums(name, folder, {"sku_id": "bigint"}, {"total_stock": "bigint"}, max(WINDOWS), buckets)


def stock_features_from_totals(totals: RunningSums, sku: DataFrame, as_of: date) -> DataFrame:
    """As ``stock_features``, from the versions at the edges of the windows."""
    per_sku = totals.windows(sku.sparkSession, as_of, WINDOWS, Bound.HALF_OPEN, {"total_stock": "s_{w}"})
    return _stock_by_group(per_sku, sku, as_of)


def _stock_by_group(per_sku: DataFrame, sku: DataFrame, as_of: date) -> DataFrame:
    groups = (
        sku.where("sku_group_id is not null")
        .groupBy(F.col("id").cast("bigint").alias("sku_id"))
        .agg(F.min(F.col("sku_group_id").cast("bigint")).alias("sku_group_id"))
    )
    return (
        per_sku.join(groups, "sku_id")
        .groupBy("sku_group_id")
        .agg(*[F.sum(f"s_{w}").alias(f"skg_total_stock_{w}") for w in WINDOWS])
        .select(day(as_of).alias("date"), "sku_group_id", *[f"skg_total_stock_{w}" for w in WINDOWS])
    )


def ad_revenue_features(daily: DataFrame, as_of: date) -> DataFrame:
    """Ad revenue per impression, plain and pulled to the overall mean."""
    sums = (
        trailing(daily, as_of, max(AD_WINDOWS), Bound.HALF_OPEN)
        .where("sku_group_id is not null")
        .groupBy(F.col("sku_group_id").cast("bigint").alias("sku_group_id"))
        .agg(*trailing_sums(AD_SUMS, AD_WINDOWS, as_of, Bound.HALF_OPEN))
    )
    return _ad_rates(sums, as_of)


def ad_totals(name: str, folder: str, buckets: int = 200) -> RunningSums:
    """Running totals of ``ad_revenue_daily`` for ``ad_revenue_features_from_totals``; revenue is kept to ten decimals."""
    measures = {"ad_impressions": "bigint", "ad_revenue": "decimal(38,10)"}
    return RunningSums(name, folder, {"sku_group_id": "bigint"}, measures, max(AD_WINDOWS), buckets)


def exact_revenue(daily: DataFrame) -> DataFrame:
    """Daily ad revenue as a decimal, as its running totals want it."""
    return daily.withColumn("ad_revenue", F.col("ad_revenue").cast("decimal(28,10)"))


def ad_revenue_features_from_totals(totals: RunningSums, spark: SparkSession, as_of: date) -> DataFrame:
    """As ``ad_revenue_features``, from the versions at the edges of the windows."""
    return _ad_rates(totals.windows(spark, as_of, AD_WINDOWS, Bound.HALF_OPEN, AD_SUMS), as_of)


def _ad_rates(sums: DataFrame, as_of: date) -> DataFrame:
    return sums.select(
        day(as_of).alias("date"), "sku_group_id",
        *[
            prior_mean_smoothed(f"rev_{w}", f"imp_{w}", AD_PRIOR_MEAN, AD_PRIOR_IMPRESSIONS).alias(f"smooth_adrev_per_imp_{w}")
            for w in AD_WINDOWS
        ],
        *[ratio(f"rev_{w}", f"imp_{w}").alias(f"adrev_per_imp_{w}") for w in AD_WINDOWS],
    )


_SIGNAL_KEYS = {
    "sku": "sku_id", "product": "product_id", "category": "category_id", "shop": "shop_id", "brand": "brand_name_id",
}


def item_buyout_signal(history: DataFrame, sku: DataFrame, as_of: date, tz: str = BUSINESS_TZ) -> DataFrame:
    """Delivery outcomes over 90 and 30 days per sku, product, category, shop and brand, in long form.

    Items are reduced to one row per sku and category first. The catalogue join
    and the five grouping sets then work on that, not on order items repeated
    five times.
    """
    since = {w: utc_midnight(as_of - timedelta(days=w), tz) for w in (30, 90)}
    st, cause = F.col("real_order_item_status"), F.nullif(F.col("return_cause"), F.lit(""))
    no = F.lit(False)
    delivered = F.coalesce(
        F.col("delivered_at").isNotNull() | ((F.col("delivery_type") == "COURIER") & F.col("issued_at").isNotNull()), no
    )
    completed, no_show = st == "COMPLETED", st == "RETURNED NO SHOW"
    refused = F.coalesce(no_show | ((st == "RETURNED") & (cause == "CANCELED")), no)
    fair = F.coalesce(F.col("returned_at").isNotNull() & cause.isin(*FAIR_RETURN_CAUSES), no)
    before = st == "RETURNED BEFORE DELIVERY"
    money = F.col("gmv_generated")
    flags = {
        "n_rows": F.lit(True), "n_delivered": delivered, "n_completed": delivered & completed,
        "n_no_show": no_show, "n_nonbuyout_client": refused, "n_cancel_before_delivery": before,
    }
    long_flags = {"n_return_after_completed": st == "RETURNED AFTER COMPLETED", "n_fair_return": fair}
    amounts = {"gmv_delivered": delivered, "gmv_completed": delivered & completed, "gmv_fair_return": fair}
    lately = F.col("generated_at") >= ts(since[30])
    measures = {
        **{f"{n}_90d": F.count_if(c) for n, c in {**flags, **long_flags}.items()},
        **{f"{n}_90d": F.coalesce(F.sum(F.when(c, money)), F.lit(0)) for n, c in amounts.items()},
        **{f"{n}_30d": F.count_if(c & lately) for n, c in flags.items()},
        "_n_lately": F.count_if(lately),
    }
    per_sku = (
        history.where(
            (F.col("analyze_date") == day(as_of)) & (F.col("generated_at") >= ts(since[90])) & (st != "ACTIVE")
        )
        .groupBy("sku_id", "category_id")
        .agg(*[c.alias(n) for n, c in measures.items()])
        .join(sku.select(F.col("id").alias("sku_id"), "product_id", "shop_id", "brand_name_id"), "sku_id", "left")
    )
    keys = list(_SIGNAL_KEYS.values())
    sets = per_sku.groupingSets([[k] for k in keys], *keys).agg(
        *[F.sum(n).alias(n) for n in measures],
        *[F.grouping(k).alias(f"_g_{k}") for k in keys],
    )
    # The key of the level is chosen by the grouping, never by "first not NULL".
    key_type, key_id = F.lit("brand"), F.col("brand_name_id")
    for name, k in reversed(list(_SIGNAL_KEYS.items())[:-1]):
        here = F.col(f"_g_{k}") == 0
        key_type = F.when(here, F.lit(name)).otherwise(key_type)
        key_id = F.when(here, F.col(k)).otherwise(key_id)
    named = sets.withColumns({"key_type": key_type, "key_id": key_id}).where("key_id is not null")
    # Sums over a window without any row are NULL, counts are 0.
    thirty = [
        (F.col(f"{n}_30d") if n == "n_rows" else F.when(F.col("_n_lately") > 0, F.col(f"{n}_30d"))).alias(f"{n}_30d")
        for n in flags
    ]
    ninety = ["n_rows", "n_delivered", "n_completed", "n_no_show", "n_nonbuyout_client",
              "n_return_after_completed", "n_fair_return", "n_cancel_before_delivery"]
    rate = ratio_if_positive
    return named.select(
        day(as_of).alias("date"), "key_type", F.col("key_id").cast("bigint").alias("key_id"),
        *[f"{n}_90d" for n in ninety],
        *[F.col(f"{n}_90d").cast("double").alias(f"{n}_90d") for n in amounts],
        *thirty,
        rate("n_completed_90d", "n_delivered_90d").alias("buyout_rate_items_90d"),
        rate("n_no_show_90d", "n_delivered_90d").alias("no_show_rate_90d"),
        rate("n_nonbuyout_client_90d", "n_delivered_90d").alias("nonbuyout_rate_90d"),
        rate("gmv_completed_90d", F.col("gmv_delivered_90d") - F.col("gmv_fair_return_90d")).alias("buyout_rate_money_90d"),
        rate("n_cancel_before_delivery_90d", "n_rows_90d").alias("cancel_before_delivery_rate_90d"),
        rate("n_completed_30d", "n_delivered_30d").alias("buyout_rate_items_30d"),
        rate("n_no_show_30d", "n_delivered_30d").alias("no_show_rate_30d"),
        rate("n_nonbuyout_client_30d", "n_delivered_30d").alias("nonbuyout_rate_30d"),
        rate("n_cancel_before_delivery_30d", "n_rows_30d").alias("cancel_before_delivery_rate_30d"),
    )


def sku_buyout_online(signal: DataFrame, sku: DataFrame, as_of: date) -> DataFrame:
    """Own and parent rates of every sku, with rates pulled down a hierarchy: all -> category -> sku or product."""
    sig = partition(signal, as_of)
    level = lambda t: sig.where(F.col("key_type") == t)
    n90 = "n_delivered_90d"
    # Overall rates are scalar subqueries, not joins.
    overall = {
        c: level("category").select(ratio(F.sum(f"n_{c}_90d"), F.sum(n90))).scalar() for c in ("completed", "no_show")
    }
    category = level("category").select(
        F.col("key_id").alias("category_id"), F.col(n90).alias("cat_n_delivered_90d"),
        shrunk_rate("buyout_rate_items_90d", n90, overall["completed"], SHRINKAGE_K).alias("category_buyout_rate_90d"),
        shrunk_rate("no_show_rate_90d", n90, overall["no_show"], SHRINKAGE_K).alias("category_no_show_rate_90d"),
    )

    def parent(t: str, key: str, cols: dict[str, str]) -> DataFrame:
        return level(t).select(F.col("key_id").alias(key), *[F.col(c).alias(f"{t}_{out}") for c, out in cols.items()])

    counts = {n90: n90, "buyout_rate_items_90d": "buyout_rate_90d"}
    own = level("sku").select(
        F.col("key_id").alias("sku_id"),
        F.col(n90).alias("sku_n_delivered_90d"), F.col("n_delivered_30d").alias("sku_n_delivered_30d"),
        F.col("buyout_rate_items_90d").alias("sku_buyout_rate_90d"),
        F.col("buyout_rate_items_30d").alias("sku_buyout_rate_30d"),
        F.col("no_show_rate_90d").alias("sku_no_show_rate_90d"),
        F.col("nonbuyout_rate_90d").alias("sku_nonbuyout_rate_90d"),
        F.col("buyout_rate_money_90d").alias("sku_buyout_rate_money_90d"),
        F.col("cancel_before_delivery_rate_90d").alias("sku_cancel_before_delivery_rate_90d"),
    )
    attrs = sku.select(F.col("id").alias("sku_id"), "product_id", "category_id", "shop_id", "brand_name_id")
    joined = (
        own.join(attrs, "sku_id")
        .join(parent("product", "product_id", {**counts, "no_show_rate_90d": "no_show_rate_90d"}), "product_id", "left")
        .join(category, "category_id", "left")
        .join(parent("shop", "shop_id", counts), "shop_id", "left")
        .join(parent("brand", "brand_name_id", counts), "brand_name_id", "left")
    )
    pulled = joined.withColumns({
        "sku_buyout_rate_shrunk_90d": shrunk_rate("sku_buyout_rate_90d", "sku_n_delivered_90d", "category_buyout_rate_90d", SHRINKAGE_K),
        "sku_no_show_rate_shrunk_90d": shrunk_rate("sku_no_show_rate_90d", "sku_n_delivered_90d", "category_no_show_rate_90d", SHRINKAGE_K),
        "product_buyout_rate_shrunk_90d": shrunk_rate(
            "product_buyout_rate_90d", F.coalesce("product_n_delivered_90d", F.lit(0)), "category_buyout_rate_90d", SHRINKAGE_K
        ),
    })
    return pulled.select(
        day(as_of).alias("date"), "sku_id", "product_id", "category_id", "shop_id", "brand_name_id",
        *[c for c in own.columns if c != "sku_id"],
        "product_n_delivered_90d", "product_buyout_rate_90d", "product_no_show_rate_90d",
        "cat_n_delivered_90d", "category_buyout_rate_90d", "category_no_show_rate_90d",
        "shop_n_delivered_90d", "shop_buyout_rate_90d", "brand_n_delivered_90d", "brand_buyout_rate_90d",
        "sku_buyout_rate_shrunk_90d", "sku_no_show_rate_shrunk_90d", "product_buyout_rate_shrunk_90d",
        (F.col("sku_buyout_rate_shrunk_90d") - F.col("product_buyout_rate_shrunk_90d")).alias("sku_vs_product_gap_90d"),
    )


CITY_COST_COLUMNS = (
    "city_id", "dimensional_group", "region_id", "cpi_forward_uzs", "cpi_reverse_uzs",
    "n_items_delivered", "n_items_reverse", "cpi_forward_region_uzs", "cpi_reverse_region_uzs",
    "cpi_forward_country_uzs", "cpi_reverse_country_uzs",
)


def serving_projection(table: DataFrame, as_of: date, columns: Sequence[str]) -> DataFrame:
    """The named columns of one partition; a column added upstream does not slip through."""
    return partition(table, as_of).select(day(as_of).alias("date"), *[c for c in columns if c != "date"])


def city_cost_online(unit_costs: DataFrame, as_of: date) -> DataFrame:
    return serving_projection(unit_costs, as_of, CITY_COST_COLUMNS)


