"""Order, price, stock, discount, cost and account pre-aggregates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featuremill.functions.dates import between_instants, day, day_start
from featuremill.functions.ratios import ratio
from featuremill.operators.outcomes import lower_median
from featuremill.operators.rows import first_row
from featuremill.plans.search_silver import SEARCH_SPACES, UNPLACED
from featuremill.sources.scan import not_in_keep_sql_nulls

LOOKBACK_DAYS = 20
# Return causes the customer is not responsible for.
FAIR_RETURN_CAUSES = (
    "MISSING",
    "DEFECTED",
    "BAD_QUALITY",
    "WRONG_ITEM",
    "PHOTO_MISMATCH",
    "CONTENT",
)
CATEGORY_LEVELS = ("leaf", "l1", "l2", "l3", "l4")
PROMOTION_PREFIX = "dyno_pricing_"
SIZE_GROUPS = ("SMALL", "MEDIUM", "LARGE")

_ORDER_MEASURES = (
    "orders_generated", "items_generated", "gmv_generated",
    "items_completed", "gmv_completed", "completed_orders",
    "returned_items", "returned_gmv", "returned_orders",
)


def _item_days(order_items: DataFrame, start: date, end: date, until_midnight: bool) -> DataFrame:
    """Order items repeated for each day on which something countable happened to them.

    An item counts on the day it was generated; on the day it was issued, when
    it is completed and was not returned by the end of that day; and on the day
    it was returned. Issue and return count for items generated in the 20 days
    before. So one scan serves all three counts of all days.
    ``until_midnight`` admits items generated exactly at the end of the day.
    """
    lo, hi = day_start(start), day_start(end)
    near = order_items.where(
        between_instants(F.col("generated_at"), lo - timedelta(days=LOOKBACK_DAYS), hi + timedelta(days=1))
        & ~F.col("order_item_status").isin(*UNPLACED)
    )

    def on(ts_col: str, role: str, extra: Column) -> Column:
        d = F.to_date(ts_col)
        inside = (d >= day(start)) & (d < day(end))
        return F.when(inside & extra, F.struct(d.alias("date"), F.lit(role).alias("role")))

    def recent(ts_col: str) -> Column:
        d = F.to_date(ts_col)
        next_midnight = F.date_add(d, 1).cast("timestamp_ntz")
        before_end = (
            F.col("generated_at") <= next_midnight if until_midnight else F.col("generated_at") < next_midnight
        )
        return before_end & (F.to_date("generated_at") >= F.date_sub(d, LOOKBACK_DAYS))

    completed = (F.col("order_item_status") == "COMPLETED") & (
        F.col("returned_at").isNull() | (F.to_date("returned_at") > F.to_date("issued_at"))
    )
    roles = F.array(
        on("generated_at", "generated", F.lit(True)),
        on("issued_at", "completed", completed & recent("issued_at")),
        on("returned_at", "returned", recent("returned_at")),
    )
    # The empty roles go after the explode: a filter stays in generated code, a lambda would not.
    return near.select("*", F.explode(roles).alias("_r")).where("_r is not null").select(
        *near.columns, F.col("_r.date").alias("date"), F.col("_r.role").alias("role")
    )


def _amounts() -> list[Column]:
    def total(role: str, col: str) -> Column:
        return F.sum(F.when(F.col("role") == role, F.col(col)))

    return [
        total("generated", "item_quantity").alias("items_generated"),
        total("generated", "gmv_generated").alias("gmv_generated"),
        total("completed", "item_quantity").alias("items_completed"),
        total("completed", "gmv_completed").alias("gmv_completed"),
        total("returned", "returned_quantity").alias("returned_items"),
        total("returned", "gmv_returned").alias("returned_gmv"),
        *[F.max(F.when(F.col("role") == r, 1)).alias(f"_{r}") for r in ("generated", "completed", "returned")],
    ]


def _roll_up(per_order: DataFrame, keys: list[str]) -> DataFrame:
    counts = {"orders_generated": "_generated", "completed_orders": "_completed", "returned_orders": "_returned"}
    summed = per_order.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(counts.get(m, m)), F.lit(0))
            .cast("double" if "gmv" in m else "bigint")
            .alias(m)
            for m in _ORDER_MEASURES
        ]
    )
    return summed.where("returned_items + items_completed + items_generated > 0")


def item_orders(order_items: DataFrame, sku: DataFrame, start: date, end: date) -> DataFrame:
    """Orders, items and turnover generated, completed and returned per item group and day."""
    groups = sku.select(F.col("id").alias("sku_id"), F.col("sku_group_id").cast("bigint").alias("sku_group_id"))
    days = _item_days(order_items, start, end, until_midnight=False).join(groups, "sku_id")
    per_order = days.groupBy("date", "sku_group_id", "order_id").agg(*_amounts())
    return _roll_up(per_order, ["date", "sku_group_id"])


def query_item_orders(
    order_items: DataFrame, sku: DataFrame, attribution: DataFrame, start: date, end: date, tasks: int | None = None
) -> DataFrame:
    """As :func:`item_orders`, per search query the order items are attributed to.

    The join by item and the two aggregations after it are one stage, whose tasks hold
    their rows several times over; give the number of ``tasks`` that keeps these rows few
    (see ``operators/staging.tasks_for``). Otherwise the session's partitions decide.
    """
    groups = sku.select(F.col("id").alias("sku_id"), F.col("sku_group_id").cast("bigint").alias("sku_group_id"))
    days = _item_days(order_items, start, end, until_midnight=True).select(
        "order_item_id", "sku_id", "date", "role",
        "item_quantity", "returned_quantity", "gmv_generated", "gmv_completed", "gmv_returned",
    )
    credited = attribution.where(
        F.col("widget_space_name").isin(*SEARCH_SPACES) & (F.col("query") != "")
        & between_instants(
            F.col("generated_at"), day_start(start) - timedelta(days=LOOKBACK_DAYS), day_start(end)
        )
    ).select("order_item_id", "query", F.col("generated_at").alias("credited_at"))
    if tasks:
        days, credited = (side.repartition(tasks, "order_item_id") for side in (days, credited))
    per_item = (
        days.join(credited, "order_item_id")
        # The range of the attribution is open on both sides, unlike that of the orders.
        .where(
            (F.col("credited_at") > F.date_sub("date", LOOKBACK_DAYS).cast("timestamp_ntz"))
            & (F.col("credited_at") < F.date_add("date", 1).cast("timestamp_ntz"))
        )
        .drop("credited_at")
        # Same (item, query) twice counts once; the join has already placed rows by item.
        .distinct()
        .groupBy("order_item_id", "date", "query", "sku_id")
        .agg(*_amounts())
        .join(groups, "sku_id")
    )
    return _roll_up(per_item, ["date", "query", "sku_group_id"])


def ad_revenue_daily(ad_funnel: DataFrame, start: date, end: date) -> DataFrame:
    """Ad impressions, clicks and revenue; the source keeps numbers as text."""
    number = {c: F.col(c).try_cast("double") for c in ("impressions", "clicks", "adrev")}
    group = F.col("sku_group_id").try_cast("bigint")
    return (
        ad_funnel.where((F.col("date") >= day(start)) & (F.col("date") < day(end)) & (group > 0))
        .groupBy("date", group.alias("sku_group_id"))
        .agg(
            F.sum(number["impressions"]).cast("bigint").alias("ad_impressions"),
            F.sum(number["clicks"]).cast("bigint").alias("ad_clicks"),
            F.sum(number["adrev"]).alias("ad_revenue"),
        )
    )


def item_prices(sku_eod: DataFrame, sku: DataFrame, start: date, end: date) -> DataFrame:
    """Mean, median, least and greatest end-of-day prices per item group."""
    groups = sku.where("sku_group_id is not null").select(
        F.col("id").alias("sku_id"), F.col("sku_group_id").cast("bigint").alias("sku_group_id")
    )
    aggs = []
    for kind in ("sell", "full"):
        price = F.col(f"{kind}_price_eod")
        aggs += [
            F.try_divide(F.sum(price).cast("double"), F.count(price)).alias(f"avg_{kind}_price_eod"),
            lower_median(price.cast("double")).alias(f"median_{kind}_price_eod"),
            F.min(price).cast("double").alias(f"min_{kind}_price_eod"),
            F.max(price).cast("double").alias(f"max_{kind}_price_eod"),
        ]
    return (
        sku_eod.where((F.col("dt") >= day(start)) & (F.col("dt") < day(end)))
        .join(groups, "sku_id")
        .groupBy(F.col("dt").alias("date"), "sku_group_id")
        .agg(*aggs)
    )


def sku_stock_daily(sku_eod: DataFrame, start: date, end: date) -> DataFrame:
    """Active end-of-day stock per sku."""
    return (
        sku_eod.where((F.col("dt") >= day(start)) & (F.col("dt") < day(end)) & F.col("sku_id").isNotNull())
        .groupBy(F.col("dt").alias("date"), F.col("sku_id").cast("bigint").alias("sku_id"))
        .agg(F.sum("quantity_active_eod").cast("bigint").alias("total_stock"))
    )


def account_lifetime_facts(accounts: DataFrame, as_of: date, active_days: int = 200) -> DataFrame:
    """First-order and registration facts of accounts active lately.

    Only facts that no longer change are kept: current-state columns of the
    source would leak the future into past dates.
    """
    names = {
        "first_created_on": "first_order_date_ever",
        "first_order_id": "first_order_id_ever",
        "first_issued_on": "first_issued_order_date",
        "first_issued_payment_type": "first_issued_payment_type",
        "first_issued_installment_type": "first_issued_paymart_type",
        "registered_on": "registration_date",
        "first_session_on": "first_session_date",
        "first_city_id": "first_city_id",
        "first_delivery_point_type": "first_delivery_point_type",
        "source_type": "acquisition_source_type",
        "campaign_type": "acquisition_campaign_type",
        "accounts_per_install": "accounts_per_install_current",
    }
    return accounts.where(
        (F.col("account_id") > 0)
        & (F.col("first_created_on") > day(date(1970, 1, 1)))
        & (F.col("last_created_on") >= day(as_of - timedelta(days=active_days)))
    ).select(day(as_of).alias("date"), "account_id", *[F.col(a).alias(b) for a, b in names.items()])


def daily_discounts(discounts: DataFrame, start: date, end: date, prefix: str = PROMOTION_PREFIX) -> DataFrame:
    """The last discount of the day per sku and promotion."""
    day_of = F.to_date("created_at")
    used = discounts.where(
        between_instants(F.col("created_at"), day_start(start), day_start(end))
        & F.col("promotion_id").startswith(prefix)
    ).select(
        day_of.alias("date"),
        F.col("sku_id").cast("bigint").alias("sku_id"),
        "promotion_id",
        F.col("discount_amount").cast("double").alias("discount_amount"),
        F.col("calculated_for_price").cast("double").alias("calculated_for_price"),
        "created_at",
    )
    return first_row(used, ["date", "sku_id", "promotion_id"], latest_discount_order())


def latest_discount_order() -> list[Column]:
    return [F.col("created_at").desc(), F.col("discount_amount").desc(), F.col("calculated_for_price").desc()]


def _completion(df: DataFrame, keys: list[str], as_of: date) -> DataFrame:
    """Shares of orders completed and not picked up; df has one row per key and order with flags."""
    return (
        df.groupBy(*keys)
        .agg(*[F.sum(c).alias(c) for c in ("_total", "_completed", "_no_show")])
        .where("_total > 0")
        .select(
            day(as_of).alias("date"), *keys,
            ratio("_completed", "_total").alias("part_completed_orders"),
            ratio("_no_show", "_total").alias("part_no_show_from_total"),
        )
    )


def _resolved_items(history: DataFrame, as_of: date, lookback_days: int, key: str) -> DataFrame:
    return history.where(
        (F.col("analyze_date") == day(as_of))
        & (F.col("generated_at") > F.lit(as_of - timedelta(days=lookback_days)).cast("timestamp_ntz"))
        & not_in_keep_sql_nulls(F.col("return_cause"), FAIR_RETURN_CAUSES)
        & F.col(key).isNotNull()
    )


def _order_flags() -> list[Column]:
    status = F.col("real_order_item_status")
    return [
        F.max((status != "ACTIVE").cast("int")).alias("_total"),
        F.max((status == "COMPLETED").cast("int")).alias("_completed"),
        F.max((status == "RETURNED NO SHOW").cast("int")).alias("_no_show"),
    ]


def completion_by(history: DataFrame, key: str, as_of: date, lookback_days: int = 120) -> DataFrame:
    """Completed and no-show shares of distinct orders per city or region."""
    items = _resolved_items(history, as_of, lookback_days, key)
    per_order = items.groupBy(F.col(key).cast("bigint").alias(key), "order_id").agg(*_order_flags())
    return _completion(per_order, [key], as_of)


def completion_by_category(
    history: DataFrame, categories: DataFrame, as_of: date, lookback_days: int = 120
) -> DataFrame:
    """The same shares for the leaf category and each level above it."""
    leaves = _resolved_items(history, as_of, lookback_days, "category_id").groupBy(
        F.col("category_id").cast("bigint").alias("leaf"), "order_id"
    ).agg(*_order_flags())
    tree = categories.select(
        F.col("id").alias("leaf"), *[F.col(f"{lv}_category").cast("bigint").alias(lv) for lv in CATEGORY_LEVELS[1:]]
    )
    levels = F.array(
        *[F.struct(F.lit(lv).alias("category_level"), F.col(lv).alias("category_id")) for lv in CATEGORY_LEVELS]
    )
    per_order = (
        leaves.join(tree, "leaf", "left")
        .select("order_id", "_total", "_completed", "_no_show", F.explode(levels).alias("lv"))
        .select("order_id", "_total", "_completed", "_no_show", "lv.category_level", "lv.category_id")
        .where("category_id > 0")
        .groupBy("category_level", "category_id", "order_id")
        .agg(*[F.max(c).alias(c) for c in ("_total", "_completed", "_no_show")])
    )
    return _completion(per_order, ["category_level", "category_id"], as_of)


def delivery_unit_cost(
    costs: DataFrame, order_items: DataFrame, sku: DataFrame, as_of: date, lookback_days: int = 90
) -> DataFrame:
    """Logistics cost per delivered and per returned unit, per city and size group.

    Region and country values of the same size group stand in the same row as
    fallbacks for thin cities.
    """
    since = as_of - timedelta(days=lookback_days)
    inside = lambda c: between_instants(F.col(c), day_start(since), day_start(as_of))

    def amount(c: str) -> Column:
        return F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))

    latest_cost = first_row(
        costs.where(inside("order_created_at") & (F.col("account_id") != 0)),
        ["order_item_id"],
        [F.col("order_issued_at").desc(), F.col("forward_cost"), F.col("reverse_cost")],
    ).select("order_item_id", amount("forward_cost").alias("fwd"), amount("reverse_cost").alias("rev"))
    size = F.when(F.col("dimensional_group").isin(*SIZE_GROUPS), F.col("dimensional_group")).otherwise("SMALL")
    reached = F.col("delivered_at").isNotNull() | (
        (F.col("delivery_type") == "COURIER") & F.col("issued_at").isNotNull()
    )
    came_back = F.col("returned_at").isNotNull() & (
        F.col("delivered_at").isNotNull() | F.col("issued_at").isNotNull()
    )
    items = (
        order_items.where(inside("generated_at") & F.col("city_id").isNotNull())
        .join(sku.select(F.col("id").alias("sku_id"), "dimensional_group"), "sku_id", "left")
        .select(
            "order_item_id", "city_id", "region_id", size.alias("dimensional_group"),
            F.when(reached, F.col("item_quantity")).otherwise(0).alias("n_delivered"),
            F.when(came_back, F.col("item_quantity")).otherwise(0).alias("n_reverse"),
        )
    )
    by_city = items.join(latest_cost, "order_item_id").groupBy("city_id", "dimensional_group").agg(
        F.min("region_id").alias("region_id"),
        F.sum("fwd").alias("fwd"),
        F.sum("rev").alias("rev"),
        F.sum("n_delivered").cast("bigint").alias("n_items_delivered"),
        F.sum("n_reverse").cast("bigint").alias("n_items_reverse"),
    )
    # Already one row per city and size group, so these windows see a few rows per group.
    scopes = {
        "": None,
        "_region": Window.partitionBy("region_id", "dimensional_group"),
        "_country": Window.partitionBy("dimensional_group"),
    }

    def unit(cost: str, units: str, scope: Window | None) -> Column:
        if scope is None:
            return ratio(cost, units)
        return ratio(F.sum(cost).over(scope), F.sum(units).over(scope))

    return by_city.select(
        day(as_of).alias("date"), "city_id", "dimensional_group", "region_id",
        "n_items_delivered", "n_items_reverse",
        *[
            unit(cost, units, scope).alias(f"cpi_{name}{suffix}_uzs")
            for suffix, scope in scopes.items()
            for name, cost, units in (
                ("forward", "fwd", "n_items_delivered"), ("reverse", "rev", "n_items_reverse"),
            )
        ],
    )

