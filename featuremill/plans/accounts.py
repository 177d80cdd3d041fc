"""Buy-out history of accounts as of the end of a business day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.functions.dates import (
    BUSINESS_TZ, between_instants, business_date, day, ts, utc_midnight,
)
from featuremill.functions.ratios import ratio, ratio_if_positive, stable_mean
from featuremill.operators.outcomes import current_streak, upper_median
from featuremill.operators.rows import first_n
from featuremill.operators.staging import Stage, no_stage
from featuremill.plans.item_gold import serving_projection
from featuremill.plans.item_silver import FAIR_RETURN_CAUSES
from featuremill.plans.search_silver import UNPLACED
from featuremill.sources.scan import partition

# Fixed values of the outcome rules.
NO_SHOW_DAYS = 6
HANDOVER_MINUTES = 60
POSTPAID = ("PostPaid", "Postpaid")
INSTALMENT = ("Nasiya", "Paymart", "PaymartMfo", "PaymartMFO")
CREATION_DAYS = 365
CREATION_SLACK_DAYS = 7
CENSOR_SLACK_DAYS = 7
TRUE_HISTORY_DAYS = 182


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def item_outcomes(history: DataFrame, as_of: date) -> DataFrame:
    """Order items of the snapshot with outcome flags (booleans, never NULL)."""
    delivered_at, issued_at, returned_at = F.col("delivered_at"), F.col("issued_at"), F.col("returned_at")
    st, cause = F.col("real_order_item_status"), F.nullif(F.col("return_cause"), F.lit(""))
    came_back = returned_at.isNotNull()
    never_issued = issued_at.isNull() & came_back & delivered_at.isNotNull()
    days_waiting = F.timestamp_diff("DAY", delivered_at, returned_at)
    minutes_kept = F.timestamp_diff("MINUTE", issued_at, returned_at)
    known_cause = F.coalesce(cause, F.lit("NONE"))
    own_fault = ~known_cause.isin("CANCELED", "MISSING")
    no_show = never_issued & (days_waiting >= NO_SHOW_DAYS) & (cause == "CANCELED")
    late_cancel = never_issued & (days_waiting < NO_SHOW_DAYS) & (cause == "CANCELED")
    flags = {
        "is_delivered": delivered_at.isNotNull() | ((F.col("delivery_type") == "COURIER") & issued_at.isNotNull()),
        "is_active": st == "ACTIVE",
        "is_completed": st == "COMPLETED",
        "is_cancelled_before": st == "RETURNED BEFORE DELIVERY",
        "is_fair_return": cause.isin(*FAIR_RETURN_CAUSES) & came_back,
        "is_no_show": no_show,
        "is_late_cancel": late_cancel,
        "is_handover_return": (
            issued_at.isNotNull() & came_back & minutes_kept.between(0, HANDOVER_MINUTES) & own_fault
        ) | (never_issued & (known_cause != "CANCELED")),
        "is_later_return": issued_at.isNotNull() & came_back & (minutes_kept > HANDOVER_MINUTES) & own_fault,
        "is_refused": (st == "RETURNED NO SHOW") | ((st == "RETURNED") & (cause == "CANCELED")),
    }
    snapshot = history.where((F.col("analyze_date") == day(as_of)) & (F.col("account_id") > 0))
    return snapshot.withColumns({**{n: _yes(c) for n, c in flags.items()}, "cause": cause})


def order_outcomes(items: DataFrame, as_of: date, tz: str = BUSINESS_TZ) -> DataFrame:
    """One row per order: counts, money and the latest refusal in it."""
    n = lambda flag: F.count_if(F.col(flag))
    money = lambda flag, col: F.coalesce(F.sum(F.when(F.col(flag), F.col(col))), F.lit(0)).cast("double")
    first_item = lambda c: F.min_by(c, "order_item_id").alias(c)
    kind = (
        F.when(F.col("is_no_show"), "no_show")
        .when(F.col("is_late_cancel"), "cancel_after_delivery")
        .otherwise("courier_or_other")
    )
    when_returned = F.struct(
        F.coalesce("returned_at", ts_epoch()).alias("at"), F.col("order_item_id").alias("id")
    )
    orders = items.groupBy("account_id", "order_id").agg(
        F.min("generated_at").alias("order_ts"),
        *[first_item(c) for c in ("payment_type", "order_city_id", "order_region_id", "delivery_point_id")],
        F.count(F.lit(1)).alias("n_items"),
        n("is_active").alias("n_active"),
        n("is_delivered").alias("n_delivered"),
        n("is_completed").alias("n_completed"),
        n("is_cancelled_before").alias("n_cancelled_before"),
        n("is_refused").alias("n_refused"),
        n("is_no_show").alias("n_no_show"),
        n("is_late_cancel").alias("n_late_cancel"),
        n("is_handover_return").alias("n_handover_return"),
        n("is_later_return").alias("n_later_return"),
        n("is_fair_return").alias("n_fair_return"),
        F.sum("gmv_generated").cast("double").alias("gmv_generated"),
        F.sum("gmv_completed").cast("double").alias("gmv_completed"),
        money("is_delivered", "gmv_generated").alias("gmv_delivered"),
        money("is_fair_return", "gmv_generated").alias("gmv_fair_return"),
        money("is_no_show", "gmv_generated").alias("gmv_no_show"),
        F.min(F.when(F.col("is_refused"), F.col("returned_at"))).alias("refused_at"),
        # Value of the row returned last, NULL when that row is not a refusal.
        F.max_by(
            F.when(F.col("is_refused"), F.struct(kind.alias("kind"), F.col("cause"))), when_returned
        ).alias("last_refusal"),
    )
    base = F.col("gmv_delivered") - F.col("gmv_fair_return")
    dated = orders.withColumn("order_date", business_date(F.col("order_ts"), tz))
    return dated.withColumns({
        "is_resolved": (F.col("n_active") == 0) & (F.col("n_delivered") > 0),
        "is_delivered_order": F.col("n_delivered") > 0,
        "is_bad": (F.col("n_refused") > 0).cast("int"),
        "is_postpaid": _yes(F.col("payment_type").isin(*POSTPAID)),
        "is_instalment": _yes(F.col("payment_type").isin(*INSTALMENT)),
        "order_rate": ratio_if_positive("gmv_completed", base),
        "paid_base": base,
        "days_ago": F.datediff(day(as_of), F.col("order_date")),
    })


def ts_epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def account_asof_history(
    history: DataFrame, as_of: date, tz: str = BUSINESS_TZ, stage: Stage = no_stage
) -> DataFrame:
    """Buy-out features of every account of the snapshot.

    The orders are used five times; pass a ``stage`` to compute them once.
    """
    return _asof_features(stage(order_outcomes(item_outcomes(history, as_of), as_of, tz)), as_of, tz)


def _asof_features(orders: DataFrame, as_of: date, tz: str) -> DataFrame:
    def total(c: str, cond: Column | None = None) -> Column:
        value = F.col(c) if cond is None else F.when(cond, F.col(c))
        return F.coalesce(F.sum(value), F.lit(0))

    when = F.struct(F.col("order_ts").alias("at"), F.col("order_id").alias("id"))
    refused = F.struct(F.coalesce("refused_at", ts_epoch()).alias("at"), F.col("order_id").alias("id"))
    spans = {"win": F.lit(True), "90d": F.col("days_ago") <= 90, "30d": F.col("days_ago") <= 30}
    prepaid = ~F.col("is_postpaid") & ~F.col("is_instalment")
    ticket = F.col("gmv_generated")
    # Placed before the aggregation: accounts have few orders, so partial results with their sets and
    # quantile sketches would be as many as the orders and wider.
    agg = orders.repartition("account_id").groupBy("account_id").agg(
        F.count(F.lit(1)).alias("n_orders_win"),
        F.count_if("is_delivered_order").alias("n_delivered_orders_win"),
        F.count_if("is_resolved").alias("n_resolved_orders_win"),
        F.count_if(spans["30d"]).alias("n_orders_30d"),
        F.count_if(spans["90d"]).alias("n_orders_90d"),
        F.count_if(F.col("n_active") > 0).alias("n_orders_in_processing"),
        *[
            total(f"gmv_{m}", cond).alias(f"gmv_{m}_{span}")
            for span, cond in spans.items() for m in ("completed", "delivered", "fair_return")
        ],
        F.sum("n_completed").alias("n_items_completed_win"),
        F.sum("n_delivered").alias("n_items_delivered_win"),
        F.sum("n_no_show").alias("n_items_no_show"),
        F.sum("n_late_cancel").alias("n_items_cancel_after_delivery"),
        F.sum("n_handover_return").alias("n_items_return_at_handover"),
        F.sum("n_later_return").alias("n_items_return_post_handover"),
        F.sum("n_fair_return").alias("n_items_fair_return"),
        F.sum("n_cancelled_before").alias("n_items_cancel_before_delivery"),
        F.count_if(F.col("n_cancelled_before") == F.col("n_items")).alias("n_orders_cancelled_before_delivery"),
        total("gmv_no_show").alias("gmv_no_show_win"),
        F.sum("is_bad").alias("n_nonbuyout_events"),
        F.min("refused_at").alias("first_refused_at"),
        F.max("refused_at").alias("last_refused_at"),
        F.max_by("last_refusal", refused).alias("last_refusal"),
        F.count_if("is_postpaid").alias("n_postpaid"),
        F.count_if("is_instalment").alias("n_instalment"),
        total("gmv_completed", F.col("is_postpaid")).alias("postpaid_completed"),
        total("paid_base", F.col("is_postpaid")).alias("postpaid_base"),
        total("gmv_completed", prepaid).alias("prepaid_completed"),
        total("paid_base", prepaid).alias("prepaid_base"),
        F.min_by(F.col("is_postpaid").cast("int"), when).alias("first_order_in_win_is_postpaid"),
        F.max_by(
            F.struct("payment_type", "is_postpaid", "order_city_id", "order_region_id"), when
        ).alias("last_order"),
        stable_mean(ticket).alias("avg_ticket_win"),
        upper_median(ticket).alias("median_ticket_win"),
        F.stddev_pop(ticket).alias("std_ticket_win"),
        F.max(ticket).alias("max_ticket_win"),
        ratio(F.sum("n_items"), F.count("n_items")).alias("avg_items_per_order_win"),
        # Sets of points and cities are bounded by those tables; two distinct counts would
        # repeat every order row three times.
        F.size(F.collect_set("delivery_point_id")).alias("n_distinct_dp_win"),
        F.size(F.collect_set("order_city_id")).alias("n_distinct_city_win"),
        F.min("order_date").alias("first_order_date_win"),
        F.max("order_date").alias("last_order_date_win"),
    )

    resolved = orders.where("is_resolved").select("account_id", "order_ts", "order_id", "is_bad", "order_rate")
    newest = first_n(resolved, ["account_id"], [F.col("order_ts").desc(), F.col("order_id").desc()], 10, "seq")
    seq = F.col("seq")
    recent = newest.groupBy("account_id").agg(
        *[F.avg(F.when(seq <= k, F.col("order_rate"))).alias(f"buyout_rate_last_{k}") for k in (3, 5, 10)],
        *[F.max(F.when(seq == k, F.col("is_bad"))).alias(f"bad_{k}") for k in (1, 2, 3)],
        *[F.count_if((seq <= k) & (F.col("is_bad") == 1)).alias(f"n_bad_last_{k}") for k in (3, 5, 10)],
    )
    oldest = first_n(resolved, ["account_id"], [F.col("order_ts"), F.col("order_id")], 3, "seq")
    early = oldest.groupBy("account_id").agg(F.avg("order_rate").alias("buyout_rate_first_3"))
    streak = current_streak(resolved, ["account_id"], ["order_ts", "order_id"], "is_bad")
    full = agg.join(recent, "account_id", "left").join(early, "account_id", "left").join(streak, "account_id", "left")

    money_rate = lambda span: ratio_if_positive(
        f"gmv_completed_{span}", F.col(f"gmv_delivered_{span}") - F.col(f"gmv_fair_return_{span}")
    )
    age = lambda c: F.datediff(day(as_of), c).cast("int")
    nonbuyout = (
        F.col("n_items_no_show") + F.col("n_items_cancel_after_delivery")
        + F.col("n_items_return_at_handover") + F.col("n_items_return_post_handover")
    )
    # Six calendar months back from the day after: an account whose first order lies at
    # the left edge of the snapshot has an older history that is cut off.
    edge = F.date_add(F.add_months(day(as_of + timedelta(days=1)), -6), CENSOR_SLACK_DAYS)
    streak_of = lambda v: F.when(F.col("last_outcome") == v, F.col("streak_len")).otherwise(0).cast("bigint")
    big = lambda *names: [F.col(c).cast("bigint").alias(c) for c in names]
    return full.select(
        F.col("account_id").cast("bigint").alias("account_id"),
        *big("n_orders_win", "n_delivered_orders_win", "n_resolved_orders_win", "n_orders_30d", "n_orders_90d",
             "n_orders_in_processing"),
        *[money_rate(span).alias(f"buyout_rate_money_{span}") for span in spans],
        ratio_if_positive("n_items_completed_win", "n_items_delivered_win").alias("buyout_rate_items_win"),
        (F.lit(1.0) - ratio_if_positive("n_nonbuyout_events", "n_delivered_orders_win")).alias("buyout_rate_orders_win"),
        "buyout_rate_last_3", "buyout_rate_last_5", "buyout_rate_last_10", "buyout_rate_first_3",
        # With fewer than four resolved orders both ends are the same orders: no trend, not a zero one.
        F.when(F.col("n_resolved_orders_win") >= 4, F.col("buyout_rate_last_3") - F.col("buyout_rate_first_3")).alias("buyout_trend"),
        *[
            F.coalesce(f"bad_{k}", F.lit(0)).cast("int").alias(f"prev{'' if k == 1 else k}_order_is_nonbuyout")
            for k in (1, 2, 3)
        ],
        *big("n_bad_last_3", "n_bad_last_5", "n_bad_last_10"),
        streak_of(0).alias("buyout_streak"),
        streak_of(1).alias("nonbuyout_streak"),
        *big("n_items_no_show", "n_items_cancel_after_delivery", "n_items_return_at_handover",
             "n_items_return_post_handover", "n_items_fair_return", "n_items_cancel_before_delivery",
             "n_orders_cancelled_before_delivery"),
        ratio_if_positive("n_items_no_show", "n_items_delivered_win").alias("no_show_share_of_delivered"),
        ratio_if_positive(F.col("n_items_no_show"), nonbuyout).alias("no_show_share_of_nonbuyout"),
        ratio_if_positive("n_orders_cancelled_before_delivery", "n_orders_win").alias("cancel_before_delivery_share"),
        ratio_if_positive("gmv_no_show_win", "gmv_delivered_win").alias("no_show_gmv_share"),
        *big("n_nonbuyout_events"),
        (F.col("n_nonbuyout_events") > 0).cast("int").alias("is_after_first_non_buyout"),
        age(business_date(F.col("first_refused_at"), tz)).alias("days_since_first_nonbuyout"),
        age(business_date(F.col("last_refused_at"), tz)).alias("days_since_last_nonbuyout"),
        F.col("last_refusal.kind").alias("last_nonbuyout_type"),
        F.col("last_refusal.cause").alias("last_nonbuyout_cause"),
        ratio_if_positive("n_postpaid", "n_orders_win").alias("postpaid_share_win"),
        ratio_if_positive("n_instalment", "n_orders_win").alias("installment_share_win"),
        ratio_if_positive("postpaid_completed", "postpaid_base").alias("buyout_rate_postpaid"),
        ratio_if_positive("prepaid_completed", "prepaid_base").alias("buyout_rate_prepaid"),
        "first_order_in_win_is_postpaid",
        F.col("last_order.payment_type").alias("last_order_payment_type"),
        F.col("last_order.is_postpaid").cast("int").alias("last_order_is_postpaid"),
        "avg_ticket_win", "median_ticket_win", "std_ticket_win", "max_ticket_win", "avg_items_per_order_win",
        *big("n_distinct_dp_win", "n_distinct_city_win"),
        F.col("last_order.order_city_id").cast("bigint").alias("last_order_city_id"),
        F.col("last_order.order_region_id").cast("bigint").alias("last_order_region_id"),
        "first_order_date_win", "last_order_date_win",
        age(F.col("last_order_date_win")).alias("days_since_last_order_win"),
        age(F.col("first_order_date_win")).alias("tenure_days_win"),
        (F.col("first_order_date_win") <= edge).cast("int").alias("history_left_censored"),
    )


def _created_orders(order_items: DataFrame, as_of: date, tz: str) -> DataFrame:
    """Creation instants of the orders that were created before the end of the business day."""
    end = utc_midnight(as_of + timedelta(days=1), tz)
    scan_from = utc_midnight(as_of - timedelta(days=CREATION_DAYS + CREATION_SLACK_DAYS), tz)
    # Payment may come later than creation, hence the slack on both sides.
    scan_to = utc_midnight(as_of + timedelta(days=3), tz)
    return (
        order_items.where(
            between_instants(F.col("purchased_at"), scan_from, scan_to)
            & (F.col("account_id") > 0)
            & ~F.col("order_item_status").isin(*UNPLACED)
        )
        .groupBy("account_id", "order_id")
        .agg(F.min("generated_at").alias("created"))
        .where(F.col("created") < ts(end))
    )


def _creation_counts(orders: DataFrame, as_of: date, tz: str) -> DataFrame:
    age = F.timestamp_diff("SECOND", F.col("created"), ts(utc_midnight(as_of + timedelta(days=1), tz)))
    return orders.groupBy("account_id").agg(
        *[F.count_if(age <= d * 86400).alias(f"orders_created_prev_{d}d") for d in (1, 7, 30, 90, CREATION_DAYS)]
    )


def orders_created(order_items: DataFrame, as_of: date, tz: str = BUSINESS_TZ) -> DataFrame:
    """Orders created in the last 1..365 times 24 hours before the end of the business day."""
    return _creation_counts(_created_orders(order_items, as_of, tz), as_of, tz)


def account_buyout_history(
    history: DataFrame, order_items: DataFrame, lifetime_facts: DataFrame, as_of: date, tz: str = BUSINESS_TZ,
    stage: Stage = no_stage,
) -> DataFrame:
    """As-of history, creation counters and lifetime facts of each account of the snapshot.

    Outcomes and creation instants of the orders go into one frame: computed in
    one plan, they share the shuffle where snapshot and order items are made
    from the same rows.
    """
    facts = partition(lifetime_facts, as_of).drop("date")
    first_ever = F.col("first_order_date_ever")
    age = lambda c: F.datediff(day(as_of), c).cast("int")
    outcomes = order_outcomes(item_outcomes(history, as_of), as_of, tz)
    # Only orders of the second kind have a creation instant. Their id is not needed; without it, the union
    # keeps the tasks of the two apart.
    created = _created_orders(order_items, as_of, tz).select("account_id", "created")
    both = stage(outcomes.unionByName(created, allowMissingColumns=True))
    return (
        _asof_features(both.where("created is null").drop("created"), as_of, tz)
        .join(_creation_counts(both.where("created is not null"), as_of, tz), "account_id", "left")
        .join(facts, "account_id", "left")
        .select(
            day(as_of).alias("date"), "*",
            age(first_ever).alias("tenure_days_true"),
            age(F.col("registration_date")).alias("days_since_registration"),
            (first_ever < day(as_of - timedelta(days=TRUE_HISTORY_DAYS))).cast("int").alias("history_left_censored_true"),
        )
    )


def account_history_online(history_table: DataFrame, as_of: date, columns: list[str]) -> DataFrame:
    """Serving projection; one distributed write takes the place of hand-made shards."""
    return serving_projection(history_table, as_of, columns)
