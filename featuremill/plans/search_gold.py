"""Model features from the search funnel and search orders.

The funnel and the orders are stacked and reduced once per key instead of being
aggregated apart and joined: all measures are additive, so the sums are the
same and one shuffle replaces several.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.functions.dates import Bound, day, trailing_sums
from featuremill.functions.ratios import beta_smoothed, parent_smoothed, ratio, ratio_or_zero
from featuremill.functions.text import canonical_query_key, has_text, normalise_query
from featuremill.operators.canonical import attach_group_key, fan_out, query_key_map
from featuremill.operators.rows import first_row, with_group_totals
from featuremill.operators.running_sums import RunningSums
from featuremill.operators.staging import Stage, no_stage
from featuremill.sources.scan import partition, trailing

WINDOWS = (1, 3, 7, 14, 21, 30, 60, 90)
SHORT_WINDOWS = (1, 3, 7, 14, 21, 30)
ITEM_SUMS = {"sum_impressions": "imp_{w}", "orders_generated": "ord_{w}", "sum_atc": "atc_{w}", "returned_orders": "ret_{w}"}
# The prior of the impression-to-order rate, and the pull of the parent rate.
PRIOR_ALPHA, PRIOR_BETA = 0.003384, 1.402240
PARENT_STRENGTH = 100.0
SEARCH = "SEARCH_RESULTS"


def _stack(
    funnel: DataFrame, orders: DataFrame, as_of: date, days: int, bound: Bound, keys: dict[str, tuple[Column, Column]]
) -> DataFrame:
    """Search-space funnel rows and order rows in one shape; ``keys``: name -> (funnel side, order side)."""
    zero = F.lit(0).cast("bigint")
    measures = ("sum_impressions", "sum_atc", "orders_generated", "returned_orders")
    shown = trailing(funnel.where(F.col("space") == SEARCH), as_of, days, bound).select(
        "date", *[c[0].alias(n) for n, c in keys.items()],
        F.lit(True).alias("in_funnel"), "sum_impressions", "sum_atc",
        zero.alias("orders_generated"), zero.alias("returned_orders"),
    )
    bought = trailing(orders, as_of, days, bound).select(
        "date", *[c[1].alias(n) for n, c in keys.items()],
        F.lit(False).alias("in_funnel"), zero.alias("sum_impressions"), zero.alias("sum_atc"),
        "orders_generated", "returned_orders",
    )
    return shown.unionByName(bought).select("date", *keys, "in_funnel", *measures)


def _item_windows(
    funnel: DataFrame, orders: DataFrame, as_of: date, windows: Sequence[int], extra: list[Column]
) -> DataFrame:
    item = F.col("sku_group_id").cast("bigint")
    rows = _stack(
        funnel.where("sku_group_id is not null"), orders.where("sku_group_id is not null"),
        as_of, max(windows), Bound.HALF_OPEN, {"sku_group_id": (item, item)},
    )
    sums = trailing_sums(ITEM_SUMS, windows, as_of, Bound.HALF_OPEN)
    return rows.groupBy("sku_group_id").agg(*sums, *extra)


def _smoothed_conversions() -> list[Column]:
    return [
        *[beta_smoothed(f"ord_{w}", f"imp_{w}", PRIOR_ALPHA, PRIOR_BETA).alias(f"smooth_conv_imp2order_{w}") for w in (3, 7, 14)],
        *[ratio_or_zero(f"ord_{w}", f"imp_{w}").alias(f"conv_imp2order_{w}") for w in (3, 7, 14)],
    ]


def _conversion_trends() -> list[Column]:
    rate = lambda w: ratio(f"ord_{w}", f"imp_{w}")
    return [ratio(rate(a), rate(b)).alias(f"imp2order_{a}_to_{b}") for a, b in ((3, 1), (21, 14), (30, 21))]


def search_conversion_v1(funnel: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Impression-to-order rates of search, plain, smoothed and as trends."""
    return _conversions(_item_windows(funnel, orders, as_of, SHORT_WINDOWS, []), as_of)


def item_search_daily(funnel: DataFrame, orders: DataFrame, start: date, end: date) -> DataFrame:
    """Search impressions, carts, orders and returns per item and day of [start, end)."""
    item = F.col("sku_group_id").cast("bigint")
    days = (end - start).days
    rows = _stack(funnel, orders, end, days, Bound.HALF_OPEN, {"sku_group_id": (item, item)}).where("sku_group_id is not null")
    return rows.groupBy("date", "sku_group_id").agg(*[F.sum(m).cast("bigint").alias(m) for m in ITEM_SUMS])


def search_totals(name: str, folder: str, buckets: int = 200) -> RunningSums:
    """Running totals of ``item_search_daily`` for ``search_conversion_v1_from_totals``."""
    return RunningSums(name, folder, {"sku_group_id": "bigint"}, dict.fromkeys(ITEM_SUMS, "bigint"), max(SHORT_WINDOWS), buckets)


def search_conversion_v1_from_totals(totals: RunningSums, spark: SparkSession, as_of: date) -> DataFrame:
    """As ``search_conversion_v1``, from the versions at the edges of the windows."""
    return _conversions(totals.windows(spark, as_of, SHORT_WINDOWS, Bound.HALF_OPEN, ITEM_SUMS), as_of)


def _conversions(windows: DataFrame, as_of: date) -> DataFrame:
    return windows.select(
        day(as_of).alias("date"), "sku_group_id", *_smoothed_conversions(), *_conversion_trends()
    )


def search_conversion_v2(
    funnel: DataFrame, orders: DataFrame, sku: DataFrame, as_of: date, stage: Stage = no_stage
) -> DataFrame:
    """As v1, with carts, returns, increments, category totals and shares, and recency.

    The item sums are used twice; pass a ``stage`` to compute them once.
    """
    last = lambda c, name: F.max(F.when(F.col(c) > 0, F.col("date"))).alias(name)
    items = _item_windows(
        funnel, orders, as_of, WINDOWS,
        [last("sum_impressions", "last_impression"), last("sum_atc", "last_atc")],
    )
    categories = (
        sku.where("sku_group_id is not null and category_id is not null")
        .groupBy(F.col("sku_group_id").cast("bigint").alias("sku_group_id"))
        .agg(F.max(F.col("category_id").cast("bigint")).alias("category_id"))
    )
    placed = stage(items.join(categories, "sku_group_id", "left"))
    # Category sums are sums of the items' sums: the daily rows are not read again.
    full = with_group_totals(
        placed, ["category_id"],
        {
            f"category_{out}_{w}": F.sum(f"{src}_{w}")
            for w in WINDOWS for src, out in (("ord", "orders"), ("atc", "atc"))
        },
    )
    age = lambda c: F.datediff(day(as_of), F.col(c)).cast("int")
    wide = WINDOWS[1:]
    return full.select(
        day(as_of).alias("date"), "sku_group_id", "category_id",
        *_smoothed_conversions(),
        age("last_impression").alias("skg_days_since_last_impression"),
        age("last_atc").alias("skg_days_since_last_atc"),
        *[ratio(f"ord_{w}", f"atc_{w}").alias(f"skg_conv_atc2order_{w}") for w in WINDOWS],
        *[ratio(f"ret_{w}", f"ord_{w}").alias(f"skg_return_rate_{w}") for w in WINDOWS],
        *[ratio("ord_1", f"ord_{w}").alias(f"skg_incr_rate_orders_1_to_{w}") for w in wide],
        *[ratio("atc_1", f"atc_{w}").alias(f"skg_incr_rate_atc_1_to_{w}") for w in wide],
        *[F.col(f"ord_{w}").alias(f"category_skg_orders_{w}") for w in WINDOWS],
        *[F.col(f"category_orders_{w}") for w in WINDOWS],
        *[F.col(f"atc_{w}").alias(f"category_skg_atc_{w}") for w in WINDOWS],
        *[F.col(f"category_atc_{w}") for w in WINDOWS],
        *[ratio(f"ord_{w}", f"category_orders_{w}").alias(f"category_skg_orders_frac_category_orders_{w}") for w in WINDOWS],
        *[ratio(f"atc_{w}", f"category_atc_{w}").alias(f"category_skg_atc_frac_category_atc_{w}") for w in WINDOWS],
        *_conversion_trends(),
    )


def _query_sums(funnel: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    rows = _stack(
        funnel, orders, as_of, max(WINDOWS), Bound.HALF_OPEN,
        {"query": (normalise_query(F.col("uniqs")), normalise_query(F.col("query")))},
    ).where(has_text(F.col("query")))
    return rows.groupBy("query").agg(
        F.max("in_funnel").alias("in_funnel"),
        *trailing_sums(
            {
                "sum_impressions": "query_uniq_impressions_{w}", "sum_atc": "query_uniq_atcs_{w}",
                "orders_generated": "query_orders_{w}",
            },
            WINDOWS, as_of, Bound.HALF_OPEN,
        ),
    )


def _query_columns() -> list[str]:
    return [f"query_{m}_{w}" for w in WINDOWS for m in ("uniq_impressions", "uniq_atcs", "orders")]


def query_features(funnel: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Impressions, carts and orders per normalised query seen in the funnel."""
    return _query_sums(funnel, orders, as_of).where("in_funnel").select(
        day(as_of).alias("date"), "query", *_query_columns()
    )


def query_features_canonical(
    funnel: DataFrame, orders: DataFrame, dictionary: DataFrame, as_of: date, version: str = "v1", stage: Stage = no_stage
) -> DataFrame:
    """The same sums per canonical group, repeated for every query of the group.

    The keyed query sums are used twice; pass a ``stage`` to compute them once.
    """
    keyed = stage(attach_group_key(_query_sums(funnel, orders, as_of), query_key_map(dictionary, version)))
    groups = keyed.groupBy("group_key").agg(*[F.sum(c).alias(c) for c in _query_columns()])
    members = keyed.where("in_funnel").select("group_key", "query", "has_query_id")
    return members.join(groups, "group_key").select(
        day(as_of).alias("date"), "query", F.col("group_key").alias("query_id"), "has_query_id", *_query_columns()
    )


def _pair_sums(funnel: DataFrame, orders: DataFrame, as_of: date, smooth: bool) -> DataFrame:
    """Closed-window sums (and half-open ones for smoothing) per query and item; blank queries kept apart."""
    item = F.col("sku_group_id").cast("bigint")
    rows = _stack(
        funnel,
        # Orders without a query take part nowhere; blank funnel queries count in item totals.
        orders.where(has_text(normalise_query(F.col("query")))),
        as_of, max(WINDOWS), Bound.CLOSED,
        {
            "query": (normalise_query(F.col("uniqs")), normalise_query(F.col("query"))),
            "sku_group_id": (item, item),
        },
    ).where("sku_group_id is not null")
    sums = trailing_sums(
        {"sum_atc": "atc_{w}", "sum_impressions": "imp_{w}", "orders_generated": "ord_{w}"},
        WINDOWS, as_of, Bound.CLOSED,
    )
    if smooth:
        sums += trailing_sums(
            {"sum_atc": "s_atc_{w}", "sum_impressions": "s_imp_{w}", "orders_generated": "s_ord_{w}"},
            WINDOWS, as_of, Bound.HALF_OPEN,
        )
    return rows.groupBy("query", "sku_group_id").agg(F.max("in_funnel").alias("in_funnel"), *sums)


def _dense_enough() -> Column:
    return (F.col("imp_14") >= 2) & ((F.col("atc_90") > 0) | (F.col("ord_90") > 0))


def _pair_ratios() -> dict[str, Column]:
    """Conversions and window-to-window ratios of a pair, by output name."""
    p = "query_skg_"
    cart = lambda w: ratio(f"atc_{w}", f"imp_{w}")
    order = lambda w: ratio(f"ord_{w}", f"imp_{w}")
    out: dict[str, Column] = {}
    for w in (7, 14, 21, 30, 60, 90):
        if w >= 60:
            out[f"{p}uniq_atcs_{w}"] = F.col(f"atc_{w}")
        out[f"{p}uniq_orders_{w}"] = F.col(f"ord_{w}")
        out[f"{p}conv_imp2atc_{w}"] = cart(w)
        out[f"{p}conv_imp2order_{w}"] = order(w)
    for a, b in ((3, 1), (7, 3), (14, 7), (30, 14), (60, 30), (90, 60)):
        out[f"{p}imp2atc_{a}_to_{b}"] = ratio(cart(a), cart(b))
    for a, b in ((30, 14), (60, 30), (90, 60)):
        out[f"{p}imp2order_{a}_to_{b}"] = ratio(order(a), order(b))
    return out


def _smoothed_pair_ratios() -> dict[str, Column]:
    p = "query_skg_"
    out: dict[str, Column] = {}
    for w in WINDOWS:
        for name, m, plural in (("atc", "atc", "atc"), ("order", "ord", "orders")):
            own, parent = f"s_{m}_{w}", f"t_{m}_{w}"
            out[f"{p}smooth_conv_imp2{name}_{w}"] = parent_smoothed(
                own, f"s_imp_{w}", ratio(parent, f"t_imp_{w}"), PARENT_STRENGTH
            )
            out[f"{p}{plural}_frac_all_skg_{plural}_{w}"] = ratio(own, parent)
    return out


def pair_features_v1(funnel: DataFrame, orders: DataFrame, as_of: date) -> DataFrame:
    """Conversions of query-item pairs that have at least two impressions and some outcome."""
    pairs = _pair_sums(funnel, orders, as_of, smooth=False).where("in_funnel").where(
        has_text(F.col("query")) & _dense_enough()
    )
    return pairs.select(
        day(as_of).alias("date"), "query", "sku_group_id", *[c.alias(n) for n, c in _pair_ratios().items()]
    )


def _item_totals(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("sku_group_id").agg(
        *[F.sum(f"s_{m}_{w}").alias(f"t_{m}_{w}") for m in ("atc", "imp", "ord") for w in WINDOWS]
    )


def pair_features_v2(funnel: DataFrame, orders: DataFrame, as_of: date, stage: Stage = no_stage) -> DataFrame:
    """As v1, with rates pulled to the item's own rate and shares of the item's totals.

    The pair sums are used twice; pass a ``stage`` to compute them once.
    """
    sums = stage(_pair_sums(funnel, orders, as_of, smooth=True))
    # Totals come from the pair sums, and sparse pairs go before the join.
    pairs = sums.where("in_funnel").where(has_text(F.col("query")) & _dense_enough())
    features = {**_pair_ratios(), **_smoothed_pair_ratios()}
    return pairs.join(_item_totals(sums), "sku_group_id", "left").select(
        day(as_of).alias("date"), "query", "sku_group_id", *[c.alias(n) for n, c in features.items()]
    )


def pair_features_canonical(
    funnel: DataFrame, orders: DataFrame, dictionary: DataFrame, as_of: date, version: str = "v1", salts: int | None = None,
    stage: Stage = no_stage,
) -> DataFrame:
    """As v2 with queries merged by canonical group; every query of a group gets the group's rows.

    Item totals stay per item. Growth by the fan-out is inherent, so rows of a
    group may be dealt over ``salts`` tasks; by default adaptive execution splits
    them. The pair sums are used three times;
    pass a ``stage`` to compute them once.
    """
    sums = stage(_pair_sums(funnel, orders, as_of, smooth=True))
    keyed = attach_group_key(sums.where(has_text(F.col("query"))), query_key_map(dictionary, version))
    measures = [c for c in sums.columns if c[-1].isdigit()]
    groups = (
        keyed.groupBy("group_key", "sku_group_id")
        .agg(F.max("in_funnel").alias("in_funnel"), *[F.sum(c).alias(c) for c in measures])
        .where("in_funnel").where(_dense_enough())
    )
    members = keyed.where("in_funnel").select("group_key", "query", "has_query_id").distinct()
    features = {**_pair_ratios(), **_smoothed_pair_ratios()}
    rows = groups.join(_item_totals(sums), "sku_group_id", "left").select(
        "group_key", "sku_group_id", *[c.alias(n) for n, c in features.items()]
    )
    return fan_out(members, rows, "group_key", spread_by=["sku_group_id"], salts=salts).select(
        day(as_of).alias("date"), "query", "sku_group_id", F.col("group_key").alias("query_id"), "has_query_id", *features
    )


def pair_conversions_legacy(daily: DataFrame, as_of: date) -> DataFrame:
    """Session-based conversions of pairs: 4 counts, 3 rates, and rates of neighbouring windows."""
    p = "query_skg_"
    metrics = ("impressions", "clicks", "atcs", "orders")
    rates = {"imp2click": "clicks", "imp2atc": "atcs", "imp2order": "orders"}
    sums = (
        trailing(daily, as_of, max(WINDOWS), Bound.CLOSED)
        .groupBy("query", F.col("sku_group_id").cast("bigint").alias("sku_group_id"))
        .agg(*trailing_sums({f"uniq_{m}": f"{p}uniq_{m}_{{w}}" for m in metrics}, WINDOWS, as_of, Bound.CLOSED))
        .where(F.col(f"{p}uniq_impressions_14") >= 2)
    )
    rate = lambda r, w: ratio(f"{p}uniq_{rates[r]}_{w}", f"{p}uniq_impressions_{w}")
    columns: list[Column] = []
    for w in WINDOWS:
        columns += [F.col(f"{p}uniq_{m}_{w}") for m in metrics]
        columns += [rate(r, w).alias(f"{p}conv_{r}_{w}") for r in rates]
    for a, b in ((3, 1), (7, 3), (14, 7), (30, 14), (60, 30), (90, 60)):
        columns += [ratio(rate(r, a), rate(r, b)).alias(f"{p}{r}_{a}_to_{b}") for r in rates]
    return sums.select(day(as_of).alias("date"), "query", "sku_group_id", *columns)


def pair_latest_legacy(aggregated: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """The latest row of each pair in the last days, dated ``as_of``."""
    latest = first_row(
        trailing(aggregated, as_of, days, Bound.CLOSED), ["query", "sku_group_id"], [F.col("date").desc()]
    )
    return latest.withColumn("date", day(as_of))


def query_text_pair_features(
    funnel: DataFrame, as_of: date, legacy: bool = False, stage: Stage = no_stage
) -> DataFrame:
    """Cart conversion of pairs by query text, and the pair's share of the query's carts.

    ``legacy`` divides the 90-day carts by the 60-day impressions, as older
    tables did.
    """
    sums = (
        trailing(funnel.where(F.col("space") == SEARCH), as_of, max(WINDOWS), Bound.UP_TO)
        .groupBy(F.col("sku_group_id").cast("bigint").alias("sku_group_id"), F.lower(F.trim("uniqs")).alias("query_text"))
        .agg(*trailing_sums({"sum_atc": "atc_{w}", "sum_impressions": "imp_{w}"}, WINDOWS, as_of, Bound.UP_TO))
    )
    shared = with_group_totals(stage(sums), ["query_text"], {f"all_atc_{w}": F.sum(f"atc_{w}") for w in WINDOWS})
    den = {w: (60 if legacy and w == 90 else w) for w in WINDOWS}
    return shared.select(
        day(as_of).alias("date"), "sku_group_id", "query_text",
        *[ratio_or_zero(f"atc_{w}", f"imp_{den[w]}").alias(f"query_skg_conv_imp2atc_{w}") for w in WINDOWS],
        *[ratio_or_zero(f"atc_{w}", f"all_atc_{w}").alias(f"share_of_atc_{w}") for w in WINDOWS],
    )


def query_dictionary(
    funnel: DataFrame, known: DataFrame, on: date, stop_words: Sequence[str], updated_at: datetime, version: str = "v1"
) -> DataFrame:
    """Rows to append: search queries of the day without a canonical id in this version.

    Tokens are white-space words; there is no stemming and there are no synonyms.
    Queries of which nothing is left get no row.
    """
    new = (
        partition(funnel, on)
        .where((F.col("space") == SEARCH) & F.col("uniqs").isNotNull())
        .select(F.col("uniqs").alias("query_text"))
        .distinct()
        .join(known.where(F.col("version") == version).select("query_text"), "query_text", "left_anti")
    )
    return new.select(
        F.lit(updated_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("updated_at"),
        "query_text",
        canonical_query_key(F.col("query_text"), stop_words).alias("query_id"),
        F.lit(version).alias("version"),
    ).where("query_id is not null")
