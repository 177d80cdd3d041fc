"""Builders on small hand-made tables: the edges of each rule."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from featuremill.operators.staging import tasks_for, write_stage
from featuremill.plans import accounts, geo, ranking
from featuremill.plans import item_gold as gold
from featuremill.plans import item_silver as items
from featuremill.plans import search_gold as search
from featuremill.plans import search_silver as silver

D = date(2024, 1, 31)


def at(day, hour=0, minute=0):
    return datetime(2024, 1, day, hour, minute)


ITEM_DDL = (
    "order_item_id bigint, order_id bigint, sku_id bigint, generated_at timestamp_ntz, issued_at timestamp_ntz, returned_at timestamp_ntz,"
    " order_item_status string, item_quantity bigint, returned_quantity bigint, gmv_generated decimal(18,2), gmv_completed decimal(18,2), gmv_returned decimal(18,2)"
)


def order_items(spark, rows):
    full = [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[8], 10, 10, 10) for r in rows]
    from decimal import Decimal

    return spark.createDataFrame([(*r[:9], *[Decimal(x) for x in r[9:]]) for r in full], ITEM_DDL)


SKU_DDL = "id bigint, sku_group_id bigint, product_id bigint, category_id bigint, sell_price double"


@pytest.fixture
def sku(spark):
    return spark.createDataFrame([(1, 10, 100, 5, 50.0), (2, 10, 101, 5, 70.0), (3, 11, 102, 6, 0.0)], SKU_DDL)


def test_item_orders_edges(spark, sku):
    df = order_items(spark, [
        (1, 1, 1, at(10), at(12), None, "COMPLETED", 2, 0),           # generated 10th, completed 12th
        (2, 1, 2, at(10), at(12), at(12, 9), "COMPLETED", 1, 1),       # returned on the issue day: not completed
        (3, 2, 1, at(10), at(12), at(13), "COMPLETED", 4, 4),          # returned the day after: both
        (4, 3, 1, datetime(2023, 12, 20), at(12), None, "COMPLETED", 8, 0),  # generated 23 days before: only generated
        (5, 4, 1, at(10), None, None, "CREATED", 100, 0),              # never placed
        (6, 5, 3, at(10), None, None, "ACTIVE", 0, 0),                 # no quantity: no row
        (7, 6, 99, at(10), None, None, "ACTIVE", 1, 0),                # unknown sku
    ])
    got = {(r.date.day, r.sku_group_id): r for r in items.item_orders(df, sku, date(2024, 1, 1), date(2024, 2, 1)).collect()}
    assert set(got) == {(10, 10), (12, 10), (13, 10)}
    assert (got[10, 10].orders_generated, got[10, 10].items_generated) == (2, 7)
    r = got[12, 10]
    assert (r.items_completed, r.completed_orders, r.returned_items, r.returned_orders, r.gmv_completed) == (6, 2, 1, 1, 20.0)
    assert (got[13, 10].returned_items, got[13, 10].items_completed) == (4, 0)


def test_range_equals_single_days(spark, sku):
    df = order_items(spark, [
        (i, i // 2, i % 3 + 1, at(1 + i % 9), at(3 + i % 11), at(4 + i % 13) if i % 4 == 0 else None, "COMPLETED", i % 5, i % 3)
        for i in range(60)
    ])
    whole = items.item_orders(df, sku, date(2024, 1, 1), date(2024, 1, 20))
    days = [items.item_orders(df, sku, date(2024, 1, d), date(2024, 1, d + 1)) for d in range(1, 20)]
    single = days[0]
    for d in days[1:]:
        single = single.unionByName(d)
    assert sorted(map(str, whole.collect())) == sorted(map(str, single.collect()))


def test_query_orders_bounds(spark, sku):
    """Attribution is open at the far end, orders are closed there."""
    day, edge = 25, at(5)  # edge: exactly 20 days before
    df = order_items(spark, [(1, 1, 1, edge, at(day), None, "COMPLETED", 3, 0), (2, 2, 1, edge + timedelta(seconds=1), at(day), None, "COMPLETED", 5, 0)])
    attr = df.select("order_item_id", "generated_at", F.lit("shoes").alias("query"), F.lit("SEARCH").alias("widget_space_name"))
    twice = attr.unionByName(attr)
    got = items.query_item_orders(df, sku, twice, date(2024, 1, day), date(2024, 1, day + 1)).collect()
    assert [(r.query, r.sku_group_id, r.items_completed, r.completed_orders) for r in got] == [("shoes", 10, 5, 1)]
    assert items.item_orders(df, sku, date(2024, 1, day), date(2024, 1, day + 1)).first().items_completed == 8


EVENT_DDL = (
    "event_id bigint, received_at timestamp_ntz, logged_at timestamp_ntz, install_id string, session_id string, event_type string, sku_id bigint,"
    " sku_group_id bigint, product_id bigint, category_id bigint, widget_section_id string, query string, event_properties string,"
    " widget_space_name string, widget_section_name string, platform string"
)


def event(i, minute, kind, product=100, query="q", space="SEARCH_RESULTS", section=None, session="s", group=10, props=None, category=7, hour=1):
    t = at(5, hour, minute)
    return (i, t, t, "i1", session, kind, 1, group, product, category, None, query, props, space, section, "WEB")


def funnel(spark, sku, rows):
    return silver.search_funnel_daily(spark.createDataFrame(rows, EVENT_DDL), sku, date(2024, 1, 5), date(2024, 1, 6))


def test_funnel_credits_the_impression_right_before(spark, sku):
    imp, view, cart = "PRODUCT_IMPRESSION", "PRODUCT_VIEW", "ADD_TO_CART"
    got = funnel(spark, sku, [
        event(1, 0, imp, query=" `shoe` "),
        event(2, 1, view),           # credited to 1
        event(3, 2, view),           # preceded by a view: not credited
        event(4, 3, cart),           # carts look at impressions and carts only: credited to 1
        event(5, 4, cart),           # preceded by a cart: not credited
        event(6, 5, view, product=None),
        event(7, 6, imp, product=None, space="CATEGORY", query=None),
        event(8, 59, imp, query="late", product=200), event(9, 0, view, product=200, hour=2),  # across the hour
        event(10, 0, imp, session=None),
    ]).collect()
    rows = {(r.space, r.uniqs): (r.sum_impressions, r.sum_clicks, r.sum_atc) for r in got}
    assert rows == {("SEARCH_RESULTS", "'shoe'"): (1, 1, 1), ("CATEGORY", "7"): (1, 0, 0), ("SEARCH_RESULTS", "late"): (1, 1, 0)}


def test_funnel_fallbacks(spark, sku):
    full = '{"event_parameters": {"is_category_full_matched": "true"}}'
    initial = '{"event_parameters": {"initial_query": "first"}}'
    got = funnel(spark, sku, [
        event(1, 0, "PRODUCT_IMPRESSION", props=full, category=-1),          # fully matched category: no section id -> 0
        event(2, 1, "PRODUCT_IMPRESSION", query=None, props=initial, group=None),  # query and group fall back
        event(3, 2, "PRODUCT_IMPRESSION", query=" ", group=0),
        event(4, 3, "PRODUCT_IMPRESSION", space="MAIN"),                      # neither search nor category
        event(5, 4, "PRODUCT_IMPRESSION", space="MAIN", section="SEARCH_RESULTS"),  # section only: counts as category
    ]).collect()
    assert sorted((r.space, r.uniqs, r.sku_group_id) for r in got) == [
        ("CATEGORY", "0", 10), ("CATEGORY", "7", 10), ("SEARCH_RESULTS", "", 10), ("SEARCH_RESULTS", "first", 10),
    ]


def test_legacy_conversions_use_the_empty_event(spark, sku):
    """An event of the empty type can be the event before; an event without a query takes the previous one."""
    imp, view = "PRODUCT_IMPRESSION", "PRODUCT_VIEW"
    s = {"section": "SEARCH_RESULTS"}
    ev = spark.createDataFrame([
        event(1, 0, imp, query="A", **s), event(2, 1, "", query="A", section="MAIN"), event(3, 2, view, query=None, **s),
        event(4, 3, imp, query="A", session="t", **s), event(5, 4, view, query=None, session="t", **s),
    ], EVENT_DDL)
    none = order_items(spark, [])
    attr = spark.createDataFrame([], "order_item_id bigint, generated_at timestamp_ntz, query string, last_atc_platform string, widget_section_name string")
    got = silver.query_item_daily_conversions(ev, sku, none, attr, date(2024, 1, 5), date(2024, 1, 6)).collect()
    assert [(r.query, r.uniq_impressions, r.uniq_clicks, r.uniq_atcs, r.uniq_orders) for r in got] == [("a", 2, 1, 0, 0)]


def test_score_log_threshold(spark):
    ev = lambda q, score: (at(2, 3), "search_uni", q, ["10"], f'{{"dssm_score": {score}}}')
    events = spark.createDataFrame(
        [ev("new", "[0.5]"), ev("same", '"0.52"'), ev("moved", "[0.53]"), ev("zero", "[0.1]"), ev("still", "[0.0]"), ev("bad", "[0.1, 0.2]"), ev("text", '"x"')],
        "fired_at timestamp_ntz, model_name string, search_query string, ranking_candidates array<string>, external_features string",
    )
    old = [("same", 0.5), ("moved", 0.5), ("zero", 0.0), ("still", 0.0)]
    logged = spark.createDataFrame(
        [(date(2024, 1, 1), q, 10, at(1), s) for q, s in old] + [(date(2023, 12, 1), "same", 10, datetime(2023, 12, 1), 9.0)],
        "date date, query string, sku_group_id bigint, collected_at timestamp_ntz, dssm_score double",
    )
    got = silver.score_change_log(events, logged, date(2024, 1, 2), at(3)).collect()
    assert {r["query"]: r.dssm_score for r in got} == {"new": 0.5, "moved": 0.53, "zero": 0.1}


def test_completion_drops_null_causes_and_active(spark):
    h = spark.createDataFrame(
        [(D, 1, "COMPLETED", "", at(20), 1), (D, 1, "ACTIVE", "", at(20), 1), (D, 2, "RETURNED NO SHOW", "OTHER", at(20), 1),
         (D, 3, "RETURNED", None, at(20), 1), (D, 4, "RETURNED", "DEFECTED", at(20), 1), (D, 5, "ACTIVE", "", at(20), 1), (D, 6, "ACTIVE", "", at(20), 2)],
        "analyze_date date, order_id bigint, real_order_item_status string, return_cause string, generated_at timestamp_ntz, order_city_id bigint",
    )
    got = items.completion_by(h, "order_city_id", D, 120).collect()
    assert [(r.order_city_id, r.part_completed_orders, r.part_no_show_from_total) for r in got] == [(1, 0.5, 0.5)]


def test_discount_needs_its_price(spark, sku):
    live = spark.createDataFrame(
        [(1, "dyno_pricing_a", 5.0, 50.0, at(31, 9)), (2, "dyno_pricing_a", 5.0, 71.0, at(31, 9)), (1, "dyno_pricing_a", 9.0, 50.0, at(31, 8))],
        "sku_id bigint, promotion_id string, discount_amount double, calculated_for_price double, created_at timestamp_ntz",
    )
    stored = live.where("false").withColumn("date", F.lit(D))
    out = gold.discounted_prices(live, stored, sku, at(31, 18), ["dyno_pricing_a", "0"], 2)
    got = {(r.sku_id, r.promotion_id): (r.sell_price, r.discount, r.discount_fraction) for r in out.collect()}
    assert got[1, "dyno_pricing_a"] == (45.0, 5.0, pytest.approx(5 / 45))
    assert got[2, "dyno_pricing_a"] == (70.0, 0.0, 0.0)
    assert got[3, "0"] == (0.0, 0.0, None) and len(got) == 6
    with pytest.raises(ValueError, match="must start with"):
        gold.discounted_prices(live, stored, sku, at(31, 18), ["other"], 2)
    with pytest.raises(ValueError, match="unsupported promotion"):
        gold.today_discounts(live, at(31, 18), "dyno_pricing_'; --")


def pair_tables(spark):
    f = spark.createDataFrame(
        [(date(2024, 1, 30), 10, "SEARCH_RESULTS", "Shoe", 1, 4), (D, 10, "SEARCH_RESULTS", "shoe ", 1, 2), (date(2024, 1, 30), 10, "SEARCH_RESULTS", "  ", 0, 6),
         (date(2024, 1, 30), 10, "CATEGORY", "7", 9, 9), (date(2024, 1, 30), 11, "SEARCH_RESULTS", "shoe", 0, 50), (date(2024, 1, 30), 12, "SEARCH_RESULTS", "hat", 1, 1)],
        "date date, sku_group_id bigint, space string, uniqs string, sum_atc bigint, sum_impressions bigint",
    )
    o = spark.createDataFrame([(date(2024, 1, 30), "shoe", 10, 3, 0), (date(2024, 1, 30), "boot", 10, 1, 0)],
                              "date date, query string, sku_group_id bigint, orders_generated bigint, returned_orders bigint")
    return f, o


def test_pairs_closed_and_half_open(spark, tmp_path):
    f, o = pair_tables(spark)
    for stage in (lambda df: df, write_stage(str(tmp_path))):
        rows = search.pair_features_v2(f, o, D, stage).collect()
        # Item 11 has no outcome, item 12 too few impressions.
        assert [(r["query"], r.sku_group_id) for r in rows] == [("shoe", 10)]
        r = rows[0]
        # The plain rate has day D, the smoothed one ends the day before.
        assert r.query_skg_conv_imp2atc_7 == pytest.approx(2 / 6)
        # Item totals: blank queries count (4 + 6 impressions), other spaces do not; orders of other queries count.
        assert r.query_skg_smooth_conv_imp2atc_7 == pytest.approx((1 + 100 * 1 / 10) / 104)
        assert r.query_skg_orders_frac_all_skg_orders_7 == pytest.approx(3 / 4)
        assert r.query_skg_atc_frac_all_skg_atc_7 == 1.0


def test_canonical_pairs_merge_and_fan_out(spark):
    f, o = pair_tables(spark)
    more = f.unionByName(f.where("uniqs = 'Shoe'").withColumn("uniqs", F.lit("the shoe")))
    d = spark.createDataFrame([("Shoe", "shoe", "v1"), ("the shoe", "shoe", "v1"), ("shoe", "zzz", "v0")], "query_text string, query_id string, version string")
    rows = {(r["query"], r.sku_group_id): r for r in search.pair_features_canonical(more, o, d, D).collect()}
    assert set(rows) == {("shoe", 10), ("the shoe", 10)}
    assert {r.query_id for r in rows.values()} == {"shoe"} and all(r.has_query_id for r in rows.values())
    assert rows["shoe", 10].query_skg_conv_imp2atc_7 == rows["the shoe", 10].query_skg_conv_imp2atc_7 == pytest.approx(3 / 10)


def test_text_pairs_legacy_denominator(spark):
    f = spark.createDataFrame([(date(2023, 11, 20), 10, "SEARCH_RESULTS", "q", 1, 10), (D, 10, "SEARCH_RESULTS", "q", 1, 2)],
                              "date date, sku_group_id bigint, space string, uniqs string, sum_atc bigint, sum_impressions bigint")
    assert search.query_text_pair_features(f, D).first().query_skg_conv_imp2atc_90 == pytest.approx(2 / 12)
    assert search.query_text_pair_features(f, D, legacy=True).first().query_skg_conv_imp2atc_90 == 1.0


def test_dictionary_appends_only_new_queries(spark):
    f = spark.createDataFrame([(D, "SEARCH_RESULTS", "b a"), (D, "SEARCH_RESULTS", "old"), (D, "SEARCH_RESULTS", "sale"), (D, "CATEGORY", "7"),
                               (date(2024, 1, 30), "SEARCH_RESULTS", "z")], "date date, space string, uniqs string")
    known = spark.createDataFrame([("old", "v1"), ("b a", "v0")], "query_text string, version string")
    got = search.query_dictionary(f, known, D, ["sale"], at(31)).collect()
    assert [(r.query_text, r.query_id, r.version) for r in got] == [("b a", "a b", "v1")]


def test_tasks_of_the_item_join(spark, sku):
    """The given number of tasks is that of the join, whatever adaptive execution would merge."""
    df = order_items(spark, [(i, i, 1, at(5), at(6), None, "COMPLETED", 1, 0) for i in range(40)])
    attr = df.select("order_item_id", "generated_at", F.lit("shoes").alias("query"), F.lit("SEARCH").alias("widget_space_name"))
    days = (date(2024, 1, 1), date(2024, 1, 20))
    got = items.query_item_orders(df, sku, attr, *days, tasks=23)
    assert sorted(got.collect()) == sorted(items.query_item_orders(df, sku, attr, *days).collect())
    assert got._jdf.queryExecution().executedPlan().toString().count(", 23), REPARTITION_BY_NUM") >= 2
    assert [tasks_for(spark, n, 10) for n in (0, 80, 81, 1001)] == [8, 8, 9, 101]


def account_history(spark, rows):
    ddl = ("analyze_date date, account_id bigint, order_id bigint, order_item_id bigint, generated_at timestamp_ntz, delivered_at timestamp_ntz, issued_at timestamp_ntz,"
           " returned_at timestamp_ntz, delivery_type string, payment_type string, order_city_id bigint, order_region_id bigint, delivery_point_id bigint,"
           " item_quantity bigint, real_order_item_status string, return_cause string, gmv_generated decimal(18,2), gmv_completed decimal(18,2)")
    from decimal import Decimal

    full = [(D, 1, o, i, g, d, iss, ret, "PICKUP", "Card", 1, 1, 1, 1, st, cause, Decimal(100), Decimal(100 if st == "COMPLETED" else 0))
            for o, i, g, d, iss, ret, st, cause in rows]
    return spark.createDataFrame(full, ddl)


def test_account_history_rules(spark, tmp_path):
    h = account_history(spark, [
        (1, 1, at(1), at(2), at(3), None, "COMPLETED", None),
        (2, 2, at(5), at(6), None, at(12), "RETURNED", "CANCELED"),                    # six days on the shelf: no-show
        (3, 3, at(7), at(8), None, at(13, 23), "RETURNED", "CANCELED"),                # not quite six: cancelled late
        (4, 4, at(9), at(10), at(11), at(11, 1), "RETURNED AFTER COMPLETED", "OTHER"),   # 60 minutes: at handover
        (5, 5, at(10), at(11), at(12), at(12, 1, 1), "RETURNED AFTER COMPLETED", "OTHER"),  # 61 minutes: later
        (6, 6, at(30), None, None, None, "ACTIVE", None),
    ])
    for stage in (lambda df: df, write_stage(str(tmp_path))):
        r = accounts.account_asof_history(h, D, stage=stage).first()
        assert (r.n_items_no_show, r.n_items_cancel_after_delivery, r.n_items_return_at_handover, r.n_items_return_post_handover) == (1, 1, 1, 1)
        assert (r.n_orders_win, r.n_resolved_orders_win, r.n_orders_in_processing) == (6, 5, 1)
        assert (r.prev_order_is_nonbuyout, r.prev2_order_is_nonbuyout, r.prev3_order_is_nonbuyout) == (0, 0, 1)
        assert (r.buyout_streak, r.nonbuyout_streak) == (2, 0)
        assert r.last_nonbuyout_type == "cancel_after_delivery" and r.days_since_last_nonbuyout == 17  # next day in the business zone
        assert r.buyout_trend == pytest.approx((0 + 0 + 0) / 3 - (1 + 0 + 0) / 3)


def test_no_trend_with_three_orders(spark):
    h = account_history(spark, [(i, i, at(i), at(i + 1), at(i + 2), None, "COMPLETED", None) for i in (1, 2, 3)])
    r = accounts.account_asof_history(h, D).first()
    assert r.buyout_trend is None and r.buyout_rate_last_3 == 1.0 and r.buyout_streak == 3 and r.history_left_censored == 0


def test_orders_created_at_the_business_midnight(spark):
    end = datetime(2024, 1, 31, 19)  # midnight after D in the business zone
    rows = [(1, 1, end - timedelta(seconds=1)), (1, 2, end), (1, 3, end - timedelta(days=1)), (1, 4, end - timedelta(days=1, seconds=1)), (0, 5, end - timedelta(hours=1))]
    df = spark.createDataFrame([(a, o, g, g, "ACTIVE") for a, o, g in rows],
                               "account_id bigint, order_id bigint, generated_at timestamp_ntz, purchased_at timestamp_ntz, order_item_status string")
    got = accounts.orders_created(df, D).collect()
    assert [(r.account_id, r.orders_created_prev_1d, r.orders_created_prev_7d) for r in got] == [(1, 2, 3)]


def test_history_and_creations_are_staged_together(spark, tmp_path):
    """Snapshot and order items go into one staged plan; nothing after it reads the items again."""
    made = [(1, 1, at(1), at(2), at(3), None, "COMPLETED", None), (2, 2, at(5), at(6), None, at(12), "RETURNED", "CANCELED"), (2, 3, at(4), at(6), at(7), None, "COMPLETED", None)]
    rows = account_history(spark, made).withColumns({"purchased_at": F.col("generated_at"), "order_item_status": F.lit("ACTIVE")})
    # An order without a row in the snapshot, an account without any, and no account.
    more = rows.where("order_item_id = 1").selectExpr("* except (order_id, account_id, analyze_date)", "explode(array(9L, 10L, 11L)) as order_id").selectExpr(
        "*", "case order_id when 9 then 1L when 10 then 2L else 0L end as account_id", "date'2023-01-01' as analyze_date")
    rows.unionByName(more).write.parquet(str(tmp_path / "items"))
    placed = spark.read.parquet(str(tmp_path / "items"))
    facts = spark.createDataFrame([(D, 1, date(2023, 1, 1), date(2022, 1, 1))], "date date, account_id bigint, first_order_date_ever date, registration_date date")
    staged = []

    def stage(df):
        staged.append(df)
        return write_stage(str(tmp_path / "staged"))(df)

    got = accounts.account_buyout_history(placed, placed, facts, D, stage=stage)
    plain = accounts.account_buyout_history(placed, placed, facts, D)
    assert got.collect() == plain.collect()
    assert [(r.account_id, r.n_orders_win, r.orders_created_prev_30d, r.orders_created_prev_365d) for r in got.collect()] == [(1, 2, 1, 3)]
    assert len(staged) == 1 and not any("/items/" in f for f in got.inputFiles())


def test_neighbour_orders_ages_and_distance(spark):
    from featuremill.functions import hexgrid

    cell = hexgrid.pack(F.lit(0), F.lit(0))
    points = spark.range(1).select(
        F.lit(7).cast("bigint").alias("id"), hexgrid.centre_lat(cell).alias("latitude"), hexgrid.centre_lon(cell).alias("longitude"), F.lit("DELIVERY_POINT").alias("type")
    )
    ages = [0, 1, 30, 31, 89, 90]
    orders = spark.createDataFrame([(a, 7, D - timedelta(days=a), date(2023, 1, 1), "COMPLETED", 10.0) for a in ages],
                                   "order_id bigint, delivery_point_id bigint, created_on date, issued_on date, status string, amount double")
    rates = spark.createDataFrame([(D - timedelta(days=a), 0.5) for a in ages], "date date, usd_rate double")
    out = geo.hex_neighbour_orders(orders, points, rates, D)
    assert out.count() == 91
    home = out.where(F.col("h3_index") == hexgrid.pack(F.lit(0), F.lit(0))).first()
    # Age 0 and age 90 never count.
    assert (home.orders_r0_h30, home.orders_r0_h60, home.orders_r0_h90, home.gmv_r5_h90, home.unique_dp_r0_h30) == (2, 3, 4, 20.0, 1)
    assert home.min_dist_to_dp_m == 10000.0  # a distance of zero is treated as missing
    assert home.min_dist_to_inshop_m == 10000.0


def test_mart_fills_by_type(spark):
    act = spark.createDataFrame([(1, 5)], "h3_index bigint, views_r1_30d bigint")
    wide = {c: "bigint" for c in ("orders_r0_30d", "orders_r3_90d", "orders_r4_30d")}
    for c in wide:
        act = act.withColumn(c, F.lit(1).cast("bigint"))
    demo = spark.createDataFrame([(2, "x", None, 3.0, 1.0, 4.0, 9.0)],
                                 "h3_index bigint, h3_string string, region string, population_r0 double, pedestrian_traffic_index_r0 double,"
                                 " pedestrian_traffic_index_r1 double, pedestrian_traffic_index_r2 double")
    near = spark.createDataFrame([(2, "x", 5.0, None, 4, 2)], "h3_index bigint, h3_string string, min_dist_to_dp_m double, min_dist_to_inshop_m double, orders_r5_h90 bigint, unique_dp_r5_h90 bigint")
    loc = spark.createDataFrame([(1, date(2024, 1, 30), 2)], "h3_index bigint, report_date date, users_r0 bigint")
    poi = spark.createDataFrame([(2, *[1] * 7)], "h3_index bigint, atms_r1 bigint, banks_r2 bigint, retail_points_r1 bigint, car_dealers_services_r2 bigint, mixed_goods_r2 bigint, fast_food_coffee_r5 bigint, bakeries_r1 bigint")
    got = {r.h3_index: r for r in geo.hex_forecast_mart(demo, near, act, loc, poi, D).collect()}
    assert (got[1].region, got[1].h3_string, got[1].population, got[1].min_dist_to_dp_m, got[1].users_views_r1_30d) == ("UNKNOWN", None, 0.0, 10000.0, 5)
    assert (got[2].traffic_ring_1_2, got[2].report_date, got[2].min_dist_to_inshop_m) == (5.0, None, 10000.0)
    assert got[2].orders_per_dp_r5_h90 == pytest.approx(4 / 2.00001)


def test_ranking_positions(spark):
    def shown(i, position, minute, group=10, session="s"):
        t = at(17, 10, minute)
        return (t, t, "i1", session, group, "Shoe ", position, "PRODUCT_IMPRESSION", "SEARCH_RESULTS", "SEARCH_RESULTS", False)

    ev = spark.createDataFrame(
        [shown(1, 3, 5), shown(2, 3, 1, 11), shown(3, 9, 2), shown(4, 1500, 3), shown(5, 2, 1, session=None)],
        "received_at timestamp_ntz, logged_at timestamp_ntz, install_id string, session_id string, sku_group_id bigint, query string, position int,"
        " event_type string, widget_space_name string, widget_section_name string, is_full_catpred boolean",
    )
    got = {(r.session_id, r.position): (r.sku_group_id, r.deduplicate_rank, r.position_duplicate_count) for r in ranking.shown_positions(ev, date(2024, 1, 17)).collect()}
    assert got == {("s", 3): (11, 1, 2), ("s", 9): (10, 2, 1), ("s", 1500): (10, 3, 1), (None, 2): (10, 1, 1)}


def test_price_features_without_history(spark, sku):
    p = spark.createDataFrame([(D, 10, 60.0, 55.0, 110.0, 100.0), (date(2024, 1, 30), 10, 1.0, 1.0, 1.0, 90.0), (date(2024, 1, 29), 10, 1.0, 1.0, 1.0, 45.0),
                               (D, 11, 0.0, 0.0, 0.0, 0.0)],
                              "date date, sku_group_id bigint, avg_sell_price_eod double, median_sell_price_eod double, median_full_price_eod double, min_full_price_eod double")
    got = {r.sku_group_id: r for r in gold.price_features(p, sku, D).collect()}
    assert got[10].abs_discount == 55.0 and got[10].fraq_discount == 0.5 and got[10].ratio_crnt_min_to_avg_min_full_price_14 == 2.0
    assert got[11].fraq_discount is None and got[11].ratio_crnt_min_to_avg_min_full_price_30 is None


def test_point_openings_are_extended_by_the_new_days(spark):
    ddl = "delivery_point_id bigint, issued_on date"
    day = lambda d: date(2024, 1, d)
    rows = [(1, day(3)), (1, day(2)), (2, None), (0, day(1)), (3, day(9)), (1, day(9))]
    whole = {tuple(r) for r in geo.point_openings(spark.createDataFrame(rows, ddl)).collect()}
    before = geo.point_openings(spark.createDataFrame(rows[:4], ddl))
    assert {tuple(r) for r in geo.point_openings(spark.createDataFrame(rows[4:], ddl), before).collect()} == whole == {(1, day(2)), (3, day(9))}
