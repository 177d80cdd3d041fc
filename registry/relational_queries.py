"""Registered joins, aggregations, table generators, quality tests and re-aimed operators."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F

from featuremill.functions import hexgrid, ratios, text
from featuremill.operators import canonical, distinct_days, outcomes, rows
from featuremill.operators.relevance import field_scores
from featuremill.operators.rings import ring_sums, scatter
from featuremill.plans import geo
from featuremill.plans import item_silver as items
from featuremill.quality.checks import check_frame
from featuremill.quality.config import DqSettings, load_settings, make_spec
from featuremill.quality.runner import result_rows, run_checks, save_results
from featuremill.sources.scan import partition_days
from featuremill.sources.star_views import StarViews
from registry import gold_queries as g
from registry import silver_queries as silver
from registry.geo_sql import LAT, LON, cell_of_sql, dbl
from registry.kernel_queries import EXTRA as KERNEL_EXTRA
from registry.silver_queries import rounded
from registry.views_sql import cell
from registry.workspace import fresh_dir

D = silver.D
DS = "DATE '2024-01-31'"


def _n():
    return F.count(F.lit(1)).alias("n")


# --- joins ---------------------------------------------------------------------------------------

def _sku(v, *cols):
    return v.sku.select(F.col("id").alias("sku_id"), *cols)


def j01(v):
    # Items are summed per sku before the dimension is joined.
    per_sku = v.order_items.groupBy("sku_id").agg(F.sum("item_quantity").alias("q"))
    return per_sku.join(_sku(v, "dimensional_group"), "sku_id").groupBy("dimensional_group").agg(F.sum("q").alias("q"))


def j02(v):
    looked = v.clickstream.join(_sku(v, F.col("sku_group_id").alias("mapped")), "sku_id", "left")
    return looked.groupBy(F.coalesce("sku_group_id", "mapped", F.lit(0)).alias("sku_group_id")).agg(_n())


def j03(v):
    keyed = v.clickstream.join(v.product.select(F.col("id").alias("product_id"), F.col("category_id").alias("pc")), "product_id", "left").withColumn(
        "key", F.when(F.col("category_id") > 0, F.col("category_id")).otherwise(F.col("pc"))
    )
    return keyed.join(v.category.select(F.col("id").alias("key"), "l1_category"), "key").groupBy("l1_category").agg(_n())


def j04(v):
    made = v.order_items.groupBy(F.to_date("generated_at").alias("date"), "city_id").agg(F.sum("item_quantity").alias("made"))
    back = v.order_items.where("returned_at is not null").groupBy(F.to_date("returned_at").alias("date"), "city_id").agg(
        F.sum("returned_quantity").alias("back")
    )
    zero = F.lit(0)
    both = made.join(back, ["date", "city_id"], "full").select(
        "date", "city_id", F.coalesce("made", zero).alias("made"), F.coalesce("back", zero).alias("back")
    )
    return both.where("made + back > 0")


def j05(v):
    frames = [
        v.order_items.groupBy(F.to_date("generated_at").alias("d")).agg(F.count(F.lit(1)).alias("orders")),
        v.clickstream.groupBy(F.to_date("received_at").alias("d")).agg(F.count(F.lit(1)).alias("clicks")),
        v.sku_eod.groupBy(F.col("dt").alias("d")).agg(F.count(F.lit(1)).alias("stock")),
    ]
    wide = reduce(lambda a, b: a.join(b, "d", "full"), frames)
    return wide.select("d", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orders", "clicks", "stock")])


def j06(v):
    top = v.sku.select(F.max("sell_price")).scalar()  # the one-row side, as a scalar subquery
    return v.sku.select("id", ratios.ratio("sell_price", top).alias("share"))


def j07(v):
    asked = v.clickstream.groupBy("query").agg(F.countDistinct("install_id").alias("installs")).alias("a")
    seen = v.clickstream.groupBy("query").agg(_n()).alias("b")
    return asked.join(seen, F.col("a.query").eqNullSafe(F.col("b.query"))).select("a.query", "installs", "n")


def j08(v):
    funnel = v.stage(silver.funnel(v))
    known = g.dictionary(v, funnel).where("query_id <> query_text").select("query_text")
    return funnel.where("space = 'SEARCH_RESULTS'").select(F.col("uniqs").alias("query_text")).distinct().join(known, "query_text", "left_anti")


def j09(v):
    buyers = v.clickstream.where("event_type = 'ADD_TO_CART' and session_id is not null").select("session_id").distinct()
    return v.clickstream.join(buyers, "session_id", "left_semi").groupBy("event_type").agg(_n())


def j10(v):
    ordered = v.table("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return v.table("customer").join(ordered, "c_custkey", "left_anti").select("c_custkey")


def j11(v):
    sig = v.stage(g.signal(v)).select("key_type", "key_id", "n_delivered_90d")
    level = lambda t, key: sig.where(F.col("key_type") == t).select(F.col("key_id").alias(key), F.col("n_delivered_90d").alias(f"{t}_n"))
    return (
        level("sku", "sku_id").join(_sku(v, "product_id", "shop_id"), "sku_id")
        .join(level("product", "product_id"), "product_id", "left").join(level("shop", "shop_id"), "shop_id", "left")
        .select("sku_id", "sku_n", "product_n", "shop_n")
    )


def j12(v):
    near = scatter(v.demography.select("h3_index", "population"), "h3_index", 2)
    return near.groupBy("h3_index").agg(F.sum("population").alias("population"))


def j13(v):
    orders = v.order_items.select("delivery_point_id", F.to_date("generated_at").alias("on"))
    opened = v.order_items.where("issued_at is not null").groupBy("delivery_point_id").agg(F.min(F.to_date("issued_at")).alias("opened"))
    # A join on the point first; the date range is a filter on the joined rows.
    per_day = orders.groupBy("delivery_point_id", "on").agg(_n())
    return per_day.join(opened, "delivery_point_id").where("on >= opened and datediff(on, opened) <= 60").groupBy("delivery_point_id").agg(F.sum("n").alias("n"))


def j14(v):
    last = rows.first_row(v.dynamic_discount, ["sku_id", "promotion_id"], items.latest_discount_order())
    one = last.where("promotion_id = 'dyno_pricing_2'").select("sku_id", F.col("discount_amount").cast("double").alias("discount"))
    return _sku(v).join(one, "sku_id", "left")


def j15(v):
    shown = v.clickstream.where("event_type = 'PRODUCT_IMPRESSION'").groupBy("install_id", "session_id", "sku_group_id", F.lower("query").alias("query")).agg(_n())
    carts = v.clickstream.where("event_type = 'ADD_TO_CART'").select("install_id", "session_id", "sku_group_id", F.lower("query").alias("query")).distinct()
    keys = ["install_id", "session_id", "sku_group_id", "query"]
    return shown.join(carts.withColumn("hit", F.lit(1)), keys, "left").select(*keys, "n", F.coalesce("hit", F.lit(0)).alias("hit"))


def j16(v):
    funnel = v.stage(silver.funnel(v))
    per = funnel.where("space = 'SEARCH_RESULTS'").groupBy(text.normalise_query(F.col("uniqs")).alias("query"), "sku_group_id").agg(
        F.sum("sum_impressions").alias("i")
    ).where(text.has_text(F.col("query")))
    keyed = canonical.attach_group_key(per, canonical.query_key_map(g.dictionary(v, funnel), "v1"))
    groups = keyed.groupBy("group_key", "sku_group_id").agg(F.sum("i").alias("i"))
    members = keyed.select("group_key", "query").distinct()
    return canonical.fan_out(members, groups, "group_key", ["sku_group_id"], 8).select("query", "group_key", "sku_group_id", "i")


def j17(v):
    base = v.demography.select("h3_index", "population")
    out = base.select("h3_index")
    for lv in geo.PARENT_LEVELS:
        parent = base.groupBy(hexgrid.parent_cell(F.col("h3_index"), lv).alias("p")).agg(F.sum("population").alias(f"population_l{lv}"))
        out = out.withColumn("p", hexgrid.parent_cell(F.col("h3_index"), lv)).join(parent, "p", "left").drop("p")
    return out


_PB = ", ".join(
    f"b{lv} AS ({cell_of_sql('b', LAT('r'), LON('q', 'r'), lv, 'p')}), s{lv} AS (SELECT p, sum(population) AS population_l{lv} FROM b{lv} GROUP BY p)" for lv in geo.PARENT_LEVELS
)
J17_SQL = (
    f"WITH b AS (SELECT * FROM v_demography), {_PB} SELECT b.h3_index, {', '.join(f'population_l{lv}' for lv in geo.PARENT_LEVELS)} FROM b "
    + " ".join(f"JOIN b{lv} ON b{lv}.h3_index = b.h3_index JOIN s{lv} ON s{lv}.p = b{lv}.p" for lv in geo.PARENT_LEVELS)
)

JOINS = {
    "j01_inner_dimension": (j01, "SELECT dimensional_group, CAST(sum(item_quantity) AS BIGINT) AS q FROM v_order_items JOIN v_sku ON v_sku.id = sku_id GROUP BY 1"),
    "j02_left_fallback": (
        j02, "SELECT coalesce(c.sku_group_id, s.sku_group_id, 0) AS sku_group_id, count(*) AS n FROM v_clicks c LEFT JOIN v_sku s ON s.id = c.sku_id GROUP BY 1",
    ),
    "j03_computed_key": (
        j03,
        """SELECT l1_category, count(*) AS n FROM v_clicks e LEFT JOIN v_product p ON p.id = e.product_id
  JOIN v_category c ON (CASE WHEN e.category_id > 0 THEN e.category_id ELSE p.category_id END) = c.id GROUP BY 1""",
    ),
    "j04_full_outer": (
        j04,
        """SELECT date, city_id, CAST(coalesce(m, 0) AS BIGINT) AS made, CAST(coalesce(b, 0) AS BIGINT) AS back FROM
  (SELECT CAST(generated_at AS DATE) AS date, city_id, sum(item_quantity) AS m FROM v_order_items GROUP BY 1, 2) x FULL JOIN
  (SELECT CAST(returned_at AS DATE) AS date, city_id, sum(returned_quantity) AS b FROM v_order_items WHERE returned_at IS NOT NULL GROUP BY 1, 2) y USING (date, city_id)
WHERE coalesce(m, 0) + coalesce(b, 0) > 0""",
    ),
    "j05_n_way_full_outer": (
        j05,
        """SELECT d, coalesce(o, 0) AS orders, coalesce(c, 0) AS clicks, coalesce(s, 0) AS stock FROM
  (SELECT CAST(generated_at AS DATE) AS d, count(*) AS o FROM v_order_items GROUP BY 1) x FULL JOIN (SELECT CAST(received_at AS DATE) AS d, count(*) AS c FROM v_clicks GROUP BY 1) y USING (d)
  FULL JOIN (SELECT dt AS d, count(*) AS s FROM v_sku_eod GROUP BY 1) z USING (d)""",
    ),
    "j06_one_row_cross": (j06, "SELECT id, CAST(sell_price AS DOUBLE) / (SELECT CAST(max(sell_price) AS DOUBLE) FROM v_sku) AS share FROM v_sku"),
    "j07_null_safe": (j07, "SELECT query, count(DISTINCT install_id) AS installs, count(*) AS n FROM v_clicks GROUP BY 1"),
    "j08_anti": (
        j08, "SELECT DISTINCT uniqs AS query_text FROM o_funnel WHERE space = 'SEARCH_RESULTS' AND uniqs NOT IN (SELECT query_text FROM o_dict WHERE query_id <> query_text)",
    ),
    "j09_semi": (
        j09, "SELECT event_type, count(*) AS n FROM v_clicks WHERE session_id IN (SELECT session_id FROM v_clicks WHERE event_type = 'ADD_TO_CART' AND session_id IS NOT NULL) GROUP BY 1",
    ),
    "j10_not_exists": (j10, "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderpriority = '1-URGENT')"),
    "j11_multi_level_self_join": (
        j11,
        """SELECT s.key_id AS sku_id, s.n_delivered_90d AS sku_n, p.n_delivered_90d AS product_n, h.n_delivered_90d AS shop_n FROM o_signal s JOIN v_sku m ON m.id = s.key_id
  LEFT JOIN o_signal p ON p.key_type = 'product' AND p.key_id = m.product_id LEFT JOIN o_signal h ON h.key_type = 'shop' AND h.key_id = m.shop_id WHERE s.key_type = 'sku'""",
    ),
    "j12_hex_neighbourhood": (
        j12, f"SELECT {cell('q + dq', 'r + dr')} AS h3_index, sum(population) AS population FROM v_demography CROSS JOIN v_off WHERE ring <= 2 GROUP BY 1",
    ),
    "j13_range_after_equi": (
        j13,
        """SELECT o.delivery_point_id, count(*) AS n FROM v_order_items o JOIN (SELECT delivery_point_id, min(CAST(issued_at AS DATE)) AS opened FROM v_order_items WHERE issued_at IS NOT NULL GROUP BY 1) p
  USING (delivery_point_id) WHERE CAST(generated_at AS DATE) >= opened AND date_diff('day', opened, CAST(generated_at AS DATE)) <= 60 GROUP BY 1""",
    ),
    "j14_as_of_latest": (
        j14,
        """SELECT id AS sku_id, CAST(discount_amount AS DOUBLE) AS discount FROM v_sku LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sku_id
  ORDER BY created_at DESC, discount_amount DESC, calculated_for_price DESC) AS rn FROM v_discount WHERE promotion_id = 'dyno_pricing_2') d ON d.sku_id = id AND rn = 1""",
    ),
    "j15_four_column_key": (
        j15,
        """SELECT s.*, CASE WHEN c.query IS NULL THEN 0 ELSE 1 END AS hit FROM
  (SELECT install_id, session_id, sku_group_id, lower(query) AS query, count(*) AS n FROM v_clicks WHERE event_type = 'PRODUCT_IMPRESSION' GROUP BY 1, 2, 3, 4) s LEFT JOIN
  (SELECT DISTINCT install_id, session_id, sku_group_id, lower(query) AS query FROM v_clicks WHERE event_type = 'ADD_TO_CART') c
  ON c.install_id = s.install_id AND c.session_id = s.session_id AND c.sku_group_id = s.sku_group_id AND c.query = s.query""",
    ),
    "j16_group_fan_out": (
        j16,
        f"""WITH p AS (SELECT {g.NQ_U} AS query, sku_group_id, sum(sum_impressions) AS i FROM o_funnel WHERE space = 'SEARCH_RESULTS' GROUP BY 1, 2),
k AS (SELECT coalesce(query_id, query) AS group_key, p.* FROM p LEFT JOIN o_qmap USING (query) WHERE query <> ''), m AS (SELECT DISTINCT group_key, query FROM k)
SELECT m.query, group_key, x.sku_group_id, CAST(x.i AS BIGINT) AS i FROM m JOIN (SELECT group_key, sku_group_id, sum(i) AS i FROM k GROUP BY 1, 2) x USING (group_key)""",
    ),
    "j17_parent_roll_up": (j17, J17_SQL),
}

# --- aggregations ------------------------------------------------------------------------------------

def a02(v):
    per = v.clickstream.where("account_id > 0").groupBy("account_id", "session_id").agg(F.countDistinct("product_id").alias("p"))
    return per.groupBy("account_id").agg(F.sum("p").alias("products"))


def a03(v):
    kinds = {"imps": "PRODUCT_IMPRESSION", "views": "PRODUCT_VIEW", "carts": "ADD_TO_CART"}
    # Distinct (platform, session) rows with flags first, then plain counts.
    per = v.clickstream.where("session_id is not null").groupBy("platform", "session_id").agg(
        *[F.max((F.col("event_type") == k).cast("int")).alias(n) for n, k in kinds.items()]
    )
    return per.groupBy("platform").agg(*[F.sum(n).alias(n) for n in kinds])


def a05(v):
    ret = F.col("returned_at") < F.lit("2023-12-01").cast("timestamp_ntz")
    return v.order_items.groupBy("region_id").agg(
        F.coalesce(F.sum(F.when(ret, F.col("returned_quantity"))), F.lit(0)).alias("returned"),
        F.coalesce(F.sum(F.when(ret, F.col("gmv_returned"))), F.lit(0)).cast("double").alias("gmv"),
    )


def a06(v):
    per = v.order_items.join(_sku(v, "shop_id", "category_id"), "sku_id").groupBy("shop_id", "category_id").agg(F.sum("item_quantity").alias("q"))
    sets = per.groupingSets([["shop_id"], ["category_id"]], "shop_id", "category_id").agg(F.sum("q").alias("q"), F.grouping("shop_id").alias("gs"))
    by_shop = F.col("gs") == 0
    return sets.select(
        F.when(by_shop, F.lit("shop")).otherwise("category").alias("key_type"),
        F.when(by_shop, F.col("shop_id")).otherwise(F.col("category_id")).alias("key_id"), "q",
    )


def a07(v):
    levels = F.array(*[F.struct(F.lit(n).alias("level"), F.col(f"{n}_category").alias("category_id")) for n in ("l1", "l2", "l3", "l4")])
    per = v.history_order_items.groupBy("category_id").agg(_n()).join(v.category.withColumnRenamed("id", "category_id"), "category_id")
    return per.select("n", F.explode(levels).alias("s")).where("s.category_id > 0").groupBy("s.level", "s.category_id").agg(F.sum("n").alias("n"))


def a08(v):
    when = F.struct("generated_at", "order_item_id")
    return v.order_items.groupBy("account_id").agg(
        F.min_by("payment_type", when).alias("first_payment"), F.max_by("delivery_type", when).alias("last_delivery")
    )


def a09(v):
    x = F.col("gmv_generated").cast("double")
    return v.order_items.groupBy("account_id").agg(outcomes.lower_median(x).alias("lower"), outcomes.upper_median(x).alias("upper"))


def a11(v):
    per = v.order_items.groupBy("delivery_point_id", "order_id").agg(F.max((F.col("order_item_status") == "COMPLETED").cast("int")).alias("c"))
    return per.groupBy("delivery_point_id").agg(_n(), F.sum("c").alias("completed"))


def a11b(v):
    """Distinct orders of 14 days from daily bitmaps; the dictionary is extended once on the way."""
    # The rows are used three times.
    items = v.stage(v.order_items.select(F.to_date("generated_at").alias("date"), "delivery_point_id", F.col("order_id").alias("id")))
    start, half, end = (D - timedelta(days=n) for n in (13, 6, -1))
    none = v.spark.createDataFrame([], "id bigint, number bigint")
    first = v.stage(distinct_days.new_numbers(items.where(F.col("date") < F.lit(half)), none))
    numbers = v.stage(first.unionByName(distinct_days.new_numbers(items, first)))
    daily = v.stage(distinct_days.daily_bitmaps(items, numbers, ["delivery_point_id"]))
    return distinct_days.distinct_over(daily, ["delivery_point_id"], start, end)


def a12(v):
    age = F.datediff(F.lit(D), "day")
    per = v.hex_activity.groupBy("h3_index").agg(*[F.coalesce(F.sum(F.when(age < w, F.col("daily_views"))), F.lit(0)).alias(f"v{w}") for w in (10, 20)])
    return ring_sums(per, "h3_index", {f"v{w}": f"v{w}_r{{r}}" for w in (10, 20)}, (0, 1, 2)).drop("nearest")


def a13(v):
    return v.order_items.groupBy("account_id").agg(
        F.coalesce(F.min(F.when(F.col("delivery_type") == "COURIER", F.col("item_quantity").cast("double"))), F.lit(10000.0)).alias("least")
    )


def a15(v):
    return v.sku.select("shop_id", "category_id").distinct().groupBy("shop_id").agg(F.sort_array(F.collect_list("category_id")).alias("categories"))


def a16(v):
    per = v.order_items.groupBy("account_id", "sku_id").agg(F.sum("item_quantity").alias("q"))
    return rows.top_list(per, ["account_id"], [F.col("q").desc(), F.col("sku_id")], "sku_id", 3, "top")


def a18(v):
    per = v.clickstream.where("query is not null").select("query", "install_id").distinct().groupBy("query").agg(_n())
    return per.where("n >= 20")


def a20(v):
    last = lambda k: F.datediff(F.lit(D), F.max(F.when(F.col("event_type") == k, F.to_date("received_at")))).cast("int")
    return v.clickstream.groupBy("sku_id").agg(last("PRODUCT_IMPRESSION").alias("shown_ago"), last("ADD_TO_CART").alias("cart_ago"))


def a21(v):
    per = v.order_items.groupBy("account_id", "order_id").agg(_n(), F.sum("item_quantity").alias("units"), F.max("gmv_generated").alias("top"))
    return per.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("n").alias("lines"), F.max("units").alias("most_units"), F.max("top").cast("double").alias("top")
    )


AGGREGATES = {
    "a01_by_key": (
        lambda v: v.order_items.groupBy("city_id").agg(F.sum("gmv_generated").cast("double").alias("s"), F.min("item_quantity").alias("lo"), F.max("item_quantity").alias("hi"),
                                                       ratios.ratio(F.sum("item_quantity"), F.count("item_quantity")).alias("mean")),
        "SELECT city_id, CAST(sum(gmv_generated) AS DOUBLE) AS s, min(item_quantity) AS lo, max(item_quantity) AS hi, CAST(sum(item_quantity) AS DOUBLE) / count(*) AS mean FROM v_order_items GROUP BY 1",
    ),
    "a02_two_stage": (
        a02, "SELECT account_id, CAST(sum(p) AS BIGINT) AS products FROM (SELECT account_id, session_id, count(DISTINCT product_id) AS p FROM v_clicks WHERE account_id > 0 GROUP BY 1, 2) x GROUP BY 1",
    ),
    "a03_conditional_distinct": (
        a03,
        """SELECT platform, count(DISTINCT CASE WHEN event_type = 'PRODUCT_IMPRESSION' THEN session_id END) AS imps, count(DISTINCT CASE WHEN event_type = 'PRODUCT_VIEW' THEN session_id END) AS views,
  count(DISTINCT CASE WHEN event_type = 'ADD_TO_CART' THEN session_id END) AS carts FROM v_clicks WHERE session_id IS NOT NULL GROUP BY 1""",
    ),
    "a04_filtered": (
        lambda v: v.feedback.groupBy("product_id").agg(F.expr("count(id) FILTER (WHERE rating <= 3)").alias("bad"), F.expr("count(id) FILTER (WHERE coalesce(message, '') <> '')").alias("texts")),
        "SELECT product_id, count(id) FILTER (WHERE rating <= 3) AS bad, count(id) FILTER (WHERE coalesce(message, '') <> '') AS texts FROM v_feedback GROUP BY 1",
    ),
    "a05_conditional_sums": (
        a05,
        """SELECT region_id, CAST(sum(CASE WHEN returned_at < TIMESTAMP '2023-12-01' THEN returned_quantity ELSE 0 END) AS BIGINT) AS returned,
  CAST(sum(CASE WHEN returned_at < TIMESTAMP '2023-12-01' THEN gmv_returned ELSE 0 END) AS DOUBLE) AS gmv FROM v_order_items GROUP BY 1""",
    ),
    "a06_grouping_sets": (
        a06,
        """SELECT CASE WHEN grouping(shop_id) = 0 THEN 'shop' ELSE 'category' END AS key_type, CASE WHEN grouping(shop_id) = 0 THEN shop_id ELSE category_id END AS key_id,
  CAST(sum(item_quantity) AS BIGINT) AS q FROM v_order_items JOIN v_sku s ON s.id = sku_id GROUP BY GROUPING SETS ((shop_id), (category_id))""",
    ),
    "a07_multi_level": (
        a07,
        " UNION ALL ".join(
            f"SELECT '{n}' AS level, {n}_category AS category_id, count(*) AS n FROM v_history h JOIN v_category c ON c.id = h.category_id WHERE {n}_category > 0 GROUP BY 2" for n in ("l1", "l2", "l3", "l4")
        ),
    ),
    "a08_first_last_attribute": (
        a08,
        """SELECT account_id, arg_min(payment_type, {'a': generated_at, 'b': order_item_id}) AS first_payment, arg_max(delivery_type, {'a': generated_at, 'b': order_item_id}) AS last_delivery FROM v_order_items GROUP BY 1""",
    ),
    "a09_medians": (
        a09, "SELECT account_id, quantile_disc(CAST(gmv_generated AS DOUBLE), 0.5) AS lower, -quantile_disc(-CAST(gmv_generated AS DOUBLE), 0.5) AS upper FROM v_order_items GROUP BY 1",
    ),
    "a10_stddev_pop": (
        lambda v: rounded(v.order_items.groupBy("account_id").agg(F.stddev_pop("item_quantity").alias("s"))),
        "SELECT account_id, round(stddev_pop(item_quantity), 6) AS s FROM v_order_items GROUP BY 1",
    ),
    "a11_exact_unique": (
        a11, "SELECT delivery_point_id, count(DISTINCT order_id) AS n, count(DISTINCT CASE WHEN order_item_status = 'COMPLETED' THEN order_id END) AS completed FROM v_order_items GROUP BY 1",
    ),
    "a11b_distinct_by_bitmaps": (
        a11b, f"SELECT delivery_point_id, count(DISTINCT order_id) AS n FROM v_order_items WHERE CAST(generated_at AS DATE) BETWEEN {DS} - 13 AND {DS} GROUP BY 1",
    ),
    "a12_ring_window_grid": (
        a12,
        f"SELECT {cell('q + dq', 'r + dr')} AS h3_index, "
        + ", ".join(f"CAST(coalesce(sum(CASE WHEN ring <= {r} AND date_diff('day', day, {DS}) < {w} THEN daily_views END), 0) AS BIGINT) AS v{w}_r{r}" for w in (10, 20) for r in (0, 1, 2))
        + " FROM v_hex_activity CROSS JOIN v_off WHERE ring <= 2 GROUP BY 1",
    ),
    "a13_min_with_default": (
        a13, "SELECT account_id, coalesce(min(CASE WHEN delivery_type = 'COURIER' THEN CAST(item_quantity AS DOUBLE) END), 10000) AS least FROM v_order_items GROUP BY 1",
    ),
    "a14_any_value": (
        lambda v: v.order_items.groupBy("city_id").agg(F.min("region_id").alias("region_id")), "SELECT city_id, min(region_id) AS region_id FROM v_order_items GROUP BY 1",
    ),
    "a15_distinct_array": (a15, "SELECT shop_id, list_sort(list(DISTINCT category_id)) AS categories FROM v_sku GROUP BY 1"),
    "a16_top_n_array": (
        a16,
        """SELECT account_id, list(sku_id ORDER BY rn) AS top FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY q DESC, sku_id) AS rn FROM
  (SELECT account_id, sku_id, sum(item_quantity) AS q FROM v_order_items GROUP BY 1, 2) x) y WHERE rn <= 3 GROUP BY 1""",
    ),
    "a17_distinct": (
        lambda v: v.sku.select("sku_group_id", "product_id").distinct(), "SELECT DISTINCT sku_group_id, product_id FROM v_sku",
    ),
    "a18_having": (a18, "SELECT query, count(DISTINCT install_id) AS n FROM v_clicks WHERE query IS NOT NULL GROUP BY 1 HAVING count(DISTINCT install_id) >= 20"),
    "a19_min_collapse": (
        lambda v: canonical.query_key_map(g.dictionary(v), "v1"), "SELECT query, query_id FROM o_qmap",
    ),
    "a20_recency": (
        a20,
        f"""SELECT sku_id, CAST(date_diff('day', max(CASE WHEN event_type = 'PRODUCT_IMPRESSION' THEN CAST(received_at AS DATE) END), {DS}) AS INTEGER) AS shown_ago,
  CAST(date_diff('day', max(CASE WHEN event_type = 'ADD_TO_CART' THEN CAST(received_at AS DATE) END), {DS}) AS INTEGER) AS cart_ago FROM v_clicks GROUP BY 1""",
    ),
    "a21_two_level_roll_up": (
        a21,
        """SELECT account_id, count(*) AS orders, CAST(sum(n) AS BIGINT) AS lines, CAST(max(u) AS BIGINT) AS most_units, CAST(max(t) AS DOUBLE) AS top FROM
  (SELECT account_id, order_id, count(*) AS n, sum(item_quantity) AS u, max(gmv_generated) AS t FROM v_order_items GROUP BY 1, 2) x GROUP BY 1""",
    ),
}

# --- table generators and re-aimed operators -----------------------------------------------------------

def u01(v):
    return v.sku.select(F.to_json(F.struct("id", "shop_id", "title")).alias("value")).select(
        F.get_json_object("value", "$.id").cast("bigint").alias("id"), F.get_json_object("value", "$.title").alias("title")
    )


def u02(v):
    return v.ranking_events.select("event_id", F.posexplode("ranking_candidates").alias("i", "c")).select(
        "event_id", "i", F.col("c").cast("bigint").alias("c")
    )


def u03(v):
    q = v.clickstream.where("query is not null").select("query").distinct()
    return q.select("query", text.canonical_query_key(F.col("query"), g.STOP_WORDS).alias("key"))


U03_SQL = """SELECT query, CASE WHEN clean = '' THEN NULL ELSE array_to_string(list_sort(string_split(clean, ' ')), ' ') END AS key FROM (
  SELECT query, trim(regexp_replace(regexp_replace(lower(query), '\\b(red widget|small|red)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS clean
  FROM (SELECT DISTINCT query FROM v_clicks WHERE query IS NOT NULL) x) y"""


def r01(v):
    """Cells of points moved off the cell centres."""
    lat, lon = F.col("latitude") + F.pmod("id", F.lit(7)) * 0.0003, F.col("longitude") - F.pmod("id", F.lit(5)) * 0.0004
    return v.delivery_points.select("id", hexgrid.cell_of(lat, lon).alias("cell9"), hexgrid.cell_of(lat, lon, 7).alias("cell7"))


_R01_P = f"SELECT id, {LAT('r')} + id % 7 * {dbl(0.0003)} AS la, {LON('q', 'r')} - id % 5 * {dbl(0.0004)} AS lo FROM v_points"
R01_SQL = f"WITH p AS ({_R01_P}), a AS ({cell_of_sql('p', 'la', 'lo', 9, 'cell9')}), b AS ({cell_of_sql('a', 'la', 'lo', 7, 'cell7')}) SELECT id, cell9, cell7 FROM b"


def r02(v):
    return scatter(v.demography.select("h3_index", F.col("h3_index").alias("source")), "h3_index", 5, "neighbour").groupBy("source", "ring").agg(_n())


def r04(v):
    p = v.delivery_points.withColumn("cell", hexgrid.cell_of(F.col("latitude"), F.col("longitude")))
    d = hexgrid.distance_m(F.col("latitude"), F.col("longitude"), F.lit(0.01), F.lit(0.02))
    return p.select("id", F.round(d, 3).alias("metres"))


def r05(v):
    names = v.sku.select("title").distinct()
    return names.select("title", text.canonical_query_key(F.col("title"), ["blue"]).alias("key"))


#: A stop list as it is kept: comments, blank lines, phrases.
STOP_LIST = """# colours
red
blue

small red
  SMALL
"""
SUFFIXES = ("ets", "et", "ed", "e")
SYNONYMS = (("wid", "gadg"), ("larg", "big"))


def r05b(v):
    """Title keys with a stop list read from a text, stems and synonyms."""
    path = fresh_dir(v.spark, "stop-list")
    v.spark.createDataFrame([(line,) for line in STOP_LIST.split("\n")], "value string").coalesce(1).write.text(path)
    stop = text.read_stop_list(v.spark, path)
    key = text.canonical_query_key(F.col("title"), stop, SUFFIXES, text.synonym_groups(SYNONYMS))
    return v.sku.select("title").distinct().select("title", key.alias("key"))


R05B_SQL = """SELECT title, nullif(array_to_string(list_sort(list_transform(string_split(clean, ' '), lambda t: CASE s(t) END)), ' '), '') AS key FROM (
  SELECT title, trim(regexp_replace(regexp_replace(lower(title), '\\b(small red|small|blue|red)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS clean
  FROM (SELECT DISTINCT title FROM v_sku) x) y""".replace(
    "CASE s(t) END",
    "coalesce(map {'wid': 'gadg', 'gadg': 'gadg', 'larg': 'big', 'big': 'big'}[regexp_replace(t, '^(.{3,}?)(ets|et|ed|e)$', '\\1')], regexp_replace(t, '^(.{3,}?)(ets|et|ed|e)$', '\\1'))",
)


def r06(v):
    scores = field_scores(silver.item_texts(v), silver.candidate_pairs(v), "sku_group_id", ["title"])
    return scores.select("query", "sku_group_id", "term", F.round("score", 6).alias("score"))


EXTRA = {**KERNEL_EXTRA, "o_relevance": silver.RELEVANCE_SQL}
R06_SQL = silver.RELEVANCE_SQL[: silver.RELEVANCE_SQL.index("g AS (SELECT query")].rstrip().rstrip(",") + (
    " SELECT query, sku_group_id, term, round(s, 6) AS score FROM sc WHERE field = 'title'"
)


def r07(v):
    return g.exported(v)


RE_AIMED = {
    "u01_row_message": (u01, "SELECT id, title FROM v_sku"),
    "u02_unnest": (
        u02, "SELECT event_id, CAST(i - 1 AS INTEGER) AS i, c FROM (SELECT event_id, unnest(ranking_candidates) AS c, generate_subscripts(ranking_candidates, 1) AS i FROM v_ranking) x",
    ),
    "u03_canonical_text": (u03, U03_SQL),
    "r01_hex_cell": (r01, R01_SQL),
    "r02_rings": (r02, "SELECT h3_index AS source, CAST(ring AS INTEGER) AS ring, count(*) AS n FROM v_demography CROSS JOIN v_off GROUP BY 1, 2"),
    "r03_parent_cell": (
        lambda v: v.demography.select("h3_index", hexgrid.parent_cell(F.col("h3_index"), 7).alias("parent")),
        f"WITH b AS (SELECT * FROM v_demography), p AS ({cell_of_sql('b', LAT('r'), LON('q', 'r'), 7, 'parent')}) SELECT h3_index, parent FROM p",
    ),
    "r04_distance": (
        r04,
        f"""SELECT id, round(2 * {dbl(hexgrid.EARTH_M)} * asin(least(sqrt(pow(sin((radians({dbl(0.01)}) - radians(la)) / 2), 2) + cos(radians(la)) * cos(radians({dbl(0.01)}))
  * pow(sin((radians({dbl(0.02)}) - radians(lo)) / 2), 2)), 1)), 3) AS metres FROM (SELECT id, {LAT('r')} AS la, {LON('q', 'r')} AS lo FROM v_points) x""",
    ),
    "r05b_canonical_forms": (r05b, R05B_SQL),
    "r05_canonical_titles": (
        r05,
        """SELECT title, CASE WHEN clean = '' THEN NULL ELSE array_to_string(list_sort(string_split(clean, ' ')), ' ') END AS key FROM (
  SELECT title, trim(regexp_replace(regexp_replace(lower(title), '\\bblue\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS clean FROM (SELECT DISTINCT title FROM v_sku) x) y""",
    ),
    "r06_bm25_terms": (r06, R06_SQL),
    "r07_message_vector": (r07, g.EXPORT_SQL),
}

# --- data quality ----------------------------------------------------------------------------------------

LINE_KEY = ("l_orderkey", "l_linenumber")
ON = date(2001, 11, 3)
ON_SQL = "DATE '2001-11-03'"
_SHIP = "CAST(l_shipdate AS DATE)"


def _check(entry: dict, scope: str = "table"):
    def build(v: StarViews):
        df = v.table("lineitem").withColumn("date", F.to_date("l_shipdate"))
        settings = DqSettings(LINE_KEY, (make_spec(entry),), scope=scope)
        refs = {"orders": v.table("orders"), "part": v.table("part"), "lineitem": df}
        return check_frame(df, settings, ON, refs)

    return build


def _row_sql(key: str, cond: str) -> str:
    return f"SELECT '{key}' AS test_key, count(*) AS failed_rows, CAST(count(*) AS DOUBLE) AS observed FROM lineitem WHERE {cond}"


def _dup_sql(key: str, cols: str) -> str:
    return f"SELECT '{key}' AS test_key, count(*) AS failed_rows, CAST(count(*) AS DOUBLE) AS observed FROM (SELECT {cols} FROM lineitem GROUP BY {cols} HAVING count(*) > 1) d"


_GROWTH = f"""SELECT 'row_count_growth' AS test_key, CAST(CASE WHEN p = 0 THEN -1 WHEN c > p * 1.2 OR c < p * 0.8 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows,
  CASE WHEN p = 0 THEN NULL ELSE CAST(c AS DOUBLE) / p - 1 END AS observed FROM (SELECT count(*) FILTER (WHERE {_SHIP} = {ON_SQL}) AS c, count(*) FILTER (WHERE {_SHIP} = {ON_SQL} - 1) AS p FROM lineitem) x"""

QUALITY = {
    "d01_primary_key_not_null": (_check({"name": "primary_key_not_null"}), _row_sql("primary_key_not_null", "l_orderkey IS NULL OR l_linenumber IS NULL")),
    "d02_primary_key_unique": (_check({"name": "primary_key_unique"}), _dup_sql("primary_key_unique", "l_orderkey, l_linenumber")),
    "d03_row_count_min": (
        _check({"name": "row_count_min", "min_rows": 1000}),
        "SELECT 'row_count_min' AS test_key, CAST(CASE WHEN count(*) <= 1000 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows, CAST(count(*) AS DOUBLE) AS observed FROM lineitem",
    ),
    "d04_row_count_growth": (_check({"name": "row_count_growth"}), _GROWTH),
    "d05_freshness": (
        _check({"name": "freshness"}),
        f"SELECT 'freshness' AS test_key, CAST(CASE WHEN date_diff('day', max({_SHIP}), {ON_SQL}) > 2 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows, CAST(date_diff('day', max({_SHIP}), {ON_SQL}) AS DOUBLE) AS observed FROM lineitem",
    ),
    "d06_not_null": (_check({"name": "not_null", "columns": ["l_partkey", "l_tax"]}), _row_sql("not_null[l_partkey,l_tax]", "l_partkey IS NULL OR l_tax IS NULL")),
    "d07_null_share_below": (
        _check({"name": "null_share_below", "column": "l_tax", "max_share": 0.1}),
        """SELECT 'null_share_below[l_tax]' AS test_key, CAST(CASE WHEN s > 0.1 THEN b ELSE 0 END AS BIGINT) AS failed_rows, s AS observed FROM
  (SELECT count(*) FILTER (WHERE l_tax IS NULL) AS b, CAST(count(*) FILTER (WHERE l_tax IS NULL) AS DOUBLE) / count(*) AS s FROM lineitem) x""",
    ),
    "d08_unique_combination": (
        _check({"name": "unique_combination", "columns": ["l_partkey", "l_shipdate"]}), _dup_sql("unique_combination[l_partkey,l_shipdate]", "l_partkey, l_shipdate"),
    ),
    "d09_accepted_values": (
        _check({"name": "accepted_values", "column": "l_returnflag", "values": ["R", "A"]}), _row_sql("accepted_values[l_returnflag]", "l_returnflag IS NOT NULL AND l_returnflag NOT IN ('R', 'A')"),
    ),
    "d10_not_accepted_values": (
        _check({"name": "not_accepted_values", "column": "l_returnflag", "values": ["N"]}), _row_sql("not_accepted_values[l_returnflag]", "l_returnflag IN ('N')"),
    ),
    "d11_accepted_range": (
        _check({"name": "accepted_range", "column": "l_discount", "min": 0.0, "max": 0.1, "min_inclusive": False, "max_inclusive": False}),
        _row_sql("accepted_range[l_discount]", "l_discount <= 0.0 OR l_discount >= 0.1"),
    ),
    "d12_non_negative": (_check({"name": "non_negative", "columns": ["l_tax", "l_discount"]}), _row_sql("non_negative[l_tax,l_discount]", "l_tax < 0 OR l_discount < 0")),
    "d13_string_not_blank": (
        _check({"name": "string_not_blank", "columns": ["l_returnflag"]}), _row_sql("string_not_blank[l_returnflag]", "l_returnflag IS NULL OR trim(l_returnflag) = ''"),
    ),
    "d14_distinct_count_between": (
        _check({"name": "distinct_count_between", "columns": ["l_returnflag", "l_linestatus"], "min": 7, "max": 10}),
        """SELECT 'distinct_count_between[l_returnflag,l_linestatus]' AS test_key, CAST(CASE WHEN n < 7 OR n > 10 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows, CAST(n AS DOUBLE) AS observed
FROM (SELECT count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem) d) x""",
    ),
    "d15_columns_sum_equals": (
        _check({"name": "columns_sum_equals", "parts": ["l_tax", "l_discount"], "total": "l_tax", "tolerance": 0.05}),
        _row_sql("columns_sum_equals[l_tax]", "abs((l_tax + l_discount) - l_tax) > CAST('0.05' AS DOUBLE)"),
    ),
    "d16_row_count_matches_reference": (
        _check({"name": "row_count_matches_reference", "reference_table": "lineitem", "reference_date_column": "date", "reference_where": "l_linestatus = 'F'", "tolerance_ratio": 0.1}, "partition"),
        f"""SELECT 'row_count_matches_reference[lineitem]' AS test_key, CAST(CASE WHEN m = 0 THEN -1 WHEN abs(CAST(n AS DOUBLE) / m - 1) > 0.1 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows,
  CASE WHEN m = 0 THEN NULL ELSE CAST(n AS DOUBLE) / m - 1 END AS observed FROM (SELECT count(*) AS n, count(*) FILTER (WHERE l_linestatus = 'F') AS m FROM lineitem WHERE {_SHIP} = {ON_SQL}) x""",
    ),
    "d17_expression_is_true": (
        _check({"name": "expression_is_true", "expression": "l_quantity > 10"}), _row_sql("expression_is_true[l_quantity > 10]", "(l_quantity > 10) IS DISTINCT FROM TRUE"),
    ),
    "d18_relationships": (
        _check({"name": "relationships", "column": "l_partkey", "to_table": "part", "to_column": "p_partkey", "where": "p_size > 25"}),
        _row_sql("relationships[l_partkey]", "l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25)"),
    ),
}


def _quality_run(v: StarViews):
    """All tests of a table in one pass, as result rows."""
    tests = [
        {"name": "accepted_values", "column": "l_returnflag", "values": ["R", "A"], "severity": "warn"},
        {"name": "non_negative", "columns": ["l_tax"]},
        {"name": "relationships", "column": "l_orderkey", "to_table": "orders", "to_column": "o_orderkey"},
    ]
    df = v.table("lineitem").withColumn("date", F.to_date("l_shipdate"))
    settings = load_settings(LINE_KEY, {"scope": "table", "tests": tests})
    outcome = run_checks(df, settings, ON, {"orders": v.table("orders")})
    return result_rows(v.spark, outcome, ON, "lineitem", "nightly", "run-1", datetime(2001, 11, 4))


def d19(v):
    return _quality_run(v).select("test_name", "status", "severity", "failed_rows")


D19_SQL = f"""
SELECT 'primary_key_not_null' AS test_name, 'passed' AS status, 'error' AS severity, CAST(0 AS BIGINT) AS failed_rows
UNION ALL SELECT 'primary_key_unique', CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END, 'error', n FROM (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d) x
UNION ALL SELECT 'row_count_min', 'passed', 'error', 0
UNION ALL SELECT test_key, CASE WHEN failed_rows > 0 THEN 'failed' WHEN failed_rows < 0 THEN 'skipped' ELSE 'passed' END, 'error', greatest(failed_rows, 0) FROM ({_GROWTH}) y
UNION ALL SELECT 'freshness', 'passed', 'error', 0
UNION ALL SELECT 'accepted_values', CASE WHEN n > 0 THEN 'warned' ELSE 'passed' END, 'warn', n FROM (SELECT count(*) AS n FROM lineitem WHERE l_returnflag NOT IN ('R', 'A')) z
UNION ALL SELECT 'non_negative', 'passed', 'error', 0 UNION ALL SELECT 'relationships', 'passed', 'error', 0"""


def d20(v):
    """Result rows of two jobs; writing one job again replaces only its own rows."""
    path = fresh_dir(v.spark, "d20")
    found = _quality_run(v)
    save_results(found, path)
    save_results(found.withColumn("dag_id", F.lit("weekly")), path)
    save_results(found, path)
    return v.spark.read.parquet(path).groupBy("dag_id").agg(_n(), F.count_if(F.col("status") == "passed").alias("passed"))


def d05b(v):
    """Freshness and known days of a stored table, from its folders."""
    path = fresh_dir(v.spark, "dated")
    v.table("events").select("event_id", F.to_date("ts").alias("date")).repartition("date").write.partitionBy("date").parquet(path)
    days = partition_days(v.spark, path)
    settings = DqSettings(("event_id",), (make_spec({"name": "freshness"}),))
    checked = check_frame(v.spark.read.parquet(path), settings, D, dates=days)
    span = days.agg(F.struct(F.count("date").alias("n_days"), F.min("date").alias("first_day")).alias("span"))
    return checked.withColumn("span", span.scalar()).select("test_key", "failed_rows", "observed", "span.*")


QUALITY["d05b_freshness_by_listing"] = (
    d05b,
    f"""SELECT 'freshness' AS test_key, CAST(CASE WHEN lag > 2 THEN 1 ELSE 0 END AS BIGINT) AS failed_rows, CAST(lag AS DOUBLE) AS observed, n_days, first_day
FROM (SELECT date_diff('day', max(d), {DS}) AS lag, count(DISTINCT d) AS n_days, min(d) AS first_day FROM (SELECT CAST(ts AS DATE) AS d FROM events) e) x""",
)
QUALITY["d19_runner"] = (d19, D19_SQL)
QUALITY["d20_result_history"] = (
    d20, f"SELECT dag_id, count(*) AS n, count(*) FILTER (WHERE status = 'passed') AS passed FROM ({D19_SQL}) q CROSS JOIN (VALUES ('nightly'), ('weekly')) j(dag_id) GROUP BY 1",
)


_LONG = "l_quantity + l_extendedprice + l_discount + l_tax"


def d19_shared(v):
    """Tests that share a label: two ranges on one column, two expressions alike for 40 characters and more."""
    tests = [
        {"name": "accepted_range", "column": "l_quantity", "min": 40}, {"name": "accepted_range", "column": "l_quantity", "max": 1000},
        {"name": "expression_is_true", "expression": f"{_LONG} > 20000"}, {"name": "expression_is_true", "expression": f"{_LONG} > -1"},
    ]
    df = v.table("lineitem").withColumn("date", F.to_date("l_shipdate"))
    outcome = run_checks(df, DqSettings(LINE_KEY, tuple(make_spec(t) for t in tests), scope="table"), ON)
    rows = [(i, r.spec.key, r.status, r.failed_rows) for i, r in enumerate(outcome.results)]
    return v.spark.createDataFrame(rows, "test int, test_key string, status string, failed_rows bigint")


_COUNTED = ("l_quantity < 40", "l_quantity > 1000", f"({_LONG} > 20000) IS DISTINCT FROM TRUE", f"({_LONG} > -1) IS DISTINCT FROM TRUE")
_LABELS = ("accepted_range[l_quantity]", "accepted_range[l_quantity]", f"expression_is_true[{_LONG} > 20000]", f"expression_is_true[{_LONG} > -1]")
QUALITY["d19_runner_shared_labels"] = (
    d19_shared,
    " UNION ALL ".join(
        f"SELECT {i} AS test, '{label}' AS test_key, CASE WHEN n > 0 THEN 'failed' ELSE 'passed' END AS status, n AS failed_rows FROM (SELECT count(*) AS n FROM lineitem WHERE {bad}) x{i}"
        for i, (label, bad) in enumerate(zip(_LABELS, _COUNTED, strict=True))
    ),
)
