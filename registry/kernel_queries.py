"""Registered kernels, joins, aggregations, windows and lists."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featuremill.export.features import FeatureGroup, export_frame
from featuremill.functions import dates, ratios, text
from featuremill.functions.dates import Bound
from featuremill.operators import attribution, outcomes, rows
from featuremill.plans import accounts
from featuremill.plans import item_gold as gold
from featuremill.plans import item_silver as items
from featuremill.plans import search_gold as search
from featuremill.plans import search_silver
from featuremill.sources import scan, schema, sink, versions
from registry import account_sql
from registry import gold_queries as g
from registry import silver_queries as silver
from registry.geo_sql import dbl
from registry.silver_queries import CAUSES, rounded
from registry.workspace import fresh_dir

D = silver.D
DS = "DATE '2024-01-31'"


def _n():
    return F.count(F.lit(1)).alias("n")


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- scans and sinks ------------------------------------------------------------------------

def k02(v):
    return _union(
        scan.trailing(v.sku_eod, D, 7, b, "dt").groupBy("dt").agg(_n()).select(F.lit(b.name).alias("bound"), "dt", "n")
        for b in Bound
    )


K02_SQL = " UNION ALL ".join(
    f"SELECT '{b}' AS bound, dt, count(*) AS n FROM v_sku_eod WHERE {c} GROUP BY dt"
    for b, c in (
        ("HALF_OPEN", f"dt >= {DS} - 7 AND dt < {DS}"), ("CLOSED", f"dt >= {DS} - 7 AND dt <= {DS}"), ("UP_TO", f"dt > {DS} - 7 AND dt <= {DS}"),
    )
)


def k08(v):
    parts = v.table("events").select("user_id", "event_id", F.to_date("ts").alias("run_id"))
    return scan.latest_run(parts, ["user_id"])


def k09(v):
    path = fresh_dir(v.spark, "k09")
    v.table("customer").select("c_custkey", "c_mktsegment").write.option("compression", "gzip").json(path)
    lines = scan.json_lines(v.spark, path, "c_custkey bigint, c_mktsegment string")
    return lines.groupBy("c_mktsegment").agg(
        _n(), F.sum("c_custkey").alias("keys"), F.max(F.col("source_file").endswith(".json.gz").cast("int")).alias("gz")
    )


def k10(v):
    cols = ["sku_id", "promotion_id", "created_at"]
    both = scan.live_and_history(v.dynamic_discount, silver.discounts(v), g.NOW, g.HISTORY_DAYS, cols)
    return both.groupBy("promotion_id").agg(_n(), F.max("created_at").alias("last"))


def k11(v):
    path = fresh_dir(v.spark, "k11")
    sink.overwrite_partitions(silver.stock(v), path)
    one = scan.partition(v.spark.read.parquet(path), D).withColumn("total_stock", F.col("total_stock") + 1)
    sink.overwrite_partitions(one, path)
    return v.spark.read.parquet(path).groupBy("date").agg(_n(), F.sum("total_stock").alias("total"))


def k11b(v):
    """As k11, published by manifest: all days, then the newest once more."""
    path, stock = fresh_dir(v.spark, "k11b"), silver.stock(v)
    lo, hi = stock.agg(F.min("date"), F.max("date")).first()
    filled = v.stage(stock)
    days = sorted(r[0] for r in filled.select("date").distinct().collect())
    for on in days if (hi - lo).days + 1 != len(days) else [None]:
        versions.publish_version(filled if on is None else scan.partition(filled, on), path, on or lo, None if on else hi + timedelta(days=1))
    one = scan.partition(versions.read_version(v.spark, path, filled.schema), D).withColumn("total_stock", F.col("total_stock") + 1)
    versions.publish_version(one, path, D)
    return versions.read_version(v.spark, path, filled.schema).groupBy("date").agg(_n(), F.sum("total_stock").alias("total"))


def k12(v):
    path = fresh_dir(v.spark, "k12")
    keys = ("calculated_at", "promotion_id")
    prices = g.prices_now(v).select("sku_id", "promotion_id", "discount", F.date_format("calculated_at", "yyyyMMddHHmm").alias("calculated_at"))
    sink.overwrite_partitions(prices, path, keys)
    again = prices.where("promotion_id = 'dyno_pricing_1'").withColumn("discount", F.lit(0.0))
    sink.overwrite_partitions(again, path, keys)
    return v.spark.read.parquet(path).groupBy("promotion_id").agg(_n(), F.count_if(F.col("discount") > 0).alias("discounted"))


def k13(v):
    path = fresh_dir(v.spark, "k13")
    seg = v.table("customer").select("c_mktsegment", "c_nationkey").distinct()
    sink.append(seg.where("c_nationkey < 12"), path)
    # Only the keys that are not stored yet are added.
    sink.append_new_keys(seg, v.spark.read.parquet(path), ["c_mktsegment", "c_nationkey"], path)
    return v.spark.read.parquet(path).groupBy("c_mktsegment").agg(_n(), F.countDistinct("c_nationkey").alias("keys"))


def k14(v):
    path, staging = fresh_dir(v.spark, "k14"), fresh_dir(v.spark, "k14-staging")
    sink.guarded_overwrite(g.stock_features(v), path, D, staging, ["sku_group_id"])
    return v.spark.read.parquet(path).select("date", "sku_group_id", "skg_total_stock_90")


def k15(v):
    target = "date date, sku_id bigint, total_stock double, retired_total double, note string"
    frame = schema.align_to_schema(
        silver.stock(v).withColumn("retired_total", F.lit(1.0)), _ddl(v, target), retired=["retired_total"]
    )
    return frame.groupBy("date").agg(F.sum("total_stock").alias("total"), F.count("note").alias("notes"), F.count("retired_total").alias("retired"))


def _ddl(v, ddl: str):
    return v.spark.createDataFrame([], ddl).schema


def k16(v):
    copied = schema.cast_copy(v.ad_funnel, _ddl(v, "date date, sku_group_id bigint, impressions double"))
    return copied.groupBy("date").agg(_n(), F.sum("impressions").alias("impressions"), F.count("sku_group_id").alias("ids"))


def k17(v):
    changes = [
        schema.AddColumn("note", "string"), schema.AddColumn("s_name", "string"),
        schema.RenameColumn("s_acctbal", "balance"), schema.RenameColumn("missing", "x"),
        schema.RenameColumn("s_nationkey", "nation", unless_type="int"),
    ]
    once = schema.evolve_schema(v.table("supplier"), changes)
    return schema.evolve_schema(once, changes).select("s_suppkey", "s_nationkey", "balance", "note")


PAIR_GROUP = FeatureGroup(
    "fs_pairs", "pair_features_v1", ("date", "query", "sku_group_id"), ("query_skg_conv_imp2atc_90", "query_skg_uniq_atcs_90")
)


def k18(v):
    pairs = search.pair_features_v1(silver.funnel(v), silver.query_orders(v), D)
    f = F.col("features")
    return export_frame(pairs, PAIR_GROUP, D).select("key", f[0].alias("f1"), f[1].alias("f2"))


SCANS = {
    "k01_partition_scan": (
        lambda v: scan.partition(v.sku_eod, D, "dt").groupBy("sku_id").agg(F.sum("quantity_active_eod").cast("bigint").alias("qty")),
        f"SELECT sku_id, CAST(sum(quantity_active_eod) AS BIGINT) AS qty FROM v_sku_eod WHERE dt = {DS} GROUP BY sku_id",
    ),
    "k02_trailing_scan": (k02, K02_SQL),
    "k03_instant_scan": (
        lambda v: scan.instants(v.clickstream, datetime(2024, 1, 3), datetime(2024, 1, 20, 12), "received_at").groupBy("event_type").agg(_n()),
        "SELECT event_type, count(*) AS n FROM v_clicks WHERE received_at >= TIMESTAMP '2024-01-03' AND received_at < TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1",
    ),
    "k04_received_scan": (
        lambda v: scan.received_on(v.clickstream, date(2024, 1, 17)).groupBy("platform").agg(_n()),
        "SELECT platform, count(*) AS n FROM v_clicks WHERE received_at >= TIMESTAMP '2024-01-17' AND received_at < TIMESTAMP '2024-01-18'"
        " AND logged_at >= TIMESTAMP '2024-01-14' AND logged_at < TIMESTAMP '2024-01-21' GROUP BY 1",
    ),
    "k05_checked_parquet": (
        lambda v: scan.existing_parquet(v.spark, f"{v.sf_dir}/part.parquet").groupBy("p_type").agg(_n()),
        "SELECT p_type, count(*) AS n FROM part GROUP BY 1",
    ),
    "k06_latest_snapshot": (
        lambda v: scan.latest_snapshot(v.client_locations, "report_date", date(2024, 1, 25)).groupBy("report_date", "h3_index").agg(_n()),
        "SELECT report_date, h3_index, count(*) AS n FROM v_locations WHERE report_date = (SELECT max(report_date) FROM v_locations WHERE report_date <= DATE '2024-01-25') GROUP BY 1, 2",
    ),
    "k07_latest_timestamp": (
        lambda v: scan.latest_snapshot(v.dynamic_discount, "created_at").select("sku_id", "promotion_id", "created_at"),
        "SELECT sku_id, promotion_id, created_at FROM v_discount WHERE created_at = (SELECT max(created_at) FROM v_discount)",
    ),
    "k08_latest_run": (
        k08,
        "SELECT user_id, event_id, CAST(ts AS DATE) AS run_id FROM events e WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events x WHERE x.user_id = e.user_id)",
    ),
    "k09_json_lines": (k09, "SELECT c_mktsegment, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys, 1 AS gz FROM customer GROUP BY 1"),
    "k10_live_and_history": (
        k10,
        """SELECT promotion_id, count(*) AS n, max(created_at) AS last FROM (SELECT promotion_id, created_at FROM v_discount WHERE created_at >= TIMESTAMP '2024-01-30 18:00:00'
  UNION ALL SELECT promotion_id, created_at FROM o_discounts WHERE date > DATE '2024-01-29') u GROUP BY 1""",
    ),
    "k11_overwrite_partitions": (
        k11, f"SELECT date, count(*) AS n, CAST(sum(total_stock + CASE WHEN date = {DS} THEN 1 ELSE 0 END) AS BIGINT) AS total FROM o_stock GROUP BY 1",
    ),
    "k11b_manifest_publication": (
        k11b, f"SELECT date, count(*) AS n, CAST(sum(total_stock + CASE WHEN date = {DS} THEN 1 ELSE 0 END) AS BIGINT) AS total FROM o_stock GROUP BY 1",
    ),
    "k12_predicate_overwrite": (
        k12,
        "SELECT promotion_id, count(*) AS n, count(*) FILTER (WHERE discount > 0 AND promotion_id <> 'dyno_pricing_1') AS discounted FROM o_disc_prices GROUP BY 1",
    ),
    "k13_append_new_keys": (
        k13, "SELECT c_mktsegment, count(DISTINCT c_nationkey) AS n, count(DISTINCT c_nationkey) AS keys FROM customer GROUP BY 1",
    ),
    "k14_guarded_write": (k14, "SELECT date, sku_group_id, skg_total_stock_90 FROM o_stock_features"),
    "k15_align_schema": (
        k15, "SELECT date, CAST(sum(total_stock) AS DOUBLE) AS total, CAST(0 AS BIGINT) AS notes, CAST(0 AS BIGINT) AS retired FROM o_stock GROUP BY 1",
    ),
    "k16_cast_copy": (
        k16, "SELECT date, count(*) AS n, sum(CAST(impressions AS DOUBLE)) AS impressions, count(sku_group_id) AS ids FROM v_ad_funnel GROUP BY 1",
    ),
    "k17_evolve_schema": (k17, "SELECT s_suppkey, s_nationkey, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS note FROM supplier"),
    "k18_export_frame": (
        k18,
        "SELECT 'fs_pairs|' || query || '|' || sku_group_id AS key, coalesce(query_skg_conv_imp2atc_90, 0) AS f1, coalesce(query_skg_uniq_atcs_90, 0) AS f2 FROM o_pairs",
    ),
}

# --- projections and scalar kernels -----------------------------------------------------------

_K20 = lambda bound: lambda v: v.sku_eod.groupBy("sku_id").agg(
    *dates.trailing_sums({"quantity_active_eod": "q_{w}"}, g.W8, D, bound, "dt", "bigint")
)
_K20_SQL = lambda lo, hi: (
    f"SELECT sku_id, {g.sums({'quantity_active_eod': 'q_{w}'}, g.W8, lo, hi, 'BIGINT').replace('date ', 'dt ')} FROM v_sku_eod GROUP BY sku_id"
)
_AD_BY = lambda v: silver.ad_daily(v).groupBy("sku_group_id").agg(
    F.sum("ad_clicks").alias("c"), F.sum("ad_impressions").alias("i"), F.sum(F.when(F.col("date") < "2024-01-03", F.col("ad_clicks")).otherwise(0)).alias("early")
)
EXTRA = {
    **g.EXTRA,
    "o_ad_by": """SELECT sku_group_id, CAST(sum(ad_clicks) AS BIGINT) AS c, CAST(sum(ad_impressions) AS BIGINT) AS i,
  CAST(sum(CASE WHEN date < DATE '2024-01-03' THEN ad_clicks ELSE 0 END) AS BIGINT) AS early FROM o_ad GROUP BY 1""",
    "o_pairs": g.PAIR_V1_SQL,
    "o_shown": """SELECT session_id, product_id, count(*) AS n, min(logged_at) AS first_at FROM v_clicks WHERE event_type = 'PRODUCT_IMPRESSION'
  AND session_id IS NOT NULL AND product_id IS NOT NULL GROUP BY 1, 2""",
}


def k27(v):
    own = silver.funnel(v).groupBy("uniqs", "sku_group_id").agg(F.sum("sum_atc").alias("a"), F.sum("sum_impressions").alias("i"))
    full = rows.with_group_totals(own, ["sku_group_id"], {"ta": F.sum("a"), "ti": F.sum("i")})
    return rounded(full.select("uniqs", "sku_group_id", ratios.parent_smoothed("a", "i", ratios.ratio("ta", "ti"), 100.0).alias("rate")), 9)


def k28(v):
    per = v.feedback.groupBy("product_id").agg(_n(), F.avg("rating").alias("r"))
    overall = v.feedback.select(ratios.ratio(F.sum("rating"), F.count("rating"))).scalar()
    return rounded(per.select("product_id", ratios.shrunk_rate("r", "n", overall, 30).alias("shrunk")), 9)


def k29(v):
    return silver.ad_daily(v).groupBy("sku_group_id").agg(
        *dates.trailing_sums({"ad_clicks": "c_{w}", "ad_impressions": "i_{w}"}, (7, 14, 30), D, Bound.HALF_OPEN)
    ).select(
        "sku_group_id",
        *[ratios.ratio(ratios.ratio(f"c_{a}", f"i_{a}"), ratios.ratio(f"c_{b}", f"i_{b}")).alias(f"r_{a}_to_{b}") for a, b in ((14, 7), (30, 14))],
    )


def k30(v):
    own = v.order_items.groupBy("city_id", "delivery_type").agg(F.sum("item_quantity").alias("q"))
    return rows.with_group_totals(own, ["city_id"], {"t": F.sum("q")}).select("city_id", "delivery_type", ratios.ratio("q", "t").alias("share"))


def k32(v):
    flags = accounts.item_outcomes(v.history_order_items, D)
    names = [c for c in flags.columns if c.startswith("is_")]
    return flags.groupBy("return_cause").agg(*[F.count_if(c).alias(c) for c in names])


def k33(v):
    size = F.when(F.col("dimensional_group").isin(*items.SIZE_GROUPS), F.col("dimensional_group")).otherwise("SMALL")
    cost = F.coalesce(F.nanvl("forward_cost", F.lit(0.0)), F.lit(0.0))
    sku = v.sku.select(F.col("id").alias("sku_id"), size.alias("size"))
    placed = v.order_items.select("order_item_id", "sku_id").join(sku, "sku_id")
    return v.costs.select("order_item_id", cost.alias("fwd")).join(placed, "order_item_id").groupBy("size").agg(_n(), F.sum("fwd").alias("fwd"))


def k36(v):
    pairs = search._pair_sums(silver.funnel(v), silver.query_orders(v), D, smooth=False)
    return pairs.where("in_funnel").where(text.has_text(F.col("query")) & search._dense_enough()).select("query", "sku_group_id", "imp_14", "atc_90", "ord_90")


def k37(v):
    raw = v.costs.select("order_item_id", "forward_cost", "reverse_cost", F.lit(None).cast("string").alias("note"), F.lit(None).cast("double").alias("far"))
    filled = schema.fill_by_type(raw, named={"far": 10000.0}, skip=("order_item_id",))
    return filled.groupBy("far").agg(_n(), F.sum("forward_cost").alias("f"), F.count("note").alias("notes"))


KERNELS = {
    "k20a_trailing_closed": (_K20(Bound.CLOSED), _K20_SQL(*g.CLOSED)),
    "k20b_trailing_half_open": (_K20(Bound.HALF_OPEN), _K20_SQL(*g.HALF)),
    "k20c_trailing_up_to": (_K20(Bound.UP_TO), _K20_SQL(*g.UP_TO)),
    "k21_null_ratio": (lambda v: _AD_BY(v).select("sku_group_id", ratios.ratio("c", "early").alias("r")), "SELECT sku_group_id, c / nullif(early, 0) AS r FROM o_ad_by"),
    "k22_zero_ratio": (lambda v: _AD_BY(v).select("sku_group_id", ratios.ratio_or_zero("c", "early").alias("r")), "SELECT sku_group_id, coalesce(c / nullif(early, 0), 0) AS r FROM o_ad_by"),
    "k23_null_or_zero_ratio": (
        lambda v: _AD_BY(v).select("sku_group_id", ratios.ratio("i", F.nullif(F.col("early"), F.lit(1))).alias("r")),
        "SELECT sku_group_id, i / nullif(nullif(early, 1), 0) AS r FROM o_ad_by",
    ),
    "k24_eps_ratio": (
        lambda v: _AD_BY(v).select("sku_group_id", ratios.ratio_eps("c", "early").alias("r")),
        "SELECT sku_group_id, CAST(c AS DOUBLE) / (CAST(early AS DOUBLE) + CAST('1e-05' AS DOUBLE)) AS r FROM o_ad_by",
    ),
    "k25_beta_smoothing": (
        lambda v: _AD_BY(v).select("sku_group_id", ratios.beta_smoothed("c", "i", search.PRIOR_ALPHA, search.PRIOR_BETA).alias("r")),
        f"SELECT sku_group_id, ({g._ALPHA} + c) / ({dbl(search.PRIOR_ALPHA + search.PRIOR_BETA)} + i) AS r FROM o_ad_by",
    ),
    "k26_prior_mean_smoothing": (
        lambda v: _AD_BY(v).select("sku_group_id", ratios.prior_mean_smoothed("c", "i", gold.AD_PRIOR_MEAN, gold.AD_PRIOR_IMPRESSIONS).alias("r")),
        f"SELECT sku_group_id, ({dbl(gold.AD_PRIOR_MEAN * gold.AD_PRIOR_IMPRESSIONS)} + c) / (CAST(50 AS DOUBLE) + i) AS r FROM o_ad_by",
    ),
    "k27_parent_smoothing": (
        k27,
        """WITH o AS (SELECT uniqs, sku_group_id, sum(sum_atc) AS a, sum(sum_impressions) AS i FROM o_funnel GROUP BY 1, 2), t AS (SELECT sku_group_id, sum(a) AS ta, sum(i) AS ti FROM o GROUP BY 1)
SELECT uniqs, sku_group_id, round((CAST(a AS DOUBLE) + 100 * (CAST(ta AS DOUBLE) / nullif(ti, 0))) / (CAST(i AS DOUBLE) + 100), 9) AS rate FROM o JOIN t USING (sku_group_id)""",
    ),
    "k28_hierarchical_shrinkage": (
        k28,
        """SELECT product_id, round((g.a * 30 + avg(CAST(rating AS DOUBLE)) * count(*)) / (30 + count(*)), 9) AS shrunk FROM v_feedback
CROSS JOIN (SELECT CAST(sum(rating) AS DOUBLE) / count(rating) AS a FROM v_feedback) g GROUP BY product_id, g.a""",
    ),
    "k29_window_ratios": (
        k29,
        f"""SELECT sku_group_id, {', '.join(f'{g.div(g.div(f"c{a}", f"i{a}"), g.div(f"c{b}", f"i{b}"))} AS r_{a}_to_{b}' for a, b in ((14, 7), (30, 14)))}
FROM (SELECT sku_group_id, {g.sums({'ad_clicks': 'c{w}', 'ad_impressions': 'i{w}'}, (7, 14, 30), *g.HALF)} FROM o_ad GROUP BY 1) x""",
    ),
    "k30_share_of_total": (
        k30,
        """SELECT city_id, delivery_type, CAST(q AS DOUBLE) / sum(q) OVER (PARTITION BY city_id) AS share FROM
  (SELECT city_id, delivery_type, sum(item_quantity) AS q FROM v_order_items GROUP BY 1, 2) x""",
    ),
    "k31_category_fallback": (
        lambda v: v.category.select("id", F.coalesce(*[F.when(F.col(f"l{i}_category") > 0, F.col(f"l{i}_category")) for i in (3, 2, 1)]).alias("l3")),
        "SELECT id, CASE WHEN l3_category > 0 THEN l3_category WHEN l2_category > 0 THEN l2_category ELSE l1_category END AS l3 FROM v_category",
    ),
    "k32_status_flags": (k32, account_sql.OUTCOME_COUNTS_SQL),
    "k33_domain_defaults": (
        k33,
        """SELECT CASE WHEN dimensional_group IN ('SMALL', 'MEDIUM', 'LARGE') THEN dimensional_group ELSE 'SMALL' END AS size, count(*) AS n,
  sum(CASE WHEN isnan(forward_cost) THEN 0 ELSE coalesce(forward_cost, 0) END) AS fwd FROM v_costs JOIN v_order_items USING (order_item_id) JOIN v_sku s ON s.id = sku_id GROUP BY 1""",
    ),
    "k34_not_in_drops_nulls": (
        lambda v: v.history_order_items.where(scan.not_in_keep_sql_nulls(F.col("return_cause"), items.FAIR_RETURN_CAUSES)).groupBy("return_cause").agg(_n()),
        f"SELECT return_cause, count(*) AS n FROM v_history WHERE return_cause NOT IN {CAUSES} GROUP BY 1",
    ),
    "k35_price_match": (
        lambda v: g.prices_now(v).groupBy("promotion_id").agg(_n(), F.count_if(F.col("discount") > 0).alias("applied"), F.count("calculated_for_price").alias("offered")),
        "SELECT promotion_id, count(*) AS n, count(*) FILTER (WHERE discount > 0) AS applied, count(calculated_for_price) AS offered FROM o_disc_prices GROUP BY 1",
    ),
    "k36_sparse_pairs": (
        k36,
        f"WITH {g._PEV.strip()}, {g._pair_frames('query', g._TEXT_EVENTS, 'po').strip()} SELECT query, sku_group_id, i14 AS imp_14, a90 AS atc_90, o90 AS ord_90 FROM pj WHERE {g._DENSE}",
    ),
    "k37_fill_by_type": (
        k37,
        "SELECT CAST(10000 AS DOUBLE) AS far, count(*) AS n, sum(CASE WHEN isnan(forward_cost) THEN 0 ELSE coalesce(forward_cost, 0) END) AS f, CAST(0 AS BIGINT) AS notes FROM v_costs",
    ),
    "k38_enum_map": (
        lambda v: gold.price_index_status(v.price_index, D).groupBy("price_index_status").agg(_n()),
        """SELECT CASE price_index_status WHEN 'CHEAPEST_AMONG_CLUSTER' THEN 0 WHEN 'CHEAPEST_AMONG_COMPETITORS' THEN 1
  WHEN 'CHEAPEST_AMONG_COMPETITORS_AND_CLUSTER' THEN 2 END AS price_index_status, count(*) AS n FROM v_price_index WHERE price_index_status <> 'NO_BOOST' GROUP BY 1""",
    ),
    "k39_log1p": (lambda v: v.sku.select("id", F.round(F.log1p(F.col("sell_price").cast("double")), 6).alias("l")), "SELECT id, round(ln(1 + CAST(sell_price AS DOUBLE)), 6) AS l FROM v_sku"),
}

# --- rows, windows, lists, sets -----------------------------------------------------------------

_LINE_ORDER = lambda: [F.col("l_shipdate").desc(), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]


def k40(v):
    return rows.first_row(v.table("lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER()).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"
    )


def k41(v):
    keys = ["l_orderkey", "l_linenumber"]
    return v.table("lineitem").groupBy(*keys).agg(
        _n(), F.min(F.struct("l_shipdate", "l_partkey", "l_suppkey")).alias("f")
    ).select(*keys, "n", F.col("f.l_shipdate").alias("first_ship"), F.col("f.l_partkey").alias("l_partkey"))


def k42(v):
    """Every customer's orders numbered by date; a customer's rows are cut by year."""
    o = v.table("orders")
    return rows.sliced_row_number(
        o.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], F.year("o_orderdate"),
        [F.col("o_orderdate"), F.col("o_orderkey")], "rank",
    ).select("o_custkey", "o_orderkey", F.col("rank").cast("bigint").alias("rank"))


def _sessions(v):
    return v.clickstream.where("session_id is not null and product_id is not null")


def w01(v):
    out = attribution.last_before(
        _sessions(v), ["session_id", "product_id"], "logged_at", "event_id",
        {"prev": lambda r: r["event_type"].isin("PRODUCT_IMPRESSION", "PRODUCT_VIEW")},
    )
    return out.where("row.event_type = 'PRODUCT_VIEW'").select(
        "event_id", F.col("prev.event_type").alias("prev_type"), F.col("prev.query").alias("prev_query"), F.col("prev.widget_space_name").alias("prev_space")
    )


def w02(v):
    out = attribution.last_before(
        _sessions(v), ["session_id", "product_id"], "logged_at", "event_id", {"prev": lambda r: F.lit(True)}
    )
    return out.select("event_id", F.when(F.col("prev").isNull(), F.lit("0")).otherwise(F.lower("prev.query")).alias("prev_query"))


def _resolved(v):
    o = accounts.order_outcomes(accounts.item_outcomes(v.history_order_items, D), D)
    return o.where("is_resolved").select("account_id", "order_id", "order_ts", "is_bad", "order_rate")


def w03(v):
    o = v.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    up = rows.sliced_row_number(o, ["o_custkey"], F.year("o_orderdate"), [F.col("o_orderdate"), F.col("o_orderkey")], "seq_asc")
    full = rows.with_group_totals(up, ["o_custkey"], {"n": F.count(F.lit(1))})
    # The backward number follows from the forward one and the count: no second window.
    return full.select("o_custkey", "o_orderkey", F.col("seq_asc").cast("bigint").alias("seq_asc"), (F.col("n") - F.col("seq_asc") + 1).cast("bigint").alias("seq_desc"), "n")


def w04(v):
    r = _resolved(v)
    last = rows.first_n(r, ["account_id"], [F.col("order_ts").desc(), F.col("order_id").desc()], 5, "seq")
    return rounded(last.groupBy("account_id").agg(
        *[F.avg(F.when(F.col("seq") <= k, F.col("order_rate"))).alias(f"last_{k}") for k in (3, 5)]
    ))


def w06(v):
    per = v.order_items.groupBy("city_id", "region_id").agg(F.sum("item_quantity").alias("q"))
    region = Window.partitionBy("region_id")  # one row per city here
    return per.select("city_id", "region_id", "q", F.sum("q").over(region).alias("region_q"))


def w07(v):
    per = v.sku.select("id", "category_id", F.col("sell_price").cast("double").alias("p"))
    return rows.with_group_totals(per, ["category_id"], {"m": ratios.stable_mean("p")}).select("id", "category_id", "m")


def w08(v):
    own = silver.funnel(v).groupBy("sku_group_id", "uniqs").agg(F.sum("sum_impressions").alias("i"))
    return rows.with_group_totals(own, ["uniqs"], {"t": F.sum("i")}).select("sku_group_id", "uniqs", ratios.ratio_or_zero("i", "t").alias("share"))


def l01(v):
    per = v.order_items.groupBy("city_id", "sku_id").agg(F.countDistinct("order_id").alias("orders"))
    return rows.top_list(per, ["city_id"], [F.col("orders").desc(), F.col("sku_id")], "sku_id", 200, "top_skus")


def l04(v):
    return v.history_order_items.groupBy("order_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("generated_at", "order_item_id"))), lambda s: s["order_item_id"]).alias("items")
    )


def s01(v):
    day = F.to_date("received_at").alias("date")
    one = lambda kind, col: v.clickstream.where(F.col("event_type") == kind).select(
        day, *[F.lit(int(c == col)).alias(c) for c in ("imps", "clicks", "carts")]
    )
    stacked = _union([one("PRODUCT_IMPRESSION", "imps"), one("PRODUCT_VIEW", "clicks"), one("ADD_TO_CART", "carts")])
    return stacked.groupBy("date").agg(*[F.sum(c).alias(c) for c in ("imps", "clicks", "carts")])


ROWS = {
    "k40_latest_row": (
        k40,
        """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) x WHERE rn = 1""",
    ),
    "k41_first_row_and_count": (
        k41,
        """SELECT l_orderkey, l_linenumber, n, l_shipdate AS first_ship, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM lineitem) x WHERE rn = 1""",
    ),
    "k42_rank_after_dedupe": (k42, "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rank FROM orders"),
    "w01_last_touch": (
        w01,
        """SELECT event_id, pt AS prev_type, pq AS prev_query, ps AS prev_space FROM (SELECT *, lag(event_type) OVER w AS pt, lag(query) OVER w AS pq, lag(widget_space_name) OVER w AS ps
  FROM v_clicks WHERE session_id IS NOT NULL AND product_id IS NOT NULL AND event_type IN ('PRODUCT_IMPRESSION', 'PRODUCT_VIEW')
  WINDOW w AS (PARTITION BY session_id, product_id ORDER BY logged_at, event_id)) x WHERE event_type = 'PRODUCT_VIEW'""",
    ),
    "w02_lag_with_default": (
        w02,
        "SELECT event_id, lag(lower(query), 1, '0') OVER (PARTITION BY session_id, product_id ORDER BY logged_at, event_id) AS prev_query FROM v_clicks WHERE session_id IS NOT NULL AND product_id IS NOT NULL",
    ),
    "w03_sequence_numbers": (
        w03,
        """SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq_asc,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS seq_desc, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""",
    ),
    "w04_last_n_means": (w04, account_sql.LAST_MEANS_SQL),
    "w05_current_streak": (
        lambda v: outcomes.current_streak(_resolved(v), ["account_id"], ["order_ts", "order_id"], "is_bad"),
        account_sql.STREAK_SQL,
    ),
    "w06_coarser_sums": (
        w06,
        """SELECT city_id, region_id, CAST(q AS BIGINT) AS q, CAST(sum(q) OVER (PARTITION BY region_id) AS BIGINT) AS region_q FROM
  (SELECT city_id, region_id, sum(item_quantity) AS q FROM v_order_items GROUP BY 1, 2) x""",
    ),
    "w07_group_mean": (w07, f"SELECT id, category_id, {g.mean('CAST(sell_price AS DOUBLE)', ' OVER (PARTITION BY category_id)')} AS m FROM v_sku"),
    "w08_share_of_sum": (
        w08,
        "SELECT sku_group_id, uniqs, coalesce(CAST(i AS DOUBLE) / nullif(sum(i) OVER (PARTITION BY uniqs), 0), 0) AS share FROM (SELECT sku_group_id, uniqs, sum(sum_impressions) AS i FROM o_funnel GROUP BY 1, 2) x",
    ),
    "l01_top_list": (
        l01,
        """SELECT city_id, list(sku_id ORDER BY rn) AS top_skus FROM (SELECT *, row_number() OVER (PARTITION BY city_id ORDER BY n DESC, sku_id) AS rn FROM
  (SELECT city_id, sku_id, count(DISTINCT order_id) AS n FROM v_order_items GROUP BY 1, 2) a) b WHERE rn <= 200 GROUP BY city_id""",
    ),
    "l02_ordered_distinct": (
        lambda v: gold.active_promotions(v.dynamic_discount, silver.discounts(v), g.NOW, g.HISTORY_DAYS),
        """SELECT DISTINCT promotion_id FROM (SELECT promotion_id FROM v_discount WHERE created_at >= TIMESTAMP '2024-01-30 18:00:00'
  UNION ALL SELECT promotion_id FROM o_discounts WHERE date > DATE '2024-01-29') u WHERE starts_with(promotion_id, 'dyno_pricing_') ORDER BY 1""",
    ),
    "l03_top_rows": (
        lambda v: v.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
    ),
    "l04_sorted_structs": (l04, "SELECT order_id, list(order_item_id ORDER BY generated_at, order_item_id) AS items FROM v_history GROUP BY 1"),
    "s01_stacked_streams": (
        s01,
        """SELECT CAST(received_at AS DATE) AS date, count(*) FILTER (WHERE event_type = 'PRODUCT_IMPRESSION') AS imps, count(*) FILTER (WHERE event_type = 'PRODUCT_VIEW') AS clicks,
  count(*) FILTER (WHERE event_type = 'ADD_TO_CART') AS carts FROM v_clicks WHERE event_type IN ('PRODUCT_IMPRESSION', 'PRODUCT_VIEW', 'ADD_TO_CART') GROUP BY 1""",
    ),
    "s02_union_distinct": (
        lambda v: v.order_items.select("account_id").unionByName(v.clickstream.select("account_id")).distinct(),
        "SELECT account_id FROM v_order_items UNION SELECT account_id FROM v_clicks",
    ),
    "s03_array_and_scalar_rows": (
        lambda v: search_silver.ranking_scores(v.ranking_events, datetime(2024, 1, 1), datetime(2024, 2, 1)).groupBy("query", "sku_group_id").agg(_n(), F.sum("score").alias("s")),
        f"WITH {silver._SCORES.strip()} SELECT query, sku_group_id, count(*) AS n, sum(score) AS s FROM scores GROUP BY 1, 2",
    ),
}
