"""Marketplace-shaped views over the star-schema tables.

The builders work on marketplace tables (order items, click stream, prices,
...). These views give the star schema that shape, using every row of the
tables. Dates of orders and shipments are folded into the half year that ends
at the anchor day, so that trailing windows meet data from all tables.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.functions import hexgrid
from featuremill.operators.rows import first_row
from featuremill.operators.staging import Stage, no_stage, tasks_for

ANCHOR = date(2024, 1, 31)

POI_NAMES = (
    "Банкоматы",
    "Банки",
    "Торговые точки",
    "Автосалоны, Автосервисы",
    "Смешанные товары",
    "Быстрое питание, Кофейни",
    "Пекарни",
)


class StarViews:
    """Lazy views over one directory of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, stage: Stage = no_stage) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.stage = stage

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def line_items(self) -> DataFrame:
        """One line item per (order, line number), with its order."""
        # Placed by order key, which serves both the de-duplication and the join.
        lines = self.table("lineitem").repartition("l_orderkey")
        unique = first_row(
            lines,
            ["l_orderkey", "l_linenumber"],
            [
                F.col("l_shipdate").desc(), F.col("l_partkey"), F.col("l_suppkey"),
                F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"),
                F.col("l_returnflag"), F.col("l_linestatus"),
            ],
        )
        return unique.join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def item_tasks(self) -> int:
        """Tasks for steps that hold rows of all order items."""
        return tasks_for(self.spark, self.table("lineitem").count())

    @staticmethod
    def order_instant() -> str:
        return (
            "cast('2023-08-05' as timestamp_ntz)"
            " + make_dt_interval(pmod(datediff(o_orderdate, date'1995-01-01'), 180))"
            " + make_dt_interval(0, 0, 0, pmod(o_orderkey * 7919, 86400))"
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """Order items, customer geography included."""
        geo = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("c_nationkey").cast("bigint").alias("city_id"),
                    F.col("n_regionkey").cast("bigint").alias("region_id"))
        )
        base = self.line_items.join(geo, F.col("o_custkey") == F.col("c_custkey"))
        with_time = base.withColumn("generated_at", F.expr(self.order_instant()))
        issue_days = "make_dt_interval(cast(l_partkey % 20 + 2 as int))"
        status = (
            "case when l_returnflag = 'R' then 'RETURNED' when l_linestatus = 'F' then 'COMPLETED'"
            " when l_returnflag = 'N' then 'CREATED' else 'ACTIVE' end"
        )
        money = "cast(l_extendedprice as decimal(18,2))"
        return with_time.selectExpr(
            "l_orderkey * 10 + l_linenumber as order_item_id",
            "l_orderkey as order_id",
            "o_custkey + 1 as account_id",
            "l_partkey as sku_id",
            "generated_at",
            "generated_at + make_dt_interval(0, cast(l_suppkey % 3 as int)) as purchased_at",
            f"case when l_linestatus = 'F' then generated_at + {issue_days} end as issued_at",
            "case when l_linestatus = 'F' or l_returnflag = 'R'"
            " then generated_at + make_dt_interval(cast(l_partkey % 10 + 1 as int)) end as delivered_at",
            "case when l_returnflag = 'R' then generated_at"
            " + make_dt_interval(cast(l_partkey % 20 + 2 + l_suppkey % 12 as int),"
            " 0, cast(l_suppkey % 2 * 30 as int)) end as returned_at",
            f"{status} as order_item_status",
            "cast(l_quantity as bigint) as item_quantity",
            "case when l_returnflag = 'R' then cast(l_quantity as bigint) else 0L end as returned_quantity",
            f"{money} as gmv_generated",
            f"case when {status} = 'COMPLETED' then {money} else cast(0 as decimal(18,2)) end as gmv_completed",
            f"case when l_returnflag = 'R' then {money} else cast(0 as decimal(18,2)) end as gmv_returned",
            "case when l_returnflag = 'R' and l_linestatus = 'O' then 'RETURNED NO SHOW'"
            " when l_returnflag = 'R' then if(l_linenumber % 2 = 0, 'RETURNED AFTER COMPLETED', 'RETURNED')"
            " when l_returnflag = 'A' and l_linestatus = 'O' then 'RETURNED BEFORE DELIVERY'"
            " when l_linestatus = 'F' then 'COMPLETED' else 'ACTIVE' end as real_order_item_status",
            "element_at(array('CANCELED', 'DEFECTED', 'BAD_QUALITY', 'OTHER', '', cast(null as string)),"
            " cast(l_suppkey % 6 + 1 as int)) as return_cause",
            "if(l_linenumber % 5 = 0, 'COURIER', 'PICKUP') as delivery_type",
            "case o_orderpriority when '1-URGENT' then 'PostPaid' when '2-HIGH' then 'Postpaid'"
            " when '3-MEDIUM' then 'Nasiya' else 'Card' end as payment_type",
            "city_id",
            "region_id",
            "l_suppkey + 1 as delivery_point_id",
        )

    @cached_property
    def history_order_items(self) -> DataFrame:
        """State of the order items at the anchor day."""
        return (
            self.order_items.where("order_item_status <> 'CREATED'")
            .join(self.sku.select(F.col("id").alias("sku_id"), "category_id"), "sku_id", "left")
            .withColumns({
                "analyze_date": F.lit(ANCHOR),
                "order_city_id": F.col("city_id"),
                "order_region_id": F.col("region_id"),
            })
        )

    @cached_property
    def sku(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey as id",
            "p_partkey % 400 + 1 as sku_group_id",
            "p_partkey % 700 + 1 as product_id",
            "cast(p_size as bigint) as category_id",
            "p_partkey % 50 + 1 as shop_id",
            "cast(regexp_extract(p_brand, '([0-9]+)', 1) as bigint) as brand_name_id",
            "if(p_type in ('SMALL', 'MEDIUM', 'LARGE'), p_type, 'UNKNOWN') as dimensional_group",
            "cast(p_retailprice as decimal(18,2)) as sell_price",
            "p_name as title",
            "p_type as type_title",
        )

    @cached_property
    def product(self) -> DataFrame:
        return self.sku.groupBy(F.col("product_id").alias("id")).agg(F.min("category_id").alias("category_id"))

    @cached_property
    def category(self) -> DataFrame:
        ids = self.table("part").selectExpr("cast(p_size as bigint) as id").distinct()
        return ids.selectExpr(
            "id",
            "id % 5 + 1 as l1_category",
            "if(id % 3 = 0, 0L, id % 10 + 10) as l2_category",
            "if(id % 3 = 0 or id % 4 = 0, 0L, id + 100) as l3_category",
            "0L as l4_category",
        )

    @cached_property
    def sku_eod(self) -> DataFrame:
        """End-of-day stock and prices, dates folded into 100 days."""
        return self.table("lineitem").selectExpr(
            "date_add(date'2023-10-24', pmod(datediff(l_shipdate, date'1995-01-01'), 100)) as dt",
            "l_partkey as sku_id",
            "l_quantity as quantity_active_eod",
            "cast(cast(l_extendedprice as decimal(18,2)) * (100 - cast(round(l_discount * 100) as int)) * 0.01"
            " as decimal(18,4)) as sell_price_eod",
            "cast(l_extendedprice as decimal(18,2)) as full_price_eod",
        )

    @cached_property
    def _numbered_events(self) -> DataFrame:
        return self.table("events").withColumn(
            "k", F.get_json_object("props", "$.k").cast("bigint")
        )

    @cached_property
    def clickstream(self) -> DataFrame:
        names = self.table("part").select("p_partkey", "p_name")
        ev = self._numbered_events.join(names, F.col("k") == F.col("p_partkey"), "left")
        query = (
            "case when k % 5 = 0 then null when k % 11 = 0 then concat('`', p_name)"
            " when k % 3 = 0 then concat('  ', p_name, ' ') when k % 2 = 0 then upper(p_name) else p_name end"
        )
        return ev.withColumn(
            "event_properties",
            F.expr(
                "to_json(named_struct('event_parameters', named_struct("
                "'initial_query', if(k % 10 = 0, p_name, null),"
                "'is_category_full_matched', case event_id % 9 when 0 then 'true' when 1 then 'false' end)))"
            ),
        ).selectExpr(
            "event_id",
            "ts as received_at",
            "ts - make_dt_interval(0, 0, cast(event_id % 3 as int)) as logged_at",
            "if(user_id % 19 = 0, 0L, user_id + 1) as account_id",
            "concat('i', user_id) as install_id",
            "if(user_id % 23 = 1, null, concat(user_id, '-', cast(datediff(ts, date'2024-01-01') div 7 as int)))"
            " as session_id",
            "case event_type when 'view' then 'PRODUCT_IMPRESSION' when 'click' then 'PRODUCT_VIEW'"
            " when 'purchase' then 'ADD_TO_CART' when 'signup' then 'ADD_TO_FAVORITES'"
            " when 'error' then '' end as event_type",
            "k as sku_id",
            "if(k % 7 = 0, null, k % 400 + 1) as sku_group_id",
            "if(k % 31 = 30, null, k % 10 + 1) as product_id",
            "case when k % 6 = 0 then 0L when k % 13 = 0 then -1L else k % 50 + 1 end as category_id",
            "if(k % 4 = 0, '7', null) as widget_section_id",
            f"{query} as query",
            "event_properties",
            "event_id % 9 = 0 as is_full_catpred",
            "cast(event_id % 20 as int) as position",
            "case when user_id % 17 = 0 then null else element_at(array('ANDROID', 'IOS', 'WEB'),"
            " cast(user_id % 3 + 1 as int)) end as platform",
            "if(event_id % 3 = 0, 'CATEGORY', 'SEARCH_RESULTS') as widget_space_name",
            "case when event_id % 4 = 0 then null when event_id % 3 = 0 then 'CATEGORY'"
            " else 'SEARCH_RESULTS' end as widget_section_name",
        )

    @cached_property
    def attribution(self) -> DataFrame:
        names = self.table("part").select("p_partkey", "p_name")
        items = self.order_items.join(names, F.col("sku_id") == F.col("p_partkey"))
        return items.selectExpr(
            "order_item_id",
            "order_id",
            "generated_at",
            "generated_at as event_received_at",
            "case when order_item_id % 7 = 0 then '' when order_item_id % 2 = 0 then upper(p_name)"
            " else p_name end as query",
            "element_at(array('CATEGORY', 'SEARCH_RESULTS', 'SEARCH'), cast(order_item_id % 3 + 1 as int))"
            " as widget_space_name",
            "if(order_item_id % 3 = 1, 'SEARCH_RESULTS', 'OTHER') as widget_section_name",
            "element_at(array('ANDROID', 'IOS', 'WEB'), cast(account_id % 3 + 1 as int)) as last_atc_platform",
            "concat('i', account_id - 1) as install_id",
            "concat(account_id - 1, '-', cast(datediff(generated_at, date'2024-01-01') div 7 as int))"
            " as last_search_session_id",
            "if(order_item_id % 9 = 0, 'true', null) as is_full_catpred",
        )

    @cached_property
    def ranking_events(self) -> DataFrame:
        names = self.table("part").select("p_partkey", "p_name")
        ev = self._numbered_events.join(names, F.col("k") == F.col("p_partkey"), "left")

        def scores(mult: int, n: str) -> str:
            return f"transform(sequence(0, {n}), i -> pmod(event_id * {mult} + i * 101, 1024) / 1024D)"

        arr = f"to_json(named_struct('dssm_score', {scores(37, 'if(event_id % 10 = 4, 3, 4)')},"
        arr += f" 'linear_score', {scores(53, '4')}, 'normalized_linear_score', {scores(71, '4')}))"
        scalar = "to_json(named_struct('dssm_score', cast(pmod(event_id * 37, 1024) / 1024D as string)))"
        return ev.selectExpr(
            "event_id",
            "ts as fired_at",
            "case when event_type = 'signup' then 'feed_model' when event_type = 'error' then 'search_unified_model_v9'"
            " else 'search_uni_next' end as model_name",
            "case when k % 17 = 0 then null when k % 2 = 0 then upper(p_name) else p_name end as search_query",
            "concat('i', user_id) as install_id",
            "if(event_id % 29 = 0, cast(array() as array<string>),"
            " transform(sequence(0, 4), i -> cast(pmod(k + i, 400) + 1 as string))) as ranking_candidates",
            f"case when event_id % 23 = 0 then null when event_id % 2 = 0 then {arr} else {scalar} end"
            " as external_features",
        )

    @cached_property
    def search_logs(self) -> DataFrame:
        names = self.table("part").select("p_partkey", "p_name")
        ev = self._numbered_events.join(names, F.col("k") == F.col("p_partkey"), "left")
        return ev.selectExpr(
            "ts as logged_at",
            "concat('i', user_id) as install_id",
            "if(k % 37 = 0, '', p_name) as query_text",
            "case when k % 4 = 0 then '' when k % 4 = 1 then null else upper(p_name) end as corrected_query_text",
            "case when k % 19 = 0 then null when k % 23 = 0 then ' ' else concat(p_name, ' online') end"
            " as result_query_text",
        )

    @cached_property
    def feedback(self) -> DataFrame:
        return self.order_items.join(
            self.sku.select(F.col("id").alias("sku_id"), "product_id"), "sku_id"
        ).selectExpr(
            "order_item_id as id",
            "product_id",
            "sku_id",
            "cast(item_quantity % 5 + 1 as int) as rating",
            "case when order_id % 3 = 0 then '' when order_id % 5 = 0 then null else 'text' end as message",
            "if(order_id % 7 = 0, 'HIDDEN', 'PUBLISHED') as status",
            "generated_at as date_published",
        )

    @cached_property
    def dynamic_discount(self) -> DataFrame:
        price = "cast(p_retailprice as decimal(18,2))"
        return self.table("lineitem").join(
            self.table("part"), F.col("l_partkey") == F.col("p_partkey")
        ).selectExpr(
            "l_partkey as sku_id",
            "if(l_suppkey % 10 = 9, 'seasonal_sale', concat('dyno_pricing_', l_suppkey % 3)) as promotion_id",
            "cast(l_discount * 100 as decimal(18,2)) as discount_amount",
            f"if(l_linenumber = 1, {price} + 1, {price}) as calculated_for_price",
            "cast('2024-01-31 12:00:00' as timestamp_ntz)"
            " - make_dt_interval(cast(pmod(datediff(l_shipdate, date'1995-01-01'), 5) as int))"
            " - make_dt_interval(0, 0, 0, pmod(l_orderkey * 104729 + l_linenumber * 17, 43200)) as created_at",
        )

    @cached_property
    def ad_funnel(self) -> DataFrame:
        return self._numbered_events.selectExpr(
            "cast(ts as date) as date",
            "case when k % 33 = 0 then null when k % 21 = 0 then '0' else cast(k + 1 as string) end as sku_group_id",
            "cast(event_id % 7 + 1 as string) as impressions",
            "cast(event_id % 2 as string) as clicks",
            "cast(cast(value as decimal(18,2)) as string) as adrev",
        )

    @cached_property
    def costs(self) -> DataFrame:
        """Delivery costs per order item; the raw lines repeat, as cost tables do."""
        lines = self.table("lineitem").join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.withColumn("order_created_at", F.expr(self.order_instant())).selectExpr(
            "l_orderkey * 10 + l_linenumber as order_item_id",
            "case l_suppkey when 3 then double('NaN') when 5 then null"
            " else cast(cast(l_tax * l_extendedprice as decimal(18,0)) as double) end as forward_cost",
            "cast(cast(l_discount * l_extendedprice as decimal(18,0)) as double) as reverse_cost",
            "order_created_at",
            "order_created_at + make_dt_interval(pmod(datediff(l_shipdate, date'1995-01-01'), 30)) as order_issued_at",
            "if(o_custkey % 50 = 0, 0L, o_custkey + 1) as account_id",
        )

    @cached_property
    def account_properties(self) -> DataFrame:
        first = F.struct("order_ts", "o_orderkey")
        priced = self.table("orders").withColumn("order_ts", F.expr(self.order_instant()))
        return (
            priced.groupBy("o_custkey")
            .agg(F.min(first).alias("f"), F.max("order_ts").alias("last_ts"))
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .selectExpr(
                "if(o_custkey % 40 = 0, 0L, o_custkey + 1) as account_id",
                "if(o_custkey % 37 = 0, date'1970-01-01', cast(f.order_ts as date)) as first_created_on",
                "f.o_orderkey as first_order_id",
                "cast(f.order_ts + interval 3 days as date) as first_issued_on",
                "'PostPaid' as first_issued_payment_type",
                "cast(null as string) as first_issued_installment_type",
                "date_sub(cast(f.order_ts as date), 10) as registered_on",
                "date_sub(cast(f.order_ts as date), 12) as first_session_on",
                "cast(c_nationkey as string) as first_city_id",
                "'DELIVERY_POINT' as first_delivery_point_type",
                "c_mktsegment as source_type",
                "if(o_custkey % 2 = 0, 'cpc', 'organic') as campaign_type",
                "cast(o_custkey % 3 + 1 as int) as accounts_per_install",
                "date_sub(cast(last_ts as date), cast(o_custkey % 100 as int)) as last_created_on",
            )
        )

    @cached_property
    def price_index(self) -> DataFrame:
        return self.sku.select("sku_group_id").distinct().selectExpr(
            "sku_group_id",
            "element_at(array('CHEAPEST_AMONG_CLUSTER', 'CHEAPEST_AMONG_COMPETITORS',"
            " 'CHEAPEST_AMONG_COMPETITORS_AND_CLUSTER', 'NO_BOOST', 'UNHEARD_OF'),"
            " cast(sku_group_id % 5 + 1 as int)) as price_index_status",
        )

    def _cell(self, q: str, r: str):
        return hexgrid.pack(F.expr(q), F.expr(r))

    @cached_property
    def hex_activity(self) -> DataFrame:
        return (
            self.table("events")
            .withColumn("h3_index", self._cell("user_id % 15", "user_id div 15"))
            .groupBy("h3_index", F.to_date("ts").alias("day"))
            .agg(
                F.count_if(F.col("event_type") == "view").alias("daily_views"),
                F.count_if(F.col("event_type") == "purchase").alias("daily_orders"),
            )
        )

    @cached_property
    def client_locations(self) -> DataFrame:
        return self.table("events").select(
            self._cell("user_id % 15", "user_id div 15").alias("h3_index"),
            F.to_date("ts").alias("report_date"),
        )

    @cached_property
    def delivery_points(self) -> DataFrame:
        cell = self._cell("s_suppkey % 10", "s_suppkey div 10")
        return self.table("supplier").withColumn("cell", cell).select(
            (F.col("s_suppkey") + 1).alias("id"),
            hexgrid.centre_lat(F.col("cell")).alias("latitude"),
            hexgrid.centre_lon(F.col("cell")).alias("longitude"),
            F.expr(
                "element_at(array('DELIVERY_POINT', 'UZ_POST', 'OTHER'), cast(s_nationkey % 3 + 1 as int))"
            ).alias("type"),
        )

    @cached_property
    def demography(self) -> DataFrame:
        return (
            self.table("customer")
            .withColumn("h3_index", self._cell("c_custkey % 15", "c_custkey div 15 % 15"))
            .groupBy("h3_index")
            .agg(
                F.count(F.lit(1)).cast("double").alias("population"),
                F.sum(F.abs(F.col("c_acctbal")).cast("decimal(18,2)")).cast("double").alias("traffic_index"),
            )
        )

    @cached_property
    def poi(self) -> DataFrame:
        names = ", ".join(f"'{n}'" for n in POI_NAMES)
        return self.table("customer").select(
            self._cell("c_custkey % 15", "c_custkey div 15 % 15").alias("h3_index"),
            F.expr(f"element_at(array({names}, 'Школы'), cast(c_custkey % 8 + 1 as int))").alias("category_sub"),
            F.expr(
                "cast('2024-01-29 10:00:00' as timestamp_ntz) + make_dt_interval(cast(c_nationkey % 2 as int))"
            ).alias("inserted_at"),
        )

    @cached_property
    def rates(self) -> DataFrame:
        """Exchange rate per day (one row per order day)."""
        return (
            self.table("orders")
            .selectExpr("datediff(o_orderdate, date'1995-01-01') % 180 as n")
            .distinct()
            .selectExpr("date_add(date'2023-08-05', n) as date", "1D / (n % 2 + 1) as usd_rate")
        )
