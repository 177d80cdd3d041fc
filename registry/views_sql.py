"""The star-schema views of the queries, restated in SQL for the oracle engine.

Each view is one CTE. ``with_views`` puts the needed ones, in order, in front of
a query.
"""

from __future__ import annotations

import re

ORDER_TS = (
    "(TIMESTAMP '2023-08-05 00:00:00' + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 180 AS INTEGER))"
    " + to_seconds((o_orderkey * 7919) % 86400))"
)
STATUS = (
    "CASE WHEN l_returnflag = 'R' THEN 'RETURNED' WHEN l_linestatus = 'F' THEN 'COMPLETED'"
    " WHEN l_returnflag = 'N' THEN 'CREATED' ELSE 'ACTIVE' END"
)
MONEY = "CAST(l_extendedprice AS DECIMAL(18,2))"
SHIP_N = "date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))"
SPAN = 1 << 31
SHIFT = 1 << 30


def cell(q: str, r: str) -> str:
    return f"(CAST(({q}) + {SHIFT} AS BIGINT) * {SPAN} + CAST(({r}) + {SHIFT} AS BIGINT))"


VIEWS: dict[str, str] = {
    "v_lines": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1""",
    "v_order_items": f"""
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, o_custkey + 1 AS account_id, l_partkey AS sku_id,
  gen AS generated_at,
  gen + to_hours(l_suppkey % 3) AS purchased_at,
  CASE WHEN l_linestatus = 'F' THEN gen + to_days(CAST(l_partkey % 20 + 2 AS INTEGER)) END AS issued_at,
  CASE WHEN l_linestatus = 'F' OR l_returnflag = 'R' THEN gen + to_days(CAST(l_partkey % 10 + 1 AS INTEGER)) END AS delivered_at,
  CASE WHEN l_returnflag = 'R' THEN gen + to_days(CAST(l_partkey % 20 + 2 + l_suppkey % 12 AS INTEGER)) + to_minutes(l_suppkey % 2 * 30) END AS returned_at,
  {STATUS} AS order_item_status,
  CAST(l_quantity AS BIGINT) AS item_quantity,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS returned_quantity,
  {MONEY} AS gmv_generated,
  CASE WHEN {STATUS} = 'COMPLETED' THEN {MONEY} ELSE 0 END AS gmv_completed,
  CASE WHEN l_returnflag = 'R' THEN {MONEY} ELSE 0 END AS gmv_returned,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'RETURNED NO SHOW'
       WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'RETURNED AFTER COMPLETED' ELSE 'RETURNED' END
       WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'RETURNED BEFORE DELIVERY'
       WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'ACTIVE' END AS real_order_item_status,
  CASE l_suppkey % 6 WHEN 0 THEN 'CANCELED' WHEN 1 THEN 'DEFECTED' WHEN 2 THEN 'BAD_QUALITY' WHEN 3 THEN 'OTHER' WHEN 4 THEN '' END AS return_cause,
  CASE WHEN l_linenumber % 5 = 0 THEN 'COURIER' ELSE 'PICKUP' END AS delivery_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'PostPaid' WHEN '2-HIGH' THEN 'Postpaid' WHEN '3-MEDIUM' THEN 'Nasiya' ELSE 'Card' END AS payment_type,
  CAST(c_nationkey AS BIGINT) AS city_id, CAST(n_regionkey AS BIGINT) AS region_id, l_suppkey + 1 AS delivery_point_id
FROM (SELECT *, {ORDER_TS} AS gen FROM v_lines JOIN orders ON l_orderkey = o_orderkey) x
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_sku": """
SELECT p_partkey AS id, p_partkey % 400 + 1 AS sku_group_id, p_partkey % 700 + 1 AS product_id, CAST(p_size AS BIGINT) AS category_id,
  p_partkey % 50 + 1 AS shop_id, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS brand_name_id,
  CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN p_type ELSE 'UNKNOWN' END AS dimensional_group,
  CAST(p_retailprice AS DECIMAL(18,2)) AS sell_price, p_name AS title, p_type AS type_title FROM part""",
    "v_product": "SELECT product_id AS id, min(category_id) AS category_id FROM v_sku GROUP BY product_id",
    "v_category": """
SELECT id, id % 5 + 1 AS l1_category, CASE WHEN id % 3 = 0 THEN 0 ELSE id % 10 + 10 END AS l2_category,
  CASE WHEN id % 3 = 0 OR id % 4 = 0 THEN 0 ELSE id + 100 END AS l3_category, CAST(0 AS BIGINT) AS l4_category
FROM (SELECT DISTINCT CAST(p_size AS BIGINT) AS id FROM part) c""",
    "v_history": """
SELECT o.*, s.category_id, DATE '2024-01-31' AS analyze_date, city_id AS order_city_id, region_id AS order_region_id
FROM v_order_items o LEFT JOIN v_sku s ON s.id = o.sku_id WHERE order_item_status <> 'CREATED'""",
    "v_sku_eod": f"""
SELECT DATE '2023-10-24' + CAST({SHIP_N} % 100 AS INTEGER) AS dt, l_partkey AS sku_id, l_quantity AS quantity_active_eod,
  CAST({MONEY} * (100 - CAST(round(l_discount * 100) AS INTEGER)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS sell_price_eod, {MONEY} AS full_price_eod FROM lineitem""",
    "v_ev": "SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "v_clicks": """
SELECT event_id, ts AS received_at, ts - to_minutes(event_id % 3) AS logged_at,
  CASE WHEN user_id % 19 = 0 THEN 0 ELSE user_id + 1 END AS account_id,
  'i' || user_id AS install_id,
  CASE WHEN user_id % 23 = 1 THEN NULL ELSE user_id || '-' || (date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7) END AS session_id,
  CASE event_type WHEN 'view' THEN 'PRODUCT_IMPRESSION' WHEN 'click' THEN 'PRODUCT_VIEW' WHEN 'purchase' THEN 'ADD_TO_CART'
    WHEN 'signup' THEN 'ADD_TO_FAVORITES' WHEN 'error' THEN '' END AS event_type,
  k AS sku_id, CASE WHEN k % 7 = 0 THEN NULL ELSE k % 400 + 1 END AS sku_group_id,
  CASE WHEN k % 31 = 30 THEN NULL ELSE k % 10 + 1 END AS product_id,
  CASE WHEN k % 6 = 0 THEN 0 WHEN k % 13 = 0 THEN -1 ELSE k % 50 + 1 END AS category_id,
  CASE WHEN k % 4 = 0 THEN '7' END AS widget_section_id,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 11 = 0 THEN '`' || p_name WHEN k % 3 = 0 THEN '  ' || p_name || ' ' WHEN k % 2 = 0 THEN upper(p_name) ELSE p_name END AS query,
  CASE WHEN k % 10 = 0 THEN p_name END AS initial_query,
  CASE event_id % 9 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS full_matched,
  event_id % 9 = 0 AS is_full_catpred, CAST(event_id % 20 AS INTEGER) AS position,
  CASE WHEN user_id % 17 = 0 THEN NULL WHEN user_id % 3 = 0 THEN 'ANDROID' WHEN user_id % 3 = 1 THEN 'IOS' ELSE 'WEB' END AS platform,
  CASE WHEN event_id % 3 = 0 THEN 'CATEGORY' ELSE 'SEARCH_RESULTS' END AS widget_space_name,
  CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'CATEGORY' ELSE 'SEARCH_RESULTS' END AS widget_section_name
FROM v_ev LEFT JOIN part ON k = p_partkey""",
    "v_attribution": """
SELECT order_item_id, order_id, generated_at, generated_at AS event_received_at,
  CASE WHEN order_item_id % 7 = 0 THEN '' WHEN order_item_id % 2 = 0 THEN upper(p_name) ELSE p_name END AS query,
  CASE order_item_id % 3 WHEN 0 THEN 'CATEGORY' WHEN 1 THEN 'SEARCH_RESULTS' ELSE 'SEARCH' END AS widget_space_name,
  CASE WHEN order_item_id % 3 = 1 THEN 'SEARCH_RESULTS' ELSE 'OTHER' END AS widget_section_name,
  CASE account_id % 3 WHEN 0 THEN 'ANDROID' WHEN 1 THEN 'IOS' ELSE 'WEB' END AS last_atc_platform,
  'i' || (account_id - 1) AS install_id,
  (account_id - 1) || '-' || CAST(trunc(date_diff('day', DATE '2024-01-01', CAST(generated_at AS DATE)) / 7.0) AS INTEGER) AS last_search_session_id,
  CASE WHEN order_item_id % 9 = 0 THEN 'true' END AS is_full_catpred
FROM v_order_items JOIN part ON sku_id = p_partkey""",
    "v_ranking": """
SELECT event_id, ts AS fired_at,
  CASE event_type WHEN 'signup' THEN 'feed_model' WHEN 'error' THEN 'search_unified_model_v9' ELSE 'search_uni_next' END AS model_name,
  CASE WHEN k % 17 = 0 THEN NULL WHEN k % 2 = 0 THEN upper(p_name) ELSE p_name END AS search_query,
  'i' || user_id AS install_id,
  CASE WHEN event_id % 29 = 0 THEN CAST([] AS BIGINT[]) ELSE list_transform(range(0, 5), lambda i: (k + i) % 400 + 1) END AS ranking_candidates,
  event_id % 23 <> 0 AS has_features,
  CASE WHEN event_id % 23 <> 0 AND event_id % 2 = 0 THEN list_transform(range(0, CASE WHEN event_id % 10 = 4 THEN 4 ELSE 5 END), lambda i: ((event_id * 37 + i * 101) % 1024) / 1024.0) END AS dssm_array,
  CASE WHEN event_id % 23 <> 0 AND event_id % 2 = 1 THEN ((event_id * 37) % 1024) / 1024.0 END AS dssm_scalar,
  CASE WHEN event_id % 23 <> 0 AND event_id % 2 = 0 THEN list_transform(range(0, 5), lambda i: ((event_id * 53 + i * 101) % 1024) / 1024.0) END AS linear_array,
  CASE WHEN event_id % 23 <> 0 AND event_id % 2 = 0 THEN list_transform(range(0, 5), lambda i: ((event_id * 71 + i * 101) % 1024) / 1024.0) END AS norm_array
FROM v_ev LEFT JOIN part ON k = p_partkey""",
    "v_search_logs": """
SELECT ts AS logged_at, 'i' || user_id AS install_id, CASE WHEN k % 37 = 0 THEN '' ELSE p_name END AS query_text,
  CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 THEN NULL ELSE upper(p_name) END AS corrected_query_text,
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 23 = 0 THEN ' ' ELSE p_name || ' online' END AS result_query_text
FROM v_ev LEFT JOIN part ON k = p_partkey""",
    "v_feedback": """
SELECT order_item_id AS id, s.product_id, sku_id, CAST(item_quantity % 5 + 1 AS INTEGER) AS rating,
  CASE WHEN order_id % 3 = 0 THEN '' WHEN order_id % 5 = 0 THEN NULL ELSE 'text' END AS message,
  CASE WHEN order_id % 7 = 0 THEN 'HIDDEN' ELSE 'PUBLISHED' END AS status, generated_at AS date_published
FROM v_order_items o JOIN v_sku s ON s.id = o.sku_id""",
    "v_discount": f"""
SELECT l_partkey AS sku_id, CASE WHEN l_suppkey % 10 = 9 THEN 'seasonal_sale' ELSE 'dyno_pricing_' || (l_suppkey % 3) END AS promotion_id,
  CAST(l_discount * 100 AS DECIMAL(18,2)) AS discount_amount,
  CASE WHEN l_linenumber = 1 THEN CAST(p_retailprice AS DECIMAL(18,2)) + 1 ELSE CAST(p_retailprice AS DECIMAL(18,2)) END AS calculated_for_price,
  TIMESTAMP '2024-01-31 12:00:00' - to_days(CAST({SHIP_N} % 5 AS INTEGER)) - to_seconds((l_orderkey * 104729 + l_linenumber * 17) % 43200) AS created_at
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_ad_funnel": """
SELECT CAST(ts AS DATE) AS date, CASE WHEN k % 33 = 0 THEN NULL WHEN k % 21 = 0 THEN '0' ELSE CAST(k + 1 AS VARCHAR) END AS sku_group_id,
  CAST(event_id % 7 + 1 AS VARCHAR) AS impressions, CAST(event_id % 2 AS VARCHAR) AS clicks,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS adrev FROM v_ev""",
    "v_costs": f"""
SELECT l_orderkey * 10 + l_linenumber AS order_item_id,
  CASE WHEN l_suppkey = 3 THEN CAST('NaN' AS DOUBLE) WHEN l_suppkey = 5 THEN NULL ELSE CAST(CAST(l_tax * l_extendedprice AS DECIMAL(18,0)) AS DOUBLE) END AS forward_cost,
  CAST(CAST(l_discount * l_extendedprice AS DECIMAL(18,0)) AS DOUBLE) AS reverse_cost,
  {ORDER_TS} AS order_created_at,
  {ORDER_TS} + to_days(CAST({SHIP_N} % 30 AS INTEGER)) AS order_issued_at,
  CASE WHEN o_custkey % 50 = 0 THEN 0 ELSE o_custkey + 1 END AS account_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "v_accounts": f"""
SELECT CASE WHEN o_custkey % 40 = 0 THEN 0 ELSE o_custkey + 1 END AS account_id,
  CASE WHEN o_custkey % 37 = 0 THEN DATE '1970-01-01' ELSE CAST(f.t AS DATE) END AS first_created_on, f.k AS first_order_id,
  CAST(f.t + to_days(3) AS DATE) AS first_issued_on, 'PostPaid' AS first_issued_payment_type, CAST(NULL AS VARCHAR) AS first_issued_installment_type,
  CAST(f.t AS DATE) - 10 AS registered_on, CAST(f.t AS DATE) - 12 AS first_session_on, CAST(c_nationkey AS VARCHAR) AS first_city_id,
  'DELIVERY_POINT' AS first_delivery_point_type, c_mktsegment AS source_type, CASE WHEN o_custkey % 2 = 0 THEN 'cpc' ELSE 'organic' END AS campaign_type,
  CAST(o_custkey % 3 + 1 AS INTEGER) AS accounts_per_install, CAST(last_ts AS DATE) - CAST(o_custkey % 100 AS INTEGER) AS last_created_on
FROM (SELECT o_custkey, min({{'t': {ORDER_TS}, 'k': o_orderkey}}) AS f, max({ORDER_TS}) AS last_ts FROM orders GROUP BY o_custkey) g
JOIN customer ON o_custkey = c_custkey""",
    "v_price_index": """
SELECT sku_group_id, CASE sku_group_id % 5 WHEN 0 THEN 'CHEAPEST_AMONG_CLUSTER' WHEN 1 THEN 'CHEAPEST_AMONG_COMPETITORS'
  WHEN 2 THEN 'CHEAPEST_AMONG_COMPETITORS_AND_CLUSTER' WHEN 3 THEN 'NO_BOOST' ELSE 'UNHEARD_OF' END AS price_index_status
FROM (SELECT DISTINCT sku_group_id FROM v_sku) g""",
    "v_hex_activity": f"""
SELECT {cell('user_id % 15', 'user_id // 15')} AS h3_index, user_id % 15 AS q, user_id // 15 AS r, CAST(ts AS DATE) AS day,
  count(*) FILTER (WHERE event_type = 'view') AS daily_views, count(*) FILTER (WHERE event_type = 'purchase') AS daily_orders
FROM events GROUP BY 1, 2, 3, 4""",
    "v_locations": f"""
SELECT {cell('user_id % 15', 'user_id // 15')} AS h3_index, user_id % 15 AS q, user_id // 15 AS r, CAST(ts AS DATE) AS report_date FROM events""",
    "v_points": """
SELECT s_suppkey + 1 AS id, s_suppkey % 10 AS q, s_suppkey // 10 AS r,
  CASE s_nationkey % 3 WHEN 0 THEN 'DELIVERY_POINT' WHEN 1 THEN 'UZ_POST' ELSE 'OTHER' END AS type FROM supplier""",
    "v_demography": f"""
SELECT {cell('c_custkey % 15', 'c_custkey // 15 % 15')} AS h3_index, c_custkey % 15 AS q, c_custkey // 15 % 15 AS r,
  CAST(count(*) AS DOUBLE) AS population, CAST(sum(CAST(abs(c_acctbal) AS DECIMAL(18,2))) AS DOUBLE) AS traffic_index
FROM customer GROUP BY 1, 2, 3""",
    "v_poi": f"""
SELECT {cell('c_custkey % 15', 'c_custkey // 15 % 15')} AS h3_index, c_custkey % 15 AS q, c_custkey // 15 % 15 AS r,
  CASE c_custkey % 8 WHEN 0 THEN 'Банкоматы' WHEN 1 THEN 'Банки' WHEN 2 THEN 'Торговые точки' WHEN 3 THEN 'Автосалоны, Автосервисы'
    WHEN 4 THEN 'Смешанные товары' WHEN 5 THEN 'Быстрое питание, Кофейни' WHEN 6 THEN 'Пекарни' ELSE 'Школы' END AS category_sub,
  TIMESTAMP '2024-01-29 10:00:00' + to_days(CAST(c_nationkey % 2 AS INTEGER)) AS inserted_at FROM customer""",
    "v_rates": """
SELECT DISTINCT DATE '2023-08-05' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 180 AS INTEGER) AS date,
  1.0 / (date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 180 % 2 + 1) AS usd_rate FROM orders""",
    "v_off": """
SELECT dq, dr, (abs(dq) + abs(dr) + abs(dq + dr)) // 2 AS ring FROM range(-5, 6) a(dq), range(-5, 6) b(dr)
WHERE abs(dq + dr) <= 5""",
}


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the views it names, and those they name."""
    known = {**VIEWS, **(extra or {})}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(known[name])

    visit(sql)
    ctes = ",\n".join(f"{n} AS ({known[n].strip()})" for n in known if n in needed)
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
