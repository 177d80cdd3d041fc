"""Registered silver tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from featuremill.operators.state_table import StateTable
from featuremill.plans import item_silver as items
from featuremill.plans import search_silver as search
from featuremill.sources.star_views import ANCHOR, StarViews
from registry.workspace import fresh_dir

D = ANCHOR
CLICK_DAYS = (date(2024, 1, 1), date(2024, 2, 1))
ORDER_DAYS = (date(2023, 8, 5), date(2024, 2, 1))
EOD_DAYS = (date(2023, 10, 24), date(2024, 2, 1))
DISCOUNT_DAYS = (date(2024, 1, 26), date(2024, 2, 1))
SCORE_DAY_1, SCORE_DAY_2 = date(2024, 1, 15), date(2024, 1, 16)
CAUSES = "('MISSING', 'DEFECTED', 'BAD_QUALITY', 'WRONG_ITEM', 'PHOTO_MISMATCH', 'CONTENT')"


def rounded(df, digits: int = 6, only=None):
    """Doubles rounded: sums of doubles depend on their order in the last digits."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if f.dataType.typeName() == "double" and (only is None or f.name in only)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def funnel(v: StarViews):
    return search.search_funnel_daily(v.clickstream, v.sku, *CLICK_DAYS)


def query_orders(v: StarViews):
    return items.query_item_orders(v.order_items, v.sku, v.attribution, *ORDER_DAYS, tasks=v.item_tasks)


def item_prices(v: StarViews):
    return items.item_prices(v.sku_eod, v.sku, *EOD_DAYS)


def stock(v: StarViews):
    return items.sku_stock_daily(v.sku_eod, *EOD_DAYS)


def ad_daily(v: StarViews):
    return items.ad_revenue_daily(v.ad_funnel, *CLICK_DAYS)


def discounts(v: StarViews):
    return items.daily_discounts(v.dynamic_discount, *DISCOUNT_DAYS)


def conversions(v: StarViews):
    return search.query_item_daily_conversions(v.clickstream, v.sku, v.order_items, v.attribution, *CLICK_DAYS)


def unit_costs(v: StarViews):
    return items.delivery_unit_cost(v.costs, v.order_items, v.sku, D)


def lifetime(v: StarViews):
    return items.account_lifetime_facts(v.account_properties, D)


def score_log(v: StarViews):
    empty = v.spark.createDataFrame(
        [], "date date, query string, sku_group_id bigint, collected_at timestamp_ntz, dssm_score double"
    )
    first = search.score_change_log(v.ranking_events, empty, SCORE_DAY_1, datetime(2024, 1, 16, 2))
    return search.score_change_log(v.ranking_events, first, SCORE_DAY_2, datetime(2024, 1, 17, 2))


def score_log_by_state(v: StarViews):
    """The second day's rows, from the state that the first day left."""
    folder = fresh_dir(v.spark, "score-state")
    buckets = int(v.spark.conf.get("spark.sql.shuffle.partitions"))
    state = StateTable(f"score_state_{folder[-32:]}", folder, search.SCORE_STATE, search.SCORE_KEY, buckets)
    for on in (SCORE_DAY_1, SCORE_DAY_2):
        made = search.run_score_log(v.ranking_events, state, on, datetime(2024, 1, on.day + 1, 2), v.stage)
    return made


def item_texts(v: StarViews):
    """One row per item group with text fields and factors."""
    return v.sku.groupBy("sku_group_id").agg(
        F.min("product_id").alias("product_id"),
        F.min("title").alias("title"),
        F.min("type_title").alias("type_title"),
        F.min("sell_price").cast("double").alias("sell_price"),
        F.count(F.lit(1)).alias("n_skus"),
    )


def candidates(v: StarViews):
    return search.query_candidates(v.clickstream, v.search_logs, date(2024, 1, 20))


def candidate_pairs(v: StarViews):
    return search.query_candidate_pairs(v.clickstream, v.search_logs, date(2024, 1, 20))


def relevance(v: StarViews):
    return search.relevance_features(candidate_pairs(v), item_texts(v), ["title", "type_title"], ["n_skus"], date(2024, 1, 20))


FOLD = "nullif(trim(regexp_replace({x}, '[`''ʻ'']', '''', 'g')), '')"


def _fold(x: str) -> str:
    return FOLD.format(x=x)


def _account_level(level: int) -> str:
    fall = {
        1: "l1_category",
        2: "CASE WHEN l2_category > 0 THEN l2_category ELSE l1_category END",
        3: "CASE WHEN l3_category > 0 THEN l3_category WHEN l2_category > 0 THEN l2_category ELSE l1_category END",
    }[level]
    kinds = {"n_imps": "PRODUCT_IMPRESSION", "n_clicks": "PRODUCT_VIEW", "n_atcs": "ADD_TO_CART", "n_atfs": "ADD_TO_FAVORITES"}
    per = ", ".join(f"count(DISTINCT CASE WHEN event_type = '{k}' THEN product_id END) AS {n}" for n, k in kinds.items())
    tot = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in kinds)
    return f"""
WITH p AS (
  SELECT CAST(received_at + INTERVAL 5 HOUR AS DATE) AS date, account_id, session_id, e.product_id, event_type, {fall} AS category_id
  FROM v_clicks e LEFT JOIN v_product pr ON e.product_id = pr.id
  JOIN v_category c ON (CASE WHEN e.category_id > 0 THEN e.category_id ELSE pr.category_id END) = c.id
  WHERE account_id > 0 AND event_type IN ('PRODUCT_IMPRESSION', 'PRODUCT_VIEW', 'ADD_TO_CART', 'ADD_TO_FAVORITES')
    AND CAST(received_at + INTERVAL 5 HOUR AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'),
s AS (SELECT date, account_id, session_id, category_id, {per} FROM p GROUP BY ALL)
SELECT date, account_id, category_id, {tot} FROM s GROUP BY date, account_id, category_id"""


FUNNEL_SQL = f"""
WITH ev AS (
  SELECT c.* EXCLUDE (sku_group_id, query, category_id), CAST(received_at AS DATE) AS date,
    CASE WHEN c.sku_group_id IS NULL OR c.sku_group_id = 0 THEN coalesce(s.sku_group_id, 0) ELSE c.sku_group_id END AS sku_group_id,
    coalesce(full_matched, 'false') = 'true' AS fm,
    coalesce({_fold('c.query')}, {_fold('initial_query')}, '') AS search_text,
    CAST(CASE WHEN c.category_id IS NOT NULL AND c.category_id NOT IN (-1, 0) THEN c.category_id
      WHEN widget_section_id IS NOT NULL THEN CAST(widget_section_id AS BIGINT) ELSE 0 END AS VARCHAR) AS category_text,
    coalesce(widget_section_name, widget_space_name) AS section
  FROM v_clicks c LEFT JOIN v_sku s ON c.sku_id = s.id
  WHERE session_id IS NOT NULL AND install_id IS NOT NULL AND event_type IN ('PRODUCT_IMPRESSION', 'PRODUCT_VIEW', 'ADD_TO_CART')
    AND received_at >= TIMESTAMP '2024-01-01' AND received_at < TIMESTAMP '2024-02-01'),
imp AS (
  SELECT date, install_id, sku_group_id, CASE WHEN widget_space_name = 'SEARCH_RESULTS' AND NOT fm THEN 'SEARCH_RESULTS' ELSE 'CATEGORY' END AS space,
    CASE WHEN widget_space_name = 'SEARCH_RESULTS' AND NOT fm THEN search_text ELSE category_text END AS uniqs, 0 AS a, 0 AS c, 1 AS i
  FROM ev WHERE event_type = 'PRODUCT_IMPRESSION' AND section IN ('SEARCH_RESULTS', 'CATEGORY')),
lagged AS (
  SELECT kind, date, install_id, event_type, lag(event_type) OVER w AS pt, lag(sku_group_id) OVER w AS psg, lag(fm) OVER w AS pfm,
    lag(search_text) OVER w AS ps, lag(category_text) OVER w AS pc, lag(section) OVER w AS psec
  FROM (SELECT 'PRODUCT_VIEW' AS kind, * FROM ev WHERE event_type IN ('PRODUCT_IMPRESSION', 'PRODUCT_VIEW')
        UNION ALL SELECT 'ADD_TO_CART' AS kind, * FROM ev WHERE event_type IN ('PRODUCT_IMPRESSION', 'ADD_TO_CART')) x
  WHERE product_id IS NOT NULL
  WINDOW w AS (PARTITION BY kind, date, session_id, product_id ORDER BY logged_at, event_id)),
react AS (
  SELECT date, install_id, psg AS sku_group_id, CASE WHEN psec = 'SEARCH_RESULTS' AND NOT pfm THEN 'SEARCH_RESULTS' ELSE 'CATEGORY' END AS space,
    CASE WHEN psec = 'SEARCH_RESULTS' AND NOT pfm THEN ps ELSE pc END AS uniqs,
    CASE WHEN kind = 'ADD_TO_CART' THEN 1 ELSE 0 END AS a, CASE WHEN kind = 'PRODUCT_VIEW' THEN 1 ELSE 0 END AS c, 0 AS i
  FROM lagged WHERE event_type = kind AND pt = 'PRODUCT_IMPRESSION' AND psec IN ('SEARCH_RESULTS', 'CATEGORY'))
SELECT date, install_id, CAST(sku_group_id AS BIGINT) AS sku_group_id, space, uniqs, CAST(sum(a) AS BIGINT) AS sum_atc,
  CAST(sum(c) AS BIGINT) AS sum_clicks, CAST(sum(i) AS BIGINT) AS sum_impressions
FROM (SELECT * FROM imp UNION ALL SELECT * FROM react) u GROUP BY date, install_id, sku_group_id, space, uniqs"""

_DAYS = "SELECT CAST(x AS DATE) AS d FROM range(DATE '2023-08-05', DATE '2024-02-01', INTERVAL 1 DAY) t(x)"
_RET = "o.returned_at >= d AND o.returned_at < d + 1"
_COM = "o.order_item_status = 'COMPLETED' AND o.issued_at >= d AND o.issued_at < d + 1 AND (o.returned_at IS NULL OR o.returned_at >= d + 1)"

ITEM_ORDERS_SQL = f"""
WITH days AS ({_DAYS}),
oi AS (SELECT * FROM v_order_items WHERE order_item_status NOT IN ('CREATED', 'NOT_CREATED')),
stats AS (
  SELECT d AS date, sku_group_id, sum(CASE WHEN {_RET} THEN returned_quantity ELSE 0 END) AS ri, sum(CASE WHEN {_RET} THEN gmv_returned ELSE 0 END) AS rg,
    count(DISTINCT CASE WHEN {_RET} THEN order_id END) AS ro, sum(CASE WHEN {_COM} THEN item_quantity ELSE 0 END) AS ci,
    count(DISTINCT CASE WHEN {_COM} THEN order_id END) AS co, sum(CASE WHEN {_COM} THEN gmv_completed ELSE 0 END) AS cg
  FROM oi o JOIN days ON o.generated_at >= d - 20 AND o.generated_at < d + 1
    AND greatest(coalesce(CAST(issued_at AS DATE), DATE '1970-01-01'), coalesce(CAST(returned_at AS DATE), DATE '1970-01-01')) >= d
  JOIN v_sku s ON s.id = o.sku_id GROUP BY d, sku_group_id),
gen AS (
  SELECT CAST(generated_at AS DATE) AS date, sku_group_id, count(DISTINCT order_id) AS og, sum(item_quantity) AS ig, sum(gmv_generated) AS gg
  FROM oi o JOIN v_sku s ON s.id = o.sku_id WHERE generated_at >= TIMESTAMP '2023-08-05' AND generated_at < TIMESTAMP '2024-02-01' GROUP BY 1, 2)
SELECT date, sku_group_id, CAST(coalesce(og, 0) AS BIGINT) AS orders_generated, CAST(coalesce(ig, 0) AS BIGINT) AS items_generated,
  CAST(coalesce(gg, 0) AS DOUBLE) AS gmv_generated, CAST(coalesce(ci, 0) AS BIGINT) AS items_completed, CAST(coalesce(cg, 0) AS DOUBLE) AS gmv_completed,
  CAST(coalesce(co, 0) AS BIGINT) AS completed_orders, CAST(coalesce(ri, 0) AS BIGINT) AS returned_items, CAST(coalesce(rg, 0) AS DOUBLE) AS returned_gmv,
  CAST(coalesce(ro, 0) AS BIGINT) AS returned_orders
FROM stats FULL JOIN gen USING (date, sku_group_id) WHERE coalesce(ri, 0) + coalesce(ci, 0) + coalesce(ig, 0) > 0"""

QUERY_ORDERS_SQL = f"""
WITH days AS ({_DAYS}),
oi AS (SELECT o.*, sku_group_id FROM v_order_items o JOIN v_sku s ON s.id = o.sku_id WHERE order_item_status NOT IN ('CREATED', 'NOT_CREATED')),
so AS (SELECT DISTINCT d, order_item_id, query FROM v_attribution a JOIN days ON a.generated_at > d - 20 AND a.generated_at < d + 1
  WHERE widget_space_name IN ('SHOP_SEARCH_RESULTS', 'COLLECTION_SEARCH_RESULTS', 'SEARCH', 'SEARCH_RESULTS') AND query <> ''),
stats AS (
  SELECT d, order_item_id, sku_group_id, sum(CASE WHEN {_RET} THEN returned_quantity ELSE 0 END) AS ri, sum(CASE WHEN {_RET} THEN gmv_returned ELSE 0 END) AS rg,
    count(DISTINCT CASE WHEN {_RET} THEN order_id END) AS ro, sum(CASE WHEN {_COM} THEN item_quantity ELSE 0 END) AS ci,
    count(DISTINCT CASE WHEN {_COM} THEN order_id END) AS co, sum(CASE WHEN {_COM} THEN gmv_completed ELSE 0 END) AS cg
  FROM oi o JOIN days ON o.generated_at >= d - 20 AND o.generated_at <= d + 1 AND ((issued_at >= d AND issued_at < d + 1) OR returned_at >= d)
  GROUP BY d, order_item_id, sku_group_id),
gen AS (SELECT CAST(generated_at AS DATE) AS d, order_item_id, sku_group_id, count(DISTINCT order_item_id) AS og, sum(item_quantity) AS ig, sum(gmv_generated) AS gg
  FROM oi GROUP BY 1, 2, 3),
qg AS (SELECT d, query, sku_group_id, sum(og) AS og, sum(ig) AS ig, sum(gg) AS gg FROM so JOIN gen USING (d, order_item_id) GROUP BY d, query, sku_group_id),
qs AS (SELECT d, query, sku_group_id, sum(ri) AS ri, sum(rg) AS rg, sum(ro) AS ro, sum(ci) AS ci, sum(co) AS co, sum(cg) AS cg
  FROM so JOIN stats USING (d, order_item_id) GROUP BY d, query, sku_group_id)
SELECT d AS date, query, sku_group_id, CAST(coalesce(og, 0) AS BIGINT) AS orders_generated, CAST(coalesce(ig, 0) AS BIGINT) AS items_generated,
  CAST(coalesce(gg, 0) AS DOUBLE) AS gmv_generated, CAST(coalesce(ci, 0) AS BIGINT) AS items_completed, CAST(coalesce(cg, 0) AS DOUBLE) AS gmv_completed,
  CAST(coalesce(co, 0) AS BIGINT) AS completed_orders, CAST(coalesce(ri, 0) AS BIGINT) AS returned_items, CAST(coalesce(rg, 0) AS DOUBLE) AS returned_gmv,
  CAST(coalesce(ro, 0) AS BIGINT) AS returned_orders
FROM qs FULL JOIN qg USING (d, query, sku_group_id) WHERE coalesce(ri, 0) + coalesce(ci, 0) + coalesce(ig, 0) > 0"""

AD_DAILY_SQL = """
SELECT date, CAST(sku_group_id AS BIGINT) AS sku_group_id, CAST(sum(CAST(impressions AS DOUBLE)) AS BIGINT) AS ad_impressions,
  CAST(sum(CAST(clicks AS DOUBLE)) AS BIGINT) AS ad_clicks, sum(CAST(adrev AS DOUBLE)) AS ad_revenue
FROM v_ad_funnel WHERE sku_group_id IS NOT NULL AND CAST(sku_group_id AS BIGINT) > 0 GROUP BY 1, 2"""

_price = lambda k: (
    f"CAST(sum({k}_price_eod) AS DOUBLE) / count({k}_price_eod) AS avg_{k}_price_eod, quantile_disc(CAST({k}_price_eod AS DOUBLE), 0.5) AS median_{k}_price_eod,"
    f" CAST(min({k}_price_eod) AS DOUBLE) AS min_{k}_price_eod, CAST(max({k}_price_eod) AS DOUBLE) AS max_{k}_price_eod"
)
PRICES_SQL = f"""
SELECT dt AS date, sku_group_id, {_price('sell')}, {_price('full')} FROM v_sku_eod e JOIN v_sku s ON s.id = e.sku_id
WHERE sku_group_id IS NOT NULL GROUP BY dt, sku_group_id"""

STOCK_SQL = "SELECT dt AS date, sku_id, CAST(sum(quantity_active_eod) AS BIGINT) AS total_stock FROM v_sku_eod WHERE sku_id IS NOT NULL GROUP BY dt, sku_id"


def _legacy_side(types: str, conv: str, name: str) -> str:
    return f"""
  SELECT date, platform, skg AS sku_group_id, CASE WHEN query IS NULL THEN pq ELSE lower(query) END AS query,
    count(DISTINCT CASE WHEN event_type = 'PRODUCT_IMPRESSION' AND widget_section_name = 'SEARCH_RESULTS' THEN session_id END) AS imps,
    count(DISTINCT CASE WHEN event_type = '{conv}' AND pl = 'SEARCH_RESULTS' THEN session_id END) AS {name}
  FROM (SELECT *, lag(lower(query), 1, '0') OVER w AS pq, lag(widget_section_name, 1, '0') OVER w AS pl FROM e WHERE event_type IN ({types})
        WINDOW w AS (PARTITION BY date, session_id, skg ORDER BY logged_at, event_id)) x
  GROUP BY 1, 2, 3, 4"""


CONVERSIONS_SQL = f"""
WITH e AS (SELECT c.*, CAST(received_at AS DATE) AS date, CASE WHEN c.sku_group_id IS NULL THEN s.sku_group_id ELSE c.sku_group_id END AS skg
  FROM v_clicks c LEFT JOIN v_sku s ON c.sku_id = s.id
  WHERE event_type IN ('PRODUCT_IMPRESSION', 'PRODUCT_VIEW', 'ADD_TO_CART', '') AND install_id IS NOT NULL AND session_id IS NOT NULL),
cl AS ({_legacy_side("'PRODUCT_IMPRESSION', 'PRODUCT_VIEW', 'ADD_TO_CART', ''", 'PRODUCT_VIEW', 'clicks')}),
ca AS ({_legacy_side("'PRODUCT_IMPRESSION', 'ADD_TO_CART'", 'ADD_TO_CART', 'atcs')}),
od AS (SELECT a.date, a.query, a.platform, s.sku_group_id, count(DISTINCT a.order_item_id) AS n
  FROM (SELECT DISTINCT order_item_id, CAST(generated_at AS DATE) AS date, query, last_atc_platform AS platform FROM v_attribution WHERE widget_section_name = 'SEARCH_RESULTS') a
  JOIN (SELECT order_item_id, CAST(generated_at AS DATE) AS date, sku_id FROM v_order_items WHERE order_item_status NOT IN ('CREATED', 'NOT_CREATED')) o
    ON a.order_item_id = o.order_item_id AND a.date = o.date
  LEFT JOIN v_sku s ON o.sku_id = s.id GROUP BY 1, 2, 3, 4)
SELECT cl.date, trim(cl.query) AS query, cl.platform, CAST(cl.sku_group_id AS BIGINT) AS sku_group_id, CAST(cl.imps AS BIGINT) AS uniq_impressions,
  CAST(clicks AS BIGINT) AS uniq_clicks, CAST(atcs AS BIGINT) AS uniq_atcs, CAST(coalesce(n, 0) AS BIGINT) AS uniq_orders
FROM cl JOIN ca USING (date, query, platform, sku_group_id) LEFT JOIN od USING (date, query, platform, sku_group_id)
WHERE cl.sku_group_id IS NOT NULL AND cl.platform IS NOT NULL AND trim(cl.query) <> '0' AND trim(cl.query) <> '' AND cl.imps <> 0"""

TOP_QUERIES_SQL = """
WITH u AS (SELECT * FROM v_ranking WHERE fired_at >= TIMESTAMP '2024-01-17' AND fired_at < TIMESTAMP '2024-01-31' AND model_name = 'search_unified_model_v9' AND len(ranking_candidates) > 0),
i AS (SELECT search_query, count(DISTINCT install_id) AS n FROM u GROUP BY search_query),
c AS (SELECT search_query, unnest(ranking_candidates) AS sku_group_id FROM u),
m AS (SELECT DISTINCT sku_group_id, product_id FROM v_sku),
p AS (SELECT DISTINCT product_id, c.search_query, n FROM c JOIN m USING (sku_group_id) JOIN i ON i.search_query IS NOT DISTINCT FROM c.search_query),
r AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY n DESC, search_query NULLS FIRST) AS rn FROM p)
SELECT DATE '2024-01-31' AS date, product_id, list(search_query ORDER BY rn) AS search_queries FROM r WHERE rn <= 200 GROUP BY product_id"""

_SCORES = """
scores AS (SELECT fired_at, query, unnest(ranking_candidates) AS sku_group_id, unnest(s) AS score FROM (
  SELECT fired_at, search_query AS query, ranking_candidates,
    CASE WHEN dssm_array IS NOT NULL THEN CASE WHEN len(dssm_array) = len(ranking_candidates) THEN dssm_array END
         ELSE list_transform(ranking_candidates, lambda x: dssm_scalar) END AS s
  FROM v_ranking WHERE model_name LIKE '%search_uni%' AND len(ranking_candidates) > 0 AND search_query IS NOT NULL AND trim(search_query) <> '' AND has_features) q
  WHERE s IS NOT NULL),
daily AS (SELECT * FROM (SELECT CAST(fired_at AS DATE) AS date, query, sku_group_id, score,
  row_number() OVER (PARTITION BY CAST(fired_at AS DATE), query, sku_group_id ORDER BY fired_at DESC, score DESC) AS rn FROM scores) x WHERE rn = 1)"""

SCORE_LOG_SQL = f"""
WITH {_SCORES.strip()}
SELECT n.date, n.query, n.sku_group_id, TIMESTAMP '2024-01-17 02:00:00' AS collected_at, n.score AS dssm_score
FROM (SELECT * FROM daily WHERE date = DATE '2024-01-16') n LEFT JOIN (SELECT * FROM daily WHERE date = DATE '2024-01-15') o USING (query, sku_group_id)
WHERE o.score IS NULL OR (o.score = 0 AND abs(n.score) > 0) OR (o.score <> 0 AND abs(n.score - o.score) / abs(nullif(o.score, 0)) >= 0.05)"""

CANDIDATES_SQL = """
WITH cq AS (SELECT DISTINCT lower(trim(replace(query, 'ё', 'е'))) AS sq, CAST(sku_group_id AS BIGINT) AS sku_group_id FROM v_clicks
  WHERE logged_at >= TIMESTAMP '2024-01-20' AND logged_at < TIMESTAMP '2024-01-21' AND received_at >= TIMESTAMP '2024-01-20' AND received_at < TIMESTAMP '2024-01-21'
    AND event_type = 'PRODUCT_IMPRESSION' AND widget_space_name = 'SEARCH_RESULTS' AND widget_section_name = 'SEARCH_RESULTS' AND query IS NOT NULL
    AND trim(query) <> '' AND NOT coalesce(is_full_catpred, false) AND sku_group_id IS NOT NULL),
st AS (SELECT CASE WHEN corrected_query_text = '' OR corrected_query_text IS NULL THEN lower(trim(replace(query_text, 'ё', 'е'))) ELSE lower(trim(replace(corrected_query_text, 'ё', 'е'))) END AS sq,
    result_query_text, install_id FROM v_search_logs WHERE logged_at >= TIMESTAMP '2024-01-19' AND logged_at < TIMESTAMP '2024-01-21' AND query_text <> ''),
fs AS (SELECT sq, result_query_text FROM st GROUP BY 1, 2 HAVING count(DISTINCT install_id) >= 2)
SELECT DATE '2024-01-20' AS date, result_query_text AS query, list_sort(list(DISTINCT sku_group_id)) AS sku_group_ids
FROM cq JOIN fs USING (sq) WHERE result_query_text IS NOT NULL AND trim(result_query_text) <> '' GROUP BY result_query_text"""

RELEVANCE_SQL = f"""
WITH cand AS ({CANDIDATES_SQL.strip()}),
pairs AS (SELECT query, unnest(sku_group_ids) AS sku_group_id FROM cand),
items AS (SELECT sku_group_id, min(product_id) AS product_id, min(title) AS title, min(type_title) AS type_title, CAST(min(sell_price) AS DOUBLE) AS sell_price, count(*) AS n_skus FROM v_sku GROUP BY sku_group_id),
long AS (SELECT sku_group_id, 'title' AS field, string_split(lower(title), ' ') AS w FROM items UNION ALL SELECT sku_group_id, 'type_title', string_split(lower(type_title), ' ') FROM items),
fst AS (SELECT field, count(*) AS n, CAST(sum(len(w)) AS DOUBLE) / count(*) AS avgdl FROM long WHERE len(w) > 0 GROUP BY field),
post AS (SELECT sku_group_id, field, term, count(*) AS f, any_value(dl) AS dl FROM (SELECT sku_group_id, field, len(w) AS dl, unnest(w) AS term FROM long) x GROUP BY 1, 2, 3),
df AS (SELECT field, term, count(*) AS df FROM post GROUP BY 1, 2),
qt AS (SELECT DISTINCT query, sku_group_id, unnest(string_split(lower(query), ' ')) AS term FROM pairs),
sc AS (SELECT query, qt.sku_group_id, field, term,
    ln(1.0 + (n - df + 0.5) / (df + 0.5)) * (f / (f + CAST('1.2' AS DOUBLE) * (CAST('0.5' AS DOUBLE) + CAST('0.5' AS DOUBLE) * dl / avgdl))) AS s
  FROM qt JOIN post USING (sku_group_id, term) JOIN df USING (field, term) JOIN fst USING (field)),
g AS (SELECT query, sku_group_id, coalesce(list(s ORDER BY term) FILTER (WHERE field = 'title'), []) AS a, coalesce(list(s ORDER BY term) FILTER (WHERE field = 'type_title'), []) AS b FROM sc GROUP BY 1, 2)
SELECT DATE '2024-01-20' AS date, query, sku_group_id, product_id, sell_price, CAST(n_skus AS DOUBLE) AS n_skus_field,
  list_transform(a, lambda x: round(x, 6)) AS bm25_title, list_transform(b, lambda x: round(x, 6)) AS bm25_type_title,
  round(coalesce(list_sum(a), 0) + coalesce(list_sum(b), 0), 6) AS bms, round(coalesce(list_sum(a), 0) + coalesce(list_sum(b), 0) + n_skus, 6) AS total_score
FROM g JOIN items USING (sku_group_id)"""

LIFETIME_SQL = """
SELECT DATE '2024-01-31' AS date, account_id, first_created_on AS first_order_date_ever, first_order_id AS first_order_id_ever, first_issued_on AS first_issued_order_date,
  first_issued_payment_type, first_issued_installment_type AS first_issued_paymart_type, registered_on AS registration_date, first_session_on AS first_session_date,
  first_city_id, first_delivery_point_type, source_type AS acquisition_source_type, campaign_type AS acquisition_campaign_type, accounts_per_install AS accounts_per_install_current
FROM v_accounts WHERE account_id > 0 AND first_created_on > DATE '1970-01-01' AND last_created_on >= DATE '2024-01-31' - 200"""

DISCOUNTS_SQL = """
SELECT date, sku_id, promotion_id, CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(calculated_for_price AS DOUBLE) AS calculated_for_price, created_at FROM (
  SELECT CAST(created_at AS DATE) AS date, *, row_number() OVER (PARTITION BY CAST(created_at AS DATE), sku_id, promotion_id
    ORDER BY created_at DESC, discount_amount DESC, calculated_for_price DESC) AS rn
  FROM v_discount WHERE starts_with(promotion_id, 'dyno_pricing_') AND created_at >= TIMESTAMP '2024-01-26' AND created_at < TIMESTAMP '2024-02-01') x WHERE rn = 1"""

_FLAGS = """count(DISTINCT order_id) FILTER (WHERE st <> 'ACTIVE') AS t, count(DISTINCT order_id) FILTER (WHERE st = 'COMPLETED') AS c,
  count(DISTINCT order_id) FILTER (WHERE st = 'RETURNED NO SHOW') AS n"""


def _completion_sql(key: str) -> str:
    return f"""
SELECT DATE '2024-01-31' AS date, {key}, CAST(c AS DOUBLE) / t AS part_completed_orders, CAST(n AS DOUBLE) / t AS part_no_show_from_total FROM (
  SELECT {key}, {_FLAGS} FROM (SELECT *, real_order_item_status AS st FROM v_history) h
  WHERE generated_at > TIMESTAMP '2023-10-03' AND return_cause NOT IN {CAUSES} AND {key} IS NOT NULL GROUP BY {key}) x WHERE t > 0"""


CATEGORY_SQL = f"""
WITH oi AS (SELECT order_id, real_order_item_status AS st, h.category_id AS leaf, l1_category, l2_category, l3_category, l4_category
  FROM v_history h LEFT JOIN v_category c ON c.id = h.category_id
  WHERE generated_at > TIMESTAMP '2023-10-03' AND return_cause NOT IN {CAUSES} AND h.category_id IS NOT NULL),
lv AS ({' UNION ALL '.join(f"SELECT order_id, st, '{n}' AS category_level, {c} AS category_id FROM oi WHERE {c} > 0" for n, c in
       (('leaf', 'leaf'), ('l1', 'l1_category'), ('l2', 'l2_category'), ('l3', 'l3_category'), ('l4', 'l4_category')))}),
g AS (SELECT category_level, category_id, {_FLAGS} FROM lv GROUP BY 1, 2)
SELECT DATE '2024-01-31' AS date, category_level, category_id, CAST(c AS DOUBLE) / t AS part_completed_orders, CAST(n AS DOUBLE) / t AS part_no_show_from_total FROM g WHERE t > 0"""


def _cpi(part: str, cost: str, units: str) -> str:
    over = f" OVER (PARTITION BY {part})" if part else ""
    return f"{f'sum({cost}){over}' if part else cost} / nullif({f'sum({units}){over}' if part else units}, 0)"


COST_SQL = f"""
WITH c AS (SELECT order_item_id, CASE WHEN isnan(forward_cost) THEN 0.0 ELSE coalesce(forward_cost, 0.0) END AS fwd, CASE WHEN isnan(reverse_cost) THEN 0.0 ELSE coalesce(reverse_cost, 0.0) END AS rev
  FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY order_issued_at DESC, forward_cost NULLS FIRST, reverse_cost) AS rn FROM v_costs
    WHERE order_created_at >= TIMESTAMP '2023-11-02' AND order_created_at < TIMESTAMP '2024-01-31' AND account_id IS NOT NULL AND account_id <> 0) x WHERE rn = 1),
i AS (SELECT order_item_id, city_id, region_id, CASE WHEN dimensional_group IN ('SMALL', 'MEDIUM', 'LARGE') THEN dimensional_group ELSE 'SMALL' END AS dimensional_group,
  CASE WHEN delivered_at IS NOT NULL OR (delivery_type = 'COURIER' AND issued_at IS NOT NULL) THEN item_quantity ELSE 0 END AS nd,
  CASE WHEN returned_at IS NOT NULL AND (delivered_at IS NOT NULL OR issued_at IS NOT NULL) THEN item_quantity ELSE 0 END AS nr
  FROM v_order_items o LEFT JOIN v_sku s ON s.id = o.sku_id WHERE generated_at >= TIMESTAMP '2023-11-02' AND generated_at < TIMESTAMP '2024-01-31' AND city_id IS NOT NULL),
b AS (SELECT city_id, dimensional_group, min(region_id) AS region_id, sum(fwd) AS f, sum(rev) AS r, CAST(sum(nd) AS BIGINT) AS n_items_delivered, CAST(sum(nr) AS BIGINT) AS n_items_reverse
  FROM i JOIN c USING (order_item_id) GROUP BY 1, 2)
SELECT DATE '2024-01-31' AS date, city_id, dimensional_group, region_id, n_items_delivered, n_items_reverse,
  {_cpi('', 'f', 'n_items_delivered')} AS cpi_forward_uzs, {_cpi('', 'r', 'n_items_reverse')} AS cpi_reverse_uzs,
  {_cpi('region_id, dimensional_group', 'f', 'n_items_delivered')} AS cpi_forward_region_uzs, {_cpi('region_id, dimensional_group', 'r', 'n_items_reverse')} AS cpi_reverse_region_uzs,
  {_cpi('dimensional_group', 'f', 'n_items_delivered')} AS cpi_forward_country_uzs, {_cpi('dimensional_group', 'r', 'n_items_reverse')} AS cpi_reverse_country_uzs FROM b"""


def round_cols(sql: str, cols: list[str], digits: int = 6) -> str:
    """Wrap an oracle query so the named columns are rounded."""
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {digits}) AS {c}' for c in cols)}) FROM ({sql.strip()}) zz"


def _relevance_rounded(v):
    df = relevance(v)
    arrays = {c: F.transform(c, lambda x: F.round(x, 6)).alias(c) for c in ("bm25_title", "bm25_type_title")}
    return df.select(*[arrays.get(c, F.round(c, 6).alias(c) if c in ("bms", "total_score") else F.col(c)) for c in df.columns])


SILVER = {
    **{
        f"t01_account_l{n}_events": (
            lambda v, n=n: search.account_category_events(v.clickstream, v.product, v.category, *CLICK_DAYS, n),
            _account_level(n),
        )
        for n in (1, 2, 3)
    },
    "t02_item_orders": (lambda v: items.item_orders(v.order_items, v.sku, *ORDER_DAYS), ITEM_ORDERS_SQL),
    "t03_ad_revenue_daily": (lambda v: rounded(ad_daily(v)), round_cols(AD_DAILY_SQL, ["ad_revenue"])),
    "t04_item_prices": (item_prices, PRICES_SQL),
    "t05_sku_stock_daily": (stock, STOCK_SQL),
    "t06_search_funnel_daily": (funnel, FUNNEL_SQL),
    "t07_product_top_queries": (
        lambda v: search.product_top_queries(v.ranking_events, v.sku, datetime(2024, 1, 31)), TOP_QUERIES_SQL,
    ),
    "t08_query_item_daily_conversions": (conversions, CONVERSIONS_SQL),
    "t09_query_item_orders": (query_orders, QUERY_ORDERS_SQL),
    "t10_score_change_log": (score_log, SCORE_LOG_SQL),
    "t10b_score_log_by_state": (score_log_by_state, SCORE_LOG_SQL),
    "t11_query_candidates": (candidates, CANDIDATES_SQL),
    "t12_account_lifetime_facts": (lifetime, LIFETIME_SQL),
    "t13_daily_discounts": (discounts, DISCOUNTS_SQL),
    "t14_completion_by_category": (
        lambda v: items.completion_by_category(v.history_order_items, v.category, D), CATEGORY_SQL,
    ),
    "t15_completion_by_city": (
        lambda v: items.completion_by(v.history_order_items, "order_city_id", D), _completion_sql("order_city_id"),
    ),
    "t16_completion_by_region": (
        lambda v: items.completion_by(v.history_order_items, "order_region_id", D), _completion_sql("order_region_id"),
    ),
    "t17_delivery_unit_cost": (unit_costs, COST_SQL),
    "t23_relevance_features": (_relevance_rounded, RELEVANCE_SQL),
}
