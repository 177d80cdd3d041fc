"""Oracle SQL of the hexagon tables, on the same grid arithmetic."""

from __future__ import annotations

import math

from featuremill.functions.hexgrid import EARTH_M, edge_m
from featuremill.plans.geo import CONTRACT_COPIES, PARENT_LEVELS, POI_CATEGORIES, RINGS, WINDOWS
from registry.views_sql import cell

DS = "DATE '2024-01-31'"


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


_M = EARTH_M * math.pi / 180.0
LAT = lambda r: f"({dbl(edge_m(9) * 1.5 / _M)} * ({r}))"
LON = lambda q, r: f"({dbl(edge_m(9) * math.sqrt(3.0) / _M)} * (({q}) + ({r}) / CAST(2 AS DOUBLE)))"


def cell_of_sql(source: str, lat: str, lon: str, level: int, out: str) -> str:
    """SELECT source.*, <cell of the point> AS out."""
    s = dbl(edge_m(level))
    return f"""
SELECT * EXCLUDE (x_, y_, qf, rf, sf, rq, rr, rs, dq_, dr_, ds_),
  {cell("CASE WHEN dq_ > dr_ AND dq_ > ds_ THEN -rr - rs ELSE rq END", "CASE WHEN dq_ > dr_ AND dq_ > ds_ THEN rr WHEN dr_ > ds_ THEN -rq - rs ELSE rr END")} AS {out}
FROM (SELECT *, abs(rq - qf) AS dq_, abs(rr - rf) AS dr_, abs(rs - sf) AS ds_ FROM (
  SELECT *, floor(qf + 0.5e0) AS rq, floor(rf + 0.5e0) AS rr, floor(sf + 0.5e0) AS rs FROM (SELECT *, -qf - rf AS sf FROM (
  SELECT *, x_ * {dbl(math.sqrt(3.0) / 3.0)} - y_ / CAST(3 AS DOUBLE) AS qf, y_ * CAST(2 AS DOUBLE) / CAST(3 AS DOUBLE) AS rf FROM (
  SELECT *, ({lon}) * {dbl(_M)} / {s} AS x_, ({lat}) * {dbl(_M)} / {s} AS y_ FROM {source}) a) b) c) d) e"""


ACTIVITY_SQL = f"""
WITH c AS (SELECT DISTINCT q, r, h3_index FROM v_hex_activity WHERE day BETWEEN {DS} - 89 AND {DS}),
n AS (SELECT h3_index, c.q + dq AS q, c.r + dr AS r, ring FROM c CROSS JOIN v_off)
SELECT {DS} AS date, n.h3_index, {', '.join(f"CAST(coalesce(sum(CASE WHEN ring <= {r} AND date_diff('day', day, {DS}) BETWEEN 0 AND {w - 1} THEN daily_{m} END), 0) AS BIGINT) AS {m}_r{r}_{w}d" for m in ('views', 'orders') for r in RINGS for w in WINDOWS)}
FROM n JOIN (SELECT q, r, day, daily_views, daily_orders FROM v_hex_activity WHERE day BETWEEN {DS} - 89 AND {DS}) a USING (q, r) GROUP BY n.h3_index"""

LOCATION_SQL = f"""
WITH u AS (SELECT h3_index, q, r, report_date, count(*) AS users FROM v_locations
  WHERE report_date = (SELECT max(report_date) FROM v_locations WHERE report_date <= {DS}) GROUP BY 1, 2, 3, 4),
n AS (SELECT h3_index, u.q + dq AS q, u.r + dr AS r, ring FROM u CROSS JOIN v_off)
SELECT {DS} AS date, n.h3_index, (SELECT max(report_date) FROM u) AS report_date, {', '.join(f'CAST(coalesce(sum(CASE WHEN ring <= {r} THEN users END), 0) AS BIGINT) AS users_r{r}' for r in RINGS)}
FROM n LEFT JOIN (SELECT q, r, users FROM u) d USING (q, r) GROUP BY n.h3_index"""

_PARENT_CTES = ",\n".join(
    f"b{lv} AS ({cell_of_sql('b', LAT('r'), LON('q', 'r'), lv, 'p')}), pp{lv} AS (SELECT p, sum(population) AS population_l{lv}, sum(traffic_index) AS traffic_l{lv} FROM b{lv} GROUP BY p),"
    f" c{lv} AS ({cell_of_sql('cand', LAT('r'), LON('q', 'r'), lv, 'p')})"
    for lv in PARENT_LEVELS
)
DEMOGRAPHY_SQL = f"""
WITH b AS (SELECT * FROM v_demography WHERE population > 0 OR traffic_index > 0),
cand AS (SELECT DISTINCT b.q + dq AS q, b.r + dr AS r FROM b CROSS JOIN v_off),
{_PARENT_CTES},
n AS (SELECT c.q AS cq, c.r AS cr, c.q + dq AS q, c.r + dr AS r, ring FROM cand c CROSS JOIN v_off),
s AS (SELECT cq AS q, cr AS r, {', '.join(f"coalesce(sum(CASE WHEN ring <= {k} THEN {c} END), 0) AS {o}_r{k}" for c, o in (('population', 'population'), ('traffic_index', 'pedestrian_traffic_index')) for k in RINGS)}
  FROM n LEFT JOIN b USING (q, r) GROUP BY cq, cr)
SELECT {DS} AS date, {cell('s.q', 's.r')} AS h3_index, lower(to_hex({cell('s.q', 's.r')})) AS h3_string, CAST(NULL AS VARCHAR) AS region,
  {', '.join(f'CAST(population_r{k} AS DOUBLE) AS population_r{k}, round(pedestrian_traffic_index_r{k}, 4) AS pedestrian_traffic_index_r{k}' for k in RINGS)},
  {', '.join(f'coalesce(population_l{lv}, CAST(0 AS DOUBLE)) AS population_l{lv}, round(coalesce(traffic_l{lv}, CAST(0 AS DOUBLE)), 4) AS pedestrian_traffic_index_l{lv}' for lv in PARENT_LEVELS)}
FROM s {' '.join(f'JOIN c{lv} ON c{lv}.q = s.q AND c{lv}.r = s.r LEFT JOIN pp{lv} ON pp{lv}.p = c{lv}.p' for lv in PARENT_LEVELS)}"""

_POI_LIST = ", ".join(f"'{v}'" for v in POI_CATEGORIES.values())
POI_SQL = f"""
WITH b AS (SELECT q, r, category_sub, count(*) AS cnt FROM v_poi WHERE CAST(inserted_at AS DATE) = (SELECT max(CAST(inserted_at AS DATE)) FROM v_poi) AND category_sub IN ({_POI_LIST}) GROUP BY 1, 2, 3),
cand AS (SELECT DISTINCT b.q + dq AS q, b.r + dr AS r FROM b CROSS JOIN v_off),
n AS (SELECT c.q AS cq, c.r AS cr, c.q + dq AS q, c.r + dr AS r, ring FROM cand c CROSS JOIN v_off)
SELECT {DS} AS date, {cell('cq', 'cr')} AS h3_index, {', '.join(f"CAST(coalesce(sum(CASE WHEN ring <= {r} AND category_sub = '{v}' THEN cnt END), 0) AS BIGINT) AS {k}_r{r}" for k, v in POI_CATEGORIES.items() for r in RINGS)}
FROM n LEFT JOIN b USING (q, r) GROUP BY cq, cr"""

_DIST = (
    f"(2 * {dbl(EARTH_M)} * asin(least(sqrt(pow(sin(radians(n.lat - t.lat) / 2), 2) + cos(radians(t.lat)) * cos(radians(n.lat))"
    " * pow(sin(radians(n.lon - t.lon) / 2), 2)), 1)))"
)


def _near(flag: str) -> str:
    m = f"coalesce(min(CASE WHEN {flag} THEN d END), 10000)"
    return f"round(CASE WHEN {m} = 0 THEN 10000 ELSE {m} END, 3)"


NEIGHBOUR_SQL = f"""
WITH op AS (SELECT delivery_point_id, min(CAST(issued_at AS DATE)) AS od FROM v_order_items WHERE issued_at IS NOT NULL AND delivery_point_id <> 0 GROUP BY 1),
dpo AS (SELECT delivery_point_id AS id, CAST(generated_at AS DATE) AS date, count(DISTINCT order_id) AS n, sum(CAST(gmv_generated AS DOUBLE) * usd_rate) AS usd
  FROM v_order_items JOIN v_rates x ON x.date = CAST(generated_at AS DATE) WHERE order_item_status IN ('COMPLETED', 'RETURNED') AND delivery_point_id <> 0
    AND CAST(generated_at AS DATE) BETWEEN {DS} - 89 AND {DS} GROUP BY 1, 2),
t AS (SELECT DISTINCT p.q + dq AS q, p.r + dr AS r, {LAT('p.r + dr')} AS lat, {LON('p.q + dq', 'p.r + dr')} AS lon FROM v_points p CROSS JOIN v_off),
n AS (SELECT id, q, r, {LAT('r')} AS lat, {LON('q', 'r')} AS lon, type IN ('DELIVERY_POINT', 'FRANCHISE') AS isd, type = 'UZ_POST' AS iss, od FROM v_points LEFT JOIN op ON op.delivery_point_id = id),
cp AS (SELECT t.q, t.r, n.id, isd, iss, ring, {_DIST} AS d FROM t CROSS JOIN v_off JOIN n ON n.q = t.q + dq AND n.r = t.r + dr WHERE n.od <= {DS}),
md AS (SELECT q, r, {_near('isd')} AS md1, {_near('iss')} AS md2 FROM cp GROUP BY q, r),
sf AS (SELECT q, r,
    {', '.join(f"sum(CASE WHEN ring <= {k} AND age <= {w} THEN n ELSE 0 END) AS o{k}_{w}, sum(CASE WHEN ring <= {k} AND age <= {w} THEN usd ELSE 0 END) AS g{k}_{w}, count(DISTINCT CASE WHEN ring <= {k} AND age <= {w} AND isd THEN cp.id END) AS u{k}_{w}" for k in RINGS for w in WINDOWS)}
  FROM cp JOIN (SELECT *, date_diff('day', date, {DS}) AS age FROM dpo) o ON o.id = cp.id WHERE age BETWEEN 1 AND 90 GROUP BY q, r)
SELECT {DS} AS date, {cell('t.q', 't.r')} AS h3_index, lower(to_hex({cell('t.q', 't.r')})) AS h3_string, coalesce(md1, CAST(10000 AS DOUBLE)) AS min_dist_to_dp_m, coalesce(md2, CAST(10000 AS DOUBLE)) AS min_dist_to_inshop_m,
  {', '.join(f"CAST(coalesce(o{k}_{w}, 0) AS BIGINT) AS orders_r{k}_h{w}, round(coalesce(g{k}_{w}, CAST(0 AS DOUBLE)), 4) AS gmv_r{k}_h{w}, CAST(coalesce(u{k}_{w}, 0) AS BIGINT) AS unique_dp_r{k}_h{w}" for k in RINGS for w in WINDOWS)}
FROM t LEFT JOIN md ON md.q = t.q AND md.r = t.r LEFT JOIN sf ON sf.q = t.q AND sf.r = t.r"""

_geo_num = [f"population_r{k}" for k in RINGS] + [f"pedestrian_traffic_index_r{k}" for k in RINGS]
_geo_num += [f"population_l{lv}" for lv in PARENT_LEVELS] + [f"pedestrian_traffic_index_l{lv}" for lv in PARENT_LEVELS]
_nbr_num = [f"{m}_r{k}_h{w}" for m in ("orders", "gmv", "unique_dp") for k in RINGS for w in WINDOWS]
_act_num = [f"{m}_r{k}_{w}d" for m in ("views", "orders") for k in RINGS for w in WINDOWS]
_loc_num = [f"users_r{k}" for k in RINGS]
_poi_num = [f"{c}_r{k}" for c in POI_CATEGORIES for k in RINGS]
MART_SQL = f"""
WITH j AS (SELECT * FROM (SELECT * EXCLUDE (date) FROM o_demo) FULL JOIN (SELECT * EXCLUDE (date, h3_string) FROM o_near) USING (h3_index)
  FULL JOIN (SELECT * EXCLUDE (date) FROM o_act) USING (h3_index) FULL JOIN (SELECT * EXCLUDE (date) FROM o_loc) USING (h3_index) FULL JOIN (SELECT * EXCLUDE (date) FROM o_poi) USING (h3_index))
SELECT {DS} AS date, h3_index, h3_string, coalesce(region, 'UNKNOWN') AS region, report_date,
  coalesce(min_dist_to_dp_m, 10000) AS min_dist_to_dp_m, coalesce(min_dist_to_inshop_m, 10000) AS min_dist_to_inshop_m,
  {', '.join(f'coalesce({c}, 0) AS {c}' for c in _geo_num + _nbr_num + _act_num + _loc_num + _poi_num)},
  {', '.join(f'coalesce({src}, 0) AS {dst}' for dst, src in CONTRACT_COPIES.items())},
  round(coalesce(pedestrian_traffic_index_r2 - pedestrian_traffic_index_r1, 0), 3) AS traffic_ring_1_2,
  round(coalesce(orders_r5_h90 / (unique_dp_r5_h90 + CAST('1e-05' AS DOUBLE)), 0), 4) AS orders_per_dp_r5_h90
FROM j"""
