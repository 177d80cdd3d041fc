"""Queries on the public grid, and their SQL.

The SQL finds a cell by its own way: no steps over sides of faces, but the middle of each neighbouring place as a point on the
sphere, located anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.functions import geogrid, hexgrid
from featuremill.operators.grids import PublicGrid
from featuremill.plans import geo
from featuremill.sources.star_views import StarViews
from registry.geo_sql import _DIST, DS, LAT, LON, _near, dbl
from registry.gold_queries import D, _DIGITS, _geo_rounded, point_orders

GRID = PublicGrid(9)
#: The plane of the views is laid here; a side between two faces runs through it.
LAT0, LON0 = 41.3, 69.24
PARENTS = (5, 6, 7, 8)


def _moved(cell: Column) -> tuple[Column, Column]:
    return hexgrid.centre_lat(cell) + LAT0, hexgrid.centre_lon(cell) + LON0


def _on_grid(df: DataFrame, cell: str = "h3_index") -> DataFrame:
    """A view with cells of the plane, on the public grid."""
    lat, lon = _moved(F.col(cell))
    return GRID.with_cell(df.withColumns({"_lat": lat, "_lon": lon}), "_lat", "_lon", cell).drop("_lat", "_lon")


def points(v: StarViews) -> DataFrame:
    return v.delivery_points.withColumns({"latitude": F.col("latitude") + LAT0, "longitude": F.col("longitude") + LON0})


def r01b(v: StarViews) -> DataFrame:
    placed = geogrid.with_cells(points(v), F.col("latitude"), F.col("longitude"), {"cell5": 5, "cell9": 9})
    return placed.select("id", "cell5", "cell9", geogrid.cell_text(F.col("cell9")).alias("text9"))


def r02b(v: StarViews) -> DataFrame:
    """Cells and a checksum of their ids, by ring around each cell with data."""
    base = _on_grid(v.demography).groupBy("h3_index").agg(F.sum("population").cast("bigint").alias("population"))
    source = GRID.inner(base.select("h3_index", F.col("h3_index").alias("source")), "h3_index")
    reached = GRID.outer(GRID.scatter(source, "h3_index", 5, "neighbour", "ring"), "neighbour")
    return reached.groupBy("source", "ring").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("neighbour") % 1000003).alias("checksum"))


def r03b(v: StarViews) -> DataFrame:
    cells = _on_grid(v.demography.select("h3_index")).distinct()
    parents = {f"parent{n}": geogrid.parent_cell(F.col("h3_index"), n) for n in PARENTS}
    middle = geogrid.with_places(cells.select("h3_index", *[c.alias(n) for n, c in parents.items()]), "h3_index", "p", 9)
    middle = middle.withColumn("m", geogrid.centre(F.col("p"), 9))
    return middle.select("h3_index", *parents, F.round("m.lat", 7).alias("lat"), F.round("m.lon", 7).alias("lon"))


def t18b(v: StarViews) -> DataFrame:
    return geo.hex_user_activity(_on_grid(v.hex_activity), D, GRID)


def t20b(v: StarViews) -> DataFrame:
    """Population by ring and parent."""
    facts = _on_grid(v.demography).groupBy("h3_index").agg(
        F.sum("population").alias("population"), F.sum(F.col("traffic_index").cast("decimal(18,2)")).cast("double").alias("traffic_index")
    )
    return _geo_rounded(geo.hex_demography(v.stage(facts), D, grid=GRID, stage=v.stage), _DIGITS)


def t22b(v: StarViews) -> DataFrame:
    orders = point_orders(v)
    near = geo.hex_neighbour_orders(orders, points(v), v.rates, D, openings=v.stage(geo.point_openings(orders)), grid=GRID)
    return _geo_rounded(near, _DIGITS)


# --- SQL -------------------------------------------------------------------------------------------------------------------


def _constants() -> str:
    made = geogrid.shape()
    base = [0] * 500
    for (face, i, j), (cell, kind) in made.base.items():
        base[face * 25 + (i + 2) * 5 + j + 2] = cell * 32 + kind
    turned = []
    for sixths in range(6):
        digits = range(7)
        for _ in range(sixths):
            digits = [geogrid.LEFT[d] for d in digits]
        turned += digits
    lists = {
        "centres": "[%s]" % ", ".join("[%s]" % ", ".join(map(dbl, geogrid._sphere(la, lo))) for la, lo, _ in geogrid.FACES),
        "duals": "[%s]" % ", ".join(dbl(x) for own in made.duals for w in own for x in w),
        "corners": "[%s]" % ", ".join(dbl(x) for own in made.faces for c in own for x in made.corners[c]),
        "base": str(base), "turns": str([made.turns[k, d] for k in range(18) for d in range(7)]), "rot": str(turned),
    }
    return "pg AS (SELECT %s)" % ", ".join(f"{v} AS {k}" for k, v in lists.items())


PG = _constants()


def place_sql(source: str, level: int) -> str:
    """SELECT source.*, f_, i_, j_ of the cell that holds the point px, py, pz (of any length)."""
    s = 7 ** (level // 2)
    u, v = ("(2 * x_ + y_)", "(3 * y_ - x_)") if level % 2 else ("x_", "y_")
    w = ", ".join(f"duals[f_ * 9 + {3 * n + 1}] * px + duals[f_ * 9 + {3 * n + 2}] * py + duals[f_ * 9 + {3 * n + 3}] * pz AS w{n}_" for n in range(3))
    return f"""
SELECT * EXCLUDE (a_, b_, c_, u_, v_), CAST(CASE WHEN abs(a_ - u_) > abs(b_ + v_) AND abs(a_ - u_) > abs(c_ - v_ + u_) THEN -b_ - c_ ELSE a_ END AS BIGINT) AS i_,
  CAST(CASE WHEN NOT (abs(a_ - u_) > abs(b_ + v_) AND abs(a_ - u_) > abs(c_ - v_ + u_)) AND abs(b_ + v_) > abs(c_ - v_ + u_) THEN a_ + c_ ELSE -b_ END AS BIGINT) AS j_
FROM (SELECT *, round(u_) AS a_, round(-v_) AS b_, round(v_ - u_) AS c_ FROM (
  SELECT * EXCLUDE (x_, y_), {s} * {u} AS u_, {s} * {v} AS v_ FROM (
  SELECT * EXCLUDE (w0_, w1_, w2_), 2 * (w0_ - w2_) / (w0_ + w1_ + w2_) AS x_, 2 * (w1_ - w2_) / (w0_ + w1_ + w2_) AS y_ FROM (
  SELECT src.*, {w} FROM (SELECT * EXCLUDE (d_), list_position(d_, list_max(d_)) - 1 AS f_ FROM (
    SELECT src.*, list_transform(centres, lambda c: c[1] * px + c[2] * py + c[3] * pz) AS d_ FROM ({source}) src, pg) a) src, pg) b) c) d) e"""


def id_sql(source: str, level: int, out: str) -> str:
    """SELECT source.*, id of the place f_, i_, j_ AS out."""
    sql = f"SELECT *, i_ AS i{level}_, j_ AS j{level}_ FROM ({source}) s"
    for r in range(level, 0, -1):
        (p, q), (s, t) = geogrid._down(r + 1)
        (a, b), (c, d) = geogrid._down(r)
        up = f"SELECT *, CAST(floor(({p} * i{r}_ + {q} * j{r}_ + 3) / 7e0) AS BIGINT) AS i{r - 1}_, CAST(floor(({s} * i{r}_ + {t} * j{r}_ + 3) / 7e0) AS BIGINT) AS j{r - 1}_ FROM ({sql}) s"
        di, dj = f"(i{r}_ - ({a}) * i{r - 1}_ - ({b}) * j{r - 1}_)", f"(j{r}_ - ({c}) * i{r - 1}_ - ({d}) * j{r - 1}_)"
        sql = f"SELECT * EXCLUDE (i{r}_, j{r}_), 4 * {di} + 2 * {dj} - 7 * least({di}, {dj}, 0) AS g{r}_ FROM ({up}) s"
    first = "coalesce(%s)" % ", ".join([f"nullif(g{r}_, 0)" for r in range(1, level + 1)] + ["0"])
    parts = " + ".join(f"CAST(rot[t_ * 7 + g{r}_ + 1] AS BIGINT) * {8 ** (15 - r)}" for r in range(1, level + 1))
    drop = ", ".join([f"g{r}_" for r in range(1, level + 1)] + ["i0_", "j0_", "t_", "e_"])
    fixed = (1 << 59) + (level << 52) + 8 ** (15 - level) - 1
    return f"""
SELECT s.* EXCLUDE ({drop}), (CAST(e_ // 32 AS BIGINT) << 45) + {fixed} + {parts} AS {out} FROM (
  SELECT s.*, turns[(e_ % 32) * 7 + {first} + 1] AS t_ FROM (SELECT s.*, base[f_ * 25 + (i0_ + 2) * 5 + j0_ + 3] AS e_ FROM ({sql}) s, pg) s, pg) s, pg"""


def point_sql(source: str, lat: str, lon: str) -> str:
    la, lo = f"radians({lat})", f"radians({lon})"
    return f"SELECT *, cos({la}) * cos({lo}) AS px, cos({la}) * sin({lo}) AS py, sin({la}) AS pz FROM {source}"


def cell_sql(source: str, lat: str, lon: str, level: int, out: str, keep: bool = False) -> str:
    """SELECT source.*, id AS out; with ``keep`` also the place f_, i_, j_."""
    gone = "px, py, pz" if keep else "px, py, pz, f_, i_, j_"
    return f"SELECT * EXCLUDE ({gone}) FROM ({id_sql(place_sql(point_sql(source, lat, lon), level), level, out)}) x"


def middle_sql(source: str, level: int, di: str = "0", dj: str = "0") -> str:
    """SELECT source.*, px, py, pz of the place f_, i_ + di, j_ + dj."""
    s = geogrid._size(level)
    x, y = ("(3 * ii_ - jj_)", "(ii_ + 2 * jj_)") if level % 2 else ("ii_", "jj_")
    w = [f"({2 * s} + 2 * {x} - {y})", f"({2 * s} - {x} + 2 * {y})", f"({2 * s} - {x} - {y})"]
    at = ", ".join("%s AS p%s" % (" + ".join(f"{w[n]} * corners[f_ * 9 + {3 * n + c + 1}]" for n in range(3)), "xyz"[c]) for c in range(3))
    return f"SELECT s.* EXCLUDE (ii_, jj_), {at} FROM (SELECT *, i_ + ({di}) AS ii_, j_ + ({dj}) AS jj_ FROM {source}) s, pg"


def rings_sql(source: str, level: int = 9) -> str:
    """(cell, f_, i_, j_) to (cell, other, ring) of all cells within five steps."""
    around = f"(SELECT s.*, dq, dr, ring FROM {source} s CROSS JOIN v_off)"
    there = f"SELECT cell, ring, px, py, pz FROM ({middle_sql(around, level, 'dq', '-dr')}) x"
    return f"SELECT cell, other, ring FROM ({id_sql(place_sql(there, level), level, 'other')}) y"


def _lat_lon(q: str = "q", r: str = "r") -> tuple[str, str]:
    return f"({LAT(r)} + {dbl(LAT0)})", f"({LON(q, r)} + {dbl(LON0)})"


_P = f"SELECT id, {_lat_lon()[0]} AS la, {_lat_lon()[1]} AS lo FROM v_points"
R01B_SQL = f"WITH {PG}, p0 AS ({_P}), " + ", ".join(
    f"p{n + 1} AS ({cell_sql(f'p{n}', 'la', 'lo', level, f'cell{level}')})" for n, level in enumerate((5, 9))
) + " SELECT id, cell5, cell9, lower(to_hex(cell9)) AS text9 FROM p2"

_DEMO = f"demo AS ({cell_sql('(SELECT q, r, population, traffic_index FROM v_demography)', *_lat_lon(), 9, 'cell', keep=True)})"
R02B_SQL = f"""WITH {PG}, {_DEMO}, c AS (SELECT DISTINCT cell, f_, i_, j_ FROM demo), n AS ({rings_sql('c')})
SELECT cell AS source, CAST(ring AS INTEGER) AS ring, count(*) AS n, CAST(sum(other % 1000003) AS BIGINT) AS checksum FROM n GROUP BY 1, 2"""

_PARENT = lambda cell, n: f"((({cell}) - ({cell}) % {8 ** (15 - n)}) - (({cell} >> 52) & 15) * {1 << 52} + {(n << 52) + 8 ** (15 - n) - 1})"
R03B_SQL = f"""WITH {PG}, {_DEMO}, c AS (SELECT DISTINCT cell, f_, i_, j_ FROM demo), m AS ({middle_sql('c', 9)})
SELECT cell AS h3_index, {', '.join(f"{_PARENT('cell', n)} AS parent{n}" for n in PARENTS)},
  round(degrees(atan2(pz, sqrt(px * px + py * py))), 7) AS lat, round(degrees(atan2(py, px)), 7) AS lon FROM m"""

T18B_SQL = f"""WITH {PG}, a0 AS (SELECT q, r, day, daily_views, daily_orders FROM v_hex_activity WHERE day BETWEEN {DS} - 89 AND {DS}),
a AS ({cell_sql('a0', *_lat_lon(), 9, 'cell', keep=True)}), c AS (SELECT DISTINCT cell, f_, i_, j_ FROM a), n AS ({rings_sql('c')})
SELECT {DS} AS date, n.cell AS h3_index, {', '.join(f"CAST(coalesce(sum(CASE WHEN ring <= {r} AND date_diff('day', day, {DS}) BETWEEN 0 AND {w - 1} THEN daily_{m} END), 0) AS BIGINT) AS {m}_r{r}_{w}d" for m in ('views', 'orders') for r in geo.RINGS for w in geo.WINDOWS)}
FROM n JOIN a ON a.cell = n.other GROUP BY n.cell"""

_FACTS = (("population", "population"), ("traffic_index", "pedestrian_traffic_index"))
T20B_SQL = f"""WITH {PG}, {_DEMO},
b AS (SELECT cell, f_, i_, j_, sum(population) AS population, sum(CAST(traffic_index AS DECIMAL(18, 2))) AS traffic_index FROM demo WHERE population > 0 OR traffic_index > 0 GROUP BY ALL),
n AS ({rings_sql('b')}),
s AS (SELECT n.other AS cell, {', '.join(f"coalesce(sum(CASE WHEN ring <= {k} THEN {c} END), 0) AS {o}_r{k}" for c, o in _FACTS for k in geo.RINGS)}
  FROM n JOIN b ON b.cell = n.cell GROUP BY n.other),
{', '.join(f"l{n} AS (SELECT {_PARENT('cell', n)} AS p, sum(population) AS population, sum(traffic_index) AS traffic_index FROM b GROUP BY 1)" for n in PARENTS)}
SELECT {DS} AS date, s.cell AS h3_index, lower(to_hex(s.cell)) AS h3_string, CAST(NULL AS VARCHAR) AS region,
  {', '.join(f'CAST(population_r{k} AS DOUBLE) AS population_r{k}, round(CAST(pedestrian_traffic_index_r{k} AS DOUBLE), 4) AS pedestrian_traffic_index_r{k}' for k in geo.RINGS)},
  {', '.join(f'CAST(coalesce(l{n}.population, 0) AS DOUBLE) AS population_l{n}, round(CAST(coalesce(l{n}.traffic_index, 0) AS DOUBLE), 4) AS pedestrian_traffic_index_l{n}' for n in PARENTS)}
FROM s {' '.join(f"LEFT JOIN l{n} ON l{n}.p = {_PARENT('s.cell', n)}" for n in PARENTS)}"""

T22B_SQL = f"""WITH {PG}, op AS (SELECT delivery_point_id, min(CAST(issued_at AS DATE)) AS od FROM v_order_items WHERE issued_at IS NOT NULL AND delivery_point_id <> 0 GROUP BY 1),
dpo AS (SELECT delivery_point_id AS id, CAST(generated_at AS DATE) AS date, count(DISTINCT order_id) AS n, sum(CAST(gmv_generated AS DOUBLE) * usd_rate) AS usd
  FROM v_order_items JOIN v_rates x ON x.date = CAST(generated_at AS DATE) WHERE order_item_status IN ('COMPLETED', 'RETURNED') AND delivery_point_id <> 0
    AND CAST(generated_at AS DATE) BETWEEN {DS} - 89 AND {DS} GROUP BY 1, 2),
p0 AS (SELECT id, type, {_lat_lon()[0]} AS lat, {_lat_lon()[1]} AS lon FROM v_points),
p AS ({cell_sql('p0', 'lat', 'lon', 9, 'cell', keep=True)}),
c AS (SELECT DISTINCT cell, f_, i_, j_ FROM p), r AS ({rings_sql('c')}),
t0 AS (SELECT DISTINCT c.f_, c.i_ + dq AS i_, c.j_ - dr AS j_ FROM c CROSS JOIN v_off),
t1 AS (SELECT DISTINCT ON (cell) cell, mx, my, mz FROM ({id_sql(place_sql("SELECT px AS mx, py AS my, pz AS mz, px, py, pz FROM (" + middle_sql("t0", 9) + ") z", 9), 9, 'cell')}) y),
t AS (SELECT DISTINCT cell, degrees(atan2(pz, sqrt(px * px + py * py))) AS lat, degrees(atan2(py, px)) AS lon FROM ({middle_sql("(" + place_sql("SELECT cell, mx AS px, my AS py, mz AS pz FROM t1", 9).replace("SELECT * EXCLUDE (a_", "SELECT * EXCLUDE (px, py, pz, a_", 1) + ")", 9)}) z),
n AS (SELECT id, cell, lat, lon, type IN ('DELIVERY_POINT', 'FRANCHISE') AS isd, type = 'UZ_POST' AS iss, od FROM p LEFT JOIN op ON op.delivery_point_id = id),
cp AS (SELECT t.cell, n.id, isd, iss, ring, {_DIST} AS d FROM r JOIN t ON t.cell = r.other JOIN n ON n.cell = r.cell WHERE n.od <= {DS}),
md AS (SELECT cell, {_near('isd')} AS md1, {_near('iss')} AS md2 FROM cp GROUP BY cell),
sf AS (SELECT cell,
    {', '.join(f"sum(CASE WHEN ring <= {k} AND age <= {w} THEN n ELSE 0 END) AS o{k}_{w}, sum(CASE WHEN ring <= {k} AND age <= {w} THEN usd ELSE 0 END) AS g{k}_{w}, count(DISTINCT CASE WHEN ring <= {k} AND age <= {w} AND isd THEN cp.id END) AS u{k}_{w}" for k in geo.RINGS for w in geo.WINDOWS)}
  FROM cp JOIN (SELECT *, date_diff('day', date, {DS}) AS age FROM dpo) o ON o.id = cp.id WHERE age BETWEEN 1 AND 90 GROUP BY cell)
SELECT {DS} AS date, t.cell AS h3_index, lower(to_hex(t.cell)) AS h3_string, coalesce(md1, CAST(10000 AS DOUBLE)) AS min_dist_to_dp_m, coalesce(md2, CAST(10000 AS DOUBLE)) AS min_dist_to_inshop_m,
  {', '.join(f"CAST(coalesce(o{k}_{w}, 0) AS BIGINT) AS orders_r{k}_h{w}, round(coalesce(g{k}_{w}, CAST(0 AS DOUBLE)), 4) AS gmv_r{k}_h{w}, CAST(coalesce(u{k}_{w}, 0) AS BIGINT) AS unique_dp_r{k}_h{w}" for k in geo.RINGS for w in geo.WINDOWS)}
FROM t LEFT JOIN md USING (cell) LEFT JOIN sf USING (cell)"""

PUBLIC_GRID = {
    "r01b_public_cells": (r01b, R01B_SQL),
    "r02b_public_rings": (r02b, R02B_SQL),
    "r03b_public_parents": (r03b, R03B_SQL),
    "t18b_public_user_activity": (t18b, T18B_SQL),
    "t20b_public_demography": (t20b, T20B_SQL),
    "t22b_public_neighbour_orders": (t22b, T22B_SQL),
}
