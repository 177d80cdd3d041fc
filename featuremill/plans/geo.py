"""Hexagon features: every builder is a scatter to neighbouring centres and one aggregation.

``grid`` says what the cells are: ids of our plane (the default), or of the public grid, which other tables can be joined to.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.functions.dates import day
from featuremill.functions.ratios import ratio_eps
from featuremill.operators.grids import PLANAR, Grid
from featuremill.operators.rings import ring_sums
from featuremill.sources.scan import latest_snapshot
from featuremill.sources.schema import fill_by_type

RINGS = (0, 1, 2, 3, 4, 5)
WINDOWS = (30, 60, 90)
MAX_RING = max(RINGS)
PARENT_LEVELS = (5, 6, 7, 8)
FAR_AWAY_M = 10000.0
# Categories of points of interest in the source, by output prefix.
POI_CATEGORIES = {
    "atms": "Банкоматы",
    "banks": "Банки",
    "retail_points": "Торговые точки",
    "car_dealers_services": "Автосалоны, Автосервисы",
    "mixed_goods": "Смешанные товары",
    "fast_food_coffee": "Быстрое питание, Кофейни",
    "bakeries": "Пекарни",
}


def hex_user_activity(activity: DataFrame, as_of: date, grid: Grid = PLANAR) -> DataFrame:
    """Views and orders within rings 0..5 and the last 30, 60 and 90 days, per active cell."""
    age = F.datediff(day(as_of), F.col("day"))
    per_cell = activity.where(age.between(0, max(WINDOWS) - 1)).groupBy("h3_index").agg(
        *[
            F.coalesce(F.sum(F.when(age < w, F.col(f"daily_{m}"))), F.lit(0)).alias(f"{m}_{w}")
            for m in ("views", "orders") for w in WINDOWS
        ]
    )
    measures = {f"{m}_{w}": f"{m}_r{{r}}_{w}d" for m in ("views", "orders") for w in WINDOWS}
    return (
        ring_sums(per_cell, "h3_index", measures, RINGS, grid=grid)
        # Centres are the cells with data of their own, which reach themselves at ring 0.
        .where("nearest = 0")
        .select(day(as_of).alias("date"), "h3_index", *_names(measures))
    )


def _names(measures: Mapping[str, str]) -> list[str]:
    return [p.format(r=r) for p in measures.values() for r in RINGS]


def hex_user_location(locations: DataFrame, as_of: date, grid: Grid = PLANAR) -> DataFrame:
    """Users within rings 0..5 on the newest snapshot up to the day."""
    users = (
        latest_snapshot(locations, "report_date", as_of)
        .groupBy("h3_index", "report_date").agg(F.count(F.lit(1)).alias("users"))
    )
    measures = {"users": "users_r{r}"}
    return (
        # All rows are of one snapshot, so its date is also the least one.
        ring_sums(users, "h3_index", measures, RINGS, reduce={"report_date": F.min("report_date")}, grid=grid)
        .where("nearest = 0")
        .select(day(as_of).alias("date"), "h3_index", "report_date", *_names(measures))
    )


def hex_demography(
    demography: DataFrame, as_of: date, regions: DataFrame | None = None, grid: Grid = PLANAR, stage: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Population and foot traffic per cumulative ring for all cells near data, with parent sums.

    ``regions`` (h3_index, region) labels cells; cells without a label get NULL. With ``stage`` the ring sums are written
    before the joins; on the public grid that keeps conditions on the cell from being planned through its arithmetic.
    """
    facts = {"population": "population", "traffic_index": "pedestrian_traffic_index"}
    base = demography.where("population > 0 or traffic_index > 0").select(
        "h3_index", *[F.coalesce(c, F.lit(0.0)).cast("double").alias(c) for c in facts]
    )
    measures = {c: f"{out}_r{{r}}" for c, out in facts.items()}
    out = ring_sums(base, "h3_index", measures, RINGS, "double", grid=grid)
    out = out if stage is None else stage(out)
    for lv in PARENT_LEVELS:
        parent = base.groupBy(grid.parent(F.col("h3_index"), lv).alias("_parent")).agg(
            *[F.sum(c).alias(f"{name}_l{lv}") for c, name in facts.items()]
        )
        out = out.withColumn("_parent", grid.parent(F.col("h3_index"), lv)).join(parent, "_parent", "left").drop("_parent")
    region = F.lit(None).cast("string").alias("region")
    if regions is not None:
        out = out.join(regions.select("h3_index", "region"), "h3_index", "left")
        region = F.col("region")
    return out.select(
        day(as_of).alias("date"), "h3_index", grid.text(F.col("h3_index")).alias("h3_string"), region,
        *_names(measures),
        *[
            F.coalesce(f"{name}_l{lv}", F.lit(0.0)).alias(f"{name}_l{lv}")
            for name in facts.values() for lv in PARENT_LEVELS
        ],
    )


def hex_poi_counts(
    poi: DataFrame, as_of: date, categories: Mapping[str, str] = POI_CATEGORIES, grid: Grid = PLANAR
) -> DataFrame:
    """Points of interest per category and cumulative ring, on the newest snapshot."""
    # The newest day as a range of the raw column, so that files of older days are skipped.
    begins = F.date_trunc("day", poi.select(F.max("inserted_at")).scalar())
    newest = (F.col("inserted_at") >= begins) & (F.col("inserted_at") < begins + F.expr("interval 1 day"))
    here = poi.where(newest).where(F.col("category_sub").isin(*categories.values()))
    per_cell = here.groupBy("h3_index").agg(
        *[F.count_if(F.col("category_sub") == v).alias(k) for k, v in categories.items()]
    )
    measures = {k: f"{k}_r{{r}}" for k in categories}
    return (
        ring_sums(per_cell, "h3_index", measures, RINGS, grid=grid)
        .select(day(as_of).alias("date"), "h3_index", *_names(measures))
    )


def point_openings(order_items: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(delivery_point_id, opened): the day of each point's first issued order.

    With the table as it was (``known``), ``order_items`` need only hold the new
    days: a daily run reads one day instead of the whole history.
    """
    issued = order_items.where((F.col("delivery_point_id") != 0) & F.col("issued_on").isNotNull())
    days = issued.select("delivery_point_id", F.col("issued_on").alias("opened"))
    every = days if known is None else days.unionByName(known)
    return every.groupBy("delivery_point_id").agg(F.min("opened").alias("opened"))


def hex_neighbour_orders(
    order_items: DataFrame,
    delivery_points: DataFrame,
    rates: DataFrame,
    as_of: date,
    point_types: tuple[str, ...] = ("DELIVERY_POINT", "FRANCHISE"),
    in_shop_type: str = "UZ_POST",
    openings: DataFrame | None = None,
    grid: Grid = PLANAR,
) -> DataFrame:
    """Orders, turnover and number of points around each cell, and distance to the nearest ones.

    Order rows: order_id, delivery_point_id, created_on, issued_on, status,
    amount. Days before ``as_of`` count up to age 89: the scan starts there, and
    age 0 is excluded. A distance of 0 is treated as missing. ``openings`` is the
    table of :func:`point_openings`; without it the whole history is read for it.
    """
    d = F.col("created_on")
    placed = order_items.where(F.col("delivery_point_id") != 0)
    opened = point_openings(order_items) if openings is None else openings
    age = F.datediff(day(as_of), d)
    # One row per point, day and order, so that distinct orders become a count. The rate of
    # the day is applied to the day's sum: the join sees one row per point and day.
    per_day = (
        placed.where(
            F.col("status").isin("COMPLETED", "RETURNED")
            & (d >= day(as_of - timedelta(days=89))) & (d < day(as_of))
        )
        .groupBy("delivery_point_id", "created_on", "order_id")
        .agg(F.sum("amount").alias("amount"))
        .groupBy("delivery_point_id", "created_on")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("amount").cast("double").alias("amount"))
        .join(rates.select(F.col("date").alias("created_on"), "usd_rate"), "created_on", "left")
    )
    per_point = per_day.groupBy("delivery_point_id").agg(
        *[F.coalesce(F.sum(F.when(age <= w, F.col("orders"))), F.lit(0)).alias(f"orders_{w}") for w in WINDOWS],
        *[
            F.coalesce(F.sum(F.when(age <= w, F.col("amount") * F.col("usd_rate"))), F.lit(0.0)).alias(f"gmv_{w}")
            for w in WINDOWS
        ],
    )
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    points = (
        delivery_points.select(
            F.col("id").alias("delivery_point_id"), lat.alias("lat"), lon.alias("lon"),
            F.col("type").isin(*point_types).alias("is_point"),
            (F.col("type") == in_shop_type).alias("in_shop"),
        )
        .join(opened, "delivery_point_id", "left")
        .join(per_point, "delivery_point_id", "left")
    )
    points = grid.with_cell(points, "lat", "lon", "cell")
    # Points not open yet count for nothing, but the cells around them are targets too.
    open_now = F.coalesce(F.col("opened") <= day(as_of), F.lit(False))
    counted = points.select(
        "cell", "lat", "lon",
        *[(open_now & F.col(flag)).alias(flag) for flag in ("is_point", "in_shop")],
        *[F.when(open_now, F.col(f"{m}_{w}")).alias(f"{m}_{w}") for m in ("orders", "gmv") for w in WINDOWS],
        # A point occurs once per centre: counting points needs no distinct.
        *[
            (open_now & F.col("is_point") & (F.coalesce(f"orders_{w}", F.lit(0)) > 0)).cast("int").alias(f"unique_dp_{w}")
            for w in WINDOWS
        ],
    )
    centre = F.col("h3_index")
    gap = grid.distance_m(centre, F.col("lat"), F.col("lon"))
    measures = {f"{m}_{w}": f"{m}_r{{r}}_h{w}" for m in ("orders", "gmv", "unique_dp") for w in WINDOWS}
    near = ring_sums(
        counted, "cell", measures, RINGS, "double",
        reduce={f"_{flag}": F.min(F.when(F.col(flag), gap)) for flag in ("is_point", "in_shop")},
        grid=grid,
    )

    def nearest(flag: str) -> Column:
        least = F.coalesce(F.col(f"_{flag}"), F.lit(FAR_AWAY_M))
        return F.when(least == 0, F.lit(FAR_AWAY_M)).otherwise(least)

    return near.select(
        day(as_of).alias("date"), "h3_index", grid.text(centre).alias("h3_string"),
        nearest("is_point").alias("min_dist_to_dp_m"),
        nearest("in_shop").alias("min_dist_to_inshop_m"),
        *[
            F.col(name).cast("double" if m == "gmv" else "bigint").alias(name)
            for m in ("orders", "gmv", "unique_dp") for r in RINGS for w in WINDOWS
            for name in [f"{m}_r{r}_h{w}"]
        ],
    )


# Model names kept as copies of mart columns.
CONTRACT_COPIES = {
    "population": "population_r0",
    "pedestrian_traffic_index": "pedestrian_traffic_index_r0",
    "users_views_r1_30d": "views_r1_30d",
    "users_orders_30d": "orders_r0_30d",
    "users_orders_r3_90d": "orders_r3_90d",
    "users_orders_r4_30d": "orders_r4_30d",
    "atms_rad_1": "atms_r1",
    "banks_rad_2": "banks_r2",
    "retail_points_rad_1": "retail_points_r1",
    "car_dealers_services_rad_2": "car_dealers_services_r2",
    "mixed_goods_rad_2": "mixed_goods_r2",
    "fast_food_coffee_rad_5": "fast_food_coffee_r5",
    "bakeries_rad_1": "bakeries_r1",
}


def hex_forecast_mart(
    demography: DataFrame, neighbour_orders: DataFrame, activity: DataFrame, location: DataFrame, poi: DataFrame, as_of: date
) -> DataFrame:
    """Full outer join of the five cell tables with model names and typed defaults.

    All five are aggregated by cell, so they are already placed by the join key.
    The demography side owns h3_string.
    """
    frames = [demography, neighbour_orders.drop("h3_string"), activity, location, poi]
    wide = reduce(lambda a, b: a.join(b, "h3_index", "full"), [f.drop("date") for f in frames])
    traffic = "pedestrian_traffic_index"
    # Both derived features are taken before the defaults, so a missing side gives 0.
    derived = wide.select(
        "*",
        *[F.col(src).alias(dst) for dst, src in CONTRACT_COPIES.items()],
        (F.col(f"{traffic}_r2") - F.col(f"{traffic}_r1")).alias("traffic_ring_1_2"),
        ratio_eps("orders_r5_h90", "unique_dp_r5_h90").alias("orders_per_dp_r5_h90"),
    )
    filled = fill_by_type(
        derived,
        named={"region": "UNKNOWN", "min_dist_to_dp_m": FAR_AWAY_M, "min_dist_to_inshop_m": FAR_AWAY_M},
        skip=("h3_index",),
    )
    return filled.select(day(as_of).alias("date"), "*")
