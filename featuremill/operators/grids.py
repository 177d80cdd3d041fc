"""Hexagon grids behind one interface, for ring aggregates and the tables made of them.

``inner`` is the form of a cell in which rings are reached by adding constants; ``outer`` is the id that tables hold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.functions import geogrid, hexgrid


@dataclass(frozen=True)
class PlanarGrid:
    """Cells of :mod:`featuremill.functions.hexgrid`: both forms are the same."""

    level: int = 9

    def with_cell(self, df: DataFrame, lat: str, lon: str, out: str) -> DataFrame:
        return df.withColumn(out, hexgrid.cell_of(F.col(lat), F.col(lon), self.level))

    def parent(self, cell: Column, level: int) -> Column:
        return hexgrid.parent_cell(cell, level)

    def text(self, cell: Column) -> Column:
        return hexgrid.cell_text(cell)

    def inner(self, df: DataFrame, cell: str) -> DataFrame:
        return df

    outer = inner

    def distance_m(self, inner: Column, lat: Column, lon: Column) -> Column:
        """Metres from the middle of a cell to a point."""
        return hexgrid.distance_m(hexgrid.centre_lat(inner), hexgrid.centre_lon(inner), lat, lon)

    def scatter(self, df: DataFrame, cell: str, k: int, centre: str, ring: str) -> DataFrame:
        rest = [c for c in df.columns if c != cell]
        return df.select(*rest, cell, F.explode(hexgrid.ring_steps(k)).alias("_n")).select(
            *rest, (F.col(cell) + F.col("_n.step")).alias(centre), F.col("_n.ring").alias(ring)
        )


@dataclass(frozen=True)
class PublicGrid:
    """Cells of :mod:`featuremill.functions.geogrid`: ids outside, places inside.

    An id becomes a place once per row and a place an id once per result; the rings between are sums of integers. Rows near one
    of the twelve corners, where sums would be wrong, go step by step instead.
    """

    level: int = 9

    def with_cell(self, df: DataFrame, lat: str, lon: str, out: str) -> DataFrame:
        return geogrid.with_cells(df, F.col(lat), F.col(lon), {out: self.level})

    def parent(self, cell: Column, level: int) -> Column:
        return geogrid.parent_cell(cell, level)

    def text(self, cell: Column) -> Column:
        return geogrid.cell_text(cell)

    def inner(self, df: DataFrame, cell: str) -> DataFrame:
        return geogrid.with_places(df, cell, cell, self.level)

    def outer(self, df: DataFrame, cell: str) -> DataFrame:
        return geogrid.with_ids(df, cell, cell, self.level)

    def distance_m(self, inner: Column, lat: Column, lon: Column) -> Column:
        """Metres from the middle of a place to a point."""
        return geogrid.let(geogrid.centre(inner, self.level), lambda c: hexgrid.distance_m(c["lat"], c["lon"], lat, lon))

    def scatter(self, df: DataFrame, cell: str, k: int, centre: str, ring: str) -> DataFrame:
        rest = [c for c in df.columns if c != cell]
        place = F.col(cell)
        sums = F.transform(geogrid.ring_steps(k), lambda s: F.struct((place + s["step"]).alias("place"), s["ring"].alias("ring")))
        steps = F.when(geogrid.near_corner(place, k + 1, self.level), geogrid.rings_by_steps(place, k, self.level)).otherwise(sums)
        # Never empty; but the plain form would bring in a filter, which is pushed down with a copy of the place for each use.
        sent = df.select(*rest, F.explode_outer(steps).alias("_n")).select(*rest, F.col("_n.place").alias("_p"), F.col("_n.ring").alias(ring))
        # Each call in a projection of its own, so that a place is computed once and used many times; settled ones stay.
        for _ in range(2):
            sent = sent.withColumn("_p", geogrid.settle(F.col("_p"), self.level))
        return sent.select(*rest, F.col("_p").alias(centre), ring)


Grid = PlanarGrid | PublicGrid
PLANAR = PlanarGrid()
