"""Ring aggregates on the hexagonal grid."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.operators.grids import PLANAR, Grid


def scatter(df: DataFrame, cell: str, k: int, centre: str = "h3_index", ring: str = "ring", grid: Grid = PLANAR) -> DataFrame:
    """Send every row to all centres within k steps of its cell.

    Being a neighbour is symmetric, so instead of expanding each centre to its
    ring and joining the data, the data rows are expanded to the centres they
    count for. A ring aggregate is then a single map-side combined ``groupBy``
    with no join. Reduce ``df`` to one row per cell first. Cells and centres are
    in the grid's inner form.
    """
    return grid.scatter(df, cell, k, centre, ring)


def ring_sums(
    df: DataFrame,
    cell: str,
    measures: Mapping[str, str],
    rings: Iterable[int],
    as_type: str = "bigint",
    reduce: Mapping[str, Column] | None = None,
    grid: Grid = PLANAR,
) -> DataFrame:
    """Per centre: sums of each measure over ring <= r, and ``nearest``, the least ring with data.

    ``measures`` maps a column to an output name with an ``{r}`` slot;
    ``reduce`` adds other aggregates over all rows in reach, by output name; each
    must be a minimum, since minima are taken again. Scattered rows are first
    added up per (centre, ring), which is a handful of sums for each of the many
    rows; only the at most ``k + 1`` rows left per centre go through the wide
    ring conditions. ``reduce`` sees the centre ``h3_index`` in the grid's inner form;
    cells of ``df`` and of the result are ids.
    """
    rings = list(rings)
    extra = dict(reduce or {})
    per_ring = (
        scatter(grid.inner(df, cell), cell, max(rings), grid=grid)
        .groupBy("h3_index", "ring")
        .agg(*[F.sum(m).alias(m) for m in measures], *[c.alias(n) for n, c in extra.items()])
    )
    out = []
    for m, pattern in measures.items():
        for r in rings:
            total = F.sum(F.when(F.col("ring") <= r, F.col(m)))
            out.append(F.coalesce(total, F.lit(0)).cast(as_type).alias(pattern.format(r=r)))
    wide = per_ring.groupBy("h3_index").agg(F.min("ring").alias("nearest"), *[F.min(n).alias(n) for n in extra], *out)
    return grid.outer(wide, "h3_index")
