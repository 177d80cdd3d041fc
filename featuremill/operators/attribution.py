"""Last-touch attribution: what happened just before, within the same group."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of the first and of the second level of slices.
SLICES = (60, 86_400)


def time_slice(ts: Column, seconds: int) -> Column:
    """Number of the slice that an instant lies in."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return F.floor((days * 86_400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)) / seconds).cast("bigint")


def last_before(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str,
    streams: Mapping[str, Callable[[Column], Column]],
    slices: tuple[int, int] = SLICES,
) -> DataFrame:
    """For each row and stream, the latest earlier row of that stream in the group.

    ``streams`` maps an output column to a membership test on the row. The
    result has the keys, ``ts``, ``tie``, the other columns packed as ``row``,
    and per stream the ``row`` of the row before, or NULL. It equals one ``lag``
    per stream over that stream's rows, with a single shuffle for all.

    Keys must not be NULL. Every group is cut into slices of ``slices[0]``
    seconds: rows look back inside their slice. The last row of each slice is
    carried over in two steps, inside slices of ``slices[1]`` seconds and from
    one of these to the next. So a task holds the rows of one short slice, the
    short slices of one long one, or the long slices of one group, however
    large the group is and whatever its share of the table.
    """
    placed_by = [*keys, ts, tie]
    cell, block = [*keys, "_slice"], [*keys, "_block"]
    rest = [c for c in df.columns if c not in placed_by]
    fine, coarse = slices
    marked = df.withColumn("_slice", time_slice(F.col(ts), fine))
    # Both uses of this frame below need all of its columns, so they share the shuffle.
    placed = marked.repartition(*cell).select(*placed_by, "_slice", F.struct(*rest).alias("row"))

    row, when = F.col("row"), F.struct(ts, tie)
    looked = placed.select(
        *placed_by, "_slice", "row",
        *[F.last(F.when(test(row), row), ignorenulls=True).over(_earlier(cell, ts, tie)).alias(f"_in_{n}") for n, test in streams.items()],
    )
    tails = placed.groupBy(*cell).agg(*[F.max_by("row", F.when(test(row), when)).alias(f"_thru_{n}") for n, test in streams.items()])
    tails = tails.withColumn("_block", F.floor(F.col("_slice") * fine / coarse).cast("bigint")).repartition(*block)
    near = tails.select(*cell, "_block", *[F.last(f"_thru_{n}", ignorenulls=True).over(_earlier(block, "_slice")).alias(f"_near_{n}") for n in streams])
    ends = tails.groupBy(*block).agg(*[F.max_by(f"_thru_{n}", F.when(F.col(f"_thru_{n}").isNotNull(), F.col("_slice"))).alias(f"_end_{n}") for n in streams])
    far = ends.select(*block, *[F.last(f"_end_{n}", ignorenulls=True).over(_earlier(keys, "_block")).alias(f"_far_{n}") for n in streams])
    carried = near.join(far, block).select(
        *cell, *[F.coalesce(F.col(f"_near_{n}"), F.col(f"_far_{n}")).alias(f"_carry_{n}") for n in streams]
    )
    return looked.join(carried, cell, "left").select(
        *placed_by, "row",
        *[F.coalesce(F.col(f"_in_{n}"), F.col(f"_carry_{n}")).alias(n) for n in streams],
    )


def _earlier(keys: Sequence[str], *order: str):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
