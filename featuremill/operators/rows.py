"""Row selection per key: latest row, top lists, ranks over hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    ``row_number() = 1`` is planned as a group limit on both sides of the
    shuffle, so every map task sends at most one row per key and a hot key
    costs no more than a cold one. ``order`` should end in a unique tie-break.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    """The first n rows per key with their rank; also group-limited before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_list(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, n: int, out: str
) -> DataFrame:
    """ARRAY of the first n values per key, in order.

    The cut to n rows happens before anything is collected, so the array that
    is built never holds more than n elements.
    """
    best = first_n(df, keys, order, n, "_rank")
    return best.groupBy(*keys).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("_rank", value))), lambda s: s[value]
        ).alias(out)
    )


def sliced_row_number(
    df: DataFrame, keys: Sequence[str], slice_col: Column, order: Sequence[Column], out: str
) -> DataFrame:
    """``row_number()`` per key with a hot key spread over slices.

    ``slice_col`` must not decrease along ``order``. Rows are numbered inside
    (key, slice) and shifted by the number of rows in earlier slices, which is
    one counter per slice.
    """
    sliced = df.withColumn("_slice", slice_col)
    cell = [*keys, "_slice"]
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    local = sliced.withColumn("_local", F.row_number().over(Window.partitionBy(*cell).orderBy(*order)))
    # Null-safe, as window partitions are: NULL is a key like any other.
    same = reduce(and_, [F.col(f"l.{c}").eqNullSafe(F.col(f"o.{c}")) for c in cell])
    return local.alias("l").join(offsets.alias("o"), same).select(
        *[F.col(f"l.{c}") for c in df.columns], (F.col("o._before") + F.col("l._local")).alias(out)
    )


def with_group_totals(
    df: DataFrame, group: Sequence[str], totals: dict[str, Column]
) -> DataFrame:
    """Attach aggregates of a coarser group to every row.

    Same result as ``agg().over(partitionBy(group))``, but a window sends all
    rows of a group to one task; here the group is reduced map-side and joined
    back, where adaptive execution may broadcast the totals or split a hot group.
    """
    reduced = df.groupBy(*group).agg(*[c.alias(name) for name, c in totals.items()])
    return df.join(reduced, list(group), "left")
