"""Sequences of binary outcomes per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.operators.skew import salted_join


def current_streak(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str) -> DataFrame:
    """Last outcome and the number of trailing rows that share it.

    The streak is the count of rows after the last row with the opposite
    outcome. Both steps are plain aggregations (no sorted list per key is
    built), so a key with very many rows is combined map-side.
    """
    at = F.struct(*order)
    last = df.groupBy(*keys).agg(
        F.max(F.when(F.col(flag) == 1, at)).alias("_last1"),
        F.max(F.when(F.col(flag) != 1, at)).alias("_last0"),
    )
    one_is_last = F.col("_last0").isNull() | (F.col("_last1") > F.col("_last0"))
    bounds = last.select(
        *keys,
        F.when(F.coalesce(one_is_last, F.lit(False)), 1).otherwise(0).alias("last_outcome"),
        F.when(F.coalesce(one_is_last, F.lit(False)), F.col("_last0"))
        .otherwise(F.col("_last1"))
        .alias("_break"),
    )
    after = F.col("_break").isNull() | (at > F.col("_break"))
    return (
        salted_join(df.select(*keys, *order), bounds, keys, spread_by=order)
        .groupBy(*keys)
        .agg(
            F.max("last_outcome").alias("last_outcome"),
            F.count_if(after).alias("streak_len"),
        )
    )


def upper_median(col: Column, accuracy: int = 10000) -> Column:
    """Approximate median taking the larger of the two middle values."""
    return -F.percentile_approx(-col, 0.5, accuracy)


def lower_median(col: Column, accuracy: int = 10000) -> Column:
    return F.percentile_approx(col, 0.5, accuracy)
