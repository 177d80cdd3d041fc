"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    many: DataFrame,
    few: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    salts: int | None = None,
    how: str = "inner",
) -> DataFrame:
    """``many JOIN few``, with the rows of one key dealt over ``salts`` sub-keys where a number is given.

    Without ``salts`` this is the plain join, whose hot keys adaptive execution
    splits at run time as far as the cluster goes. Give a number where the rows
    are aggregated by the same key right after, so that it cannot, and ``few``
    is narrow with few rows per key: it is repeated per salt. ``how`` is inner
    or left. The result is the same as of the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if salts is None or salts <= 1:
        return many.join(few, list(keys), how)
    dealt = many.withColumn("_salt", F.pmod(F.hash(*spread_by), F.lit(salts)))
    repeated = few.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def lookup_where(
    many: DataFrame, dimension: DataFrame, key: str, need: Column, spread_by: Sequence[str]
) -> DataFrame:
    """Left join of ``dimension`` on ``key`` for the rows that need it; NULLs for all others.

    Rows that need no lookup, or have no key, would pile up on few join keys
    (NULL is one of them). They get a key of their own from ``spread_by`` and a
    flag that matches nothing, so they are spread evenly and never meet the
    dimension.
    """
    wanted = F.coalesce(need & F.col(key).isNotNull(), F.lit(False))
    keyed = many.withColumns({
        "_wanted": wanted,
        "_key": F.when(wanted, F.col(key).cast("bigint")).otherwise(F.xxhash64(*spread_by)),
    })
    sought = dimension.withColumns({"_wanted": F.lit(True), "_key": F.col(key).cast("bigint")}).drop(key)
    return keyed.join(sought, ["_key", "_wanted"], "left").drop("_key", "_wanted")
