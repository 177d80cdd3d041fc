"""Exact distinct counts that add up over days, from one bitmap table.

Ids get dense numbers from a dictionary, a table that a daily run extends. A day's rows of a key become bitmaps over the numbers,
one for each ``bucket`` of 64 numbers that the key has ids in. Bitmaps of several days are or-ed, so the distinct count of a
window needs the window's bitmaps alone: neither its rows nor its ids are read again, and nothing is counted twice.

A bitmap is one 64-bit word, so a key with a handful of ids a day takes no more than its ids would; numbers are given in order of
first appearance, so that ids that are seen in the same days lie together and share words. Tables of binary bitmaps of 4 KB
(buckets of 32,768 numbers) can still be counted.

Defined results: NULL ids count for nothing; repeated rows count once; a key without ids in the window has no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.operators.rows import sliced_row_number


def new_numbers(ids: DataFrame, known: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, number) of the ids that the dictionary ``known`` has not got, numbered on from its largest number."""
    fresh = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct().join(known.select(id_col), id_col, "left_anti")
    last = known.select(F.coalesce(F.max("number"), F.lit(-1).cast("bigint"))).scalar()
    numbered = sliced_row_number(fresh, [], F.pmod(F.xxhash64(id_col), F.lit(256)), [F.col(id_col)], "_n")
    return numbered.select(id_col, (F.col("_n") + last).cast("bigint").alias("number"))


def daily_bitmaps(rows: DataFrame, numbers: DataFrame, keys: Sequence[str], id_col: str = "id", day_col: str = "date") -> DataFrame:
    """(day, keys, bucket, bits): the ids of each day and key; the dictionary must have all ids, others would be left out."""
    used = rows.select(day_col, *keys, id_col).where(F.col(id_col).isNotNull())
    numbered = used.join(numbers.select(id_col, "number"), id_col)
    bit = F.expr("shiftleft(1L, cast(number & 63 as int))")
    return numbered.groupBy(day_col, *keys, F.shiftright("number", 6).alias("bucket")).agg(F.bit_or(bit).alias("bits"))


def distinct_over(daily: DataFrame, keys: Sequence[str], start: date, end: date, out: str = "n", day_col: str = "date") -> DataFrame:
    """(keys, out): distinct ids of the days from ``start`` up to before ``end``."""
    window = daily.where((F.col(day_col) >= F.lit(start)) & (F.col(day_col) < F.lit(end)))
    binary = daily.schema["bits"].dataType.typeName() == "binary"
    merge, count = (F.bitmap_or_agg, F.bitmap_count) if binary else (F.bit_or, F.bit_count)
    joint = window.groupBy(*keys, "bucket").agg(merge("bits").alias("bits"))
    return joint.groupBy(*keys).agg(F.sum(count("bits")).alias(out))
