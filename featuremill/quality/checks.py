"""Measuring the tests of a table: as few passes as they allow, one row per test."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.functions.dates import day
from featuremill.quality.config import DqSettings
from featuremill.quality.rules import Rule, Table


def passes(df: DataFrame, settings: DqSettings, table: Table, dates: DataFrame | None = None) -> list[tuple[list[int], DataFrame]]:
    """(numbers of the tests, frame (test, failed_rows, observed)) for each pass over the table.

    Aggregate tests share a pass over the rows they look at: the day and the one before, the dates alone, or everything. Where
    the days of the table are known (``dates``, say from ``scan.partition_days``), the tests on dates read them and no row.
    """
    sources = {
        "days": lambda: df.where((table.day >= day(table.on - timedelta(days=1))) & (table.day <= day(table.on))),
        "dates": lambda: (df if dates is None else dates).select(settings.partition_column),
        "rows": lambda: df,
    }
    shared: dict[str, list[tuple[int, Rule]]] = {name: [] for name in sources}
    made = []
    for i, rule in enumerate(settings.tests):
        if rule.measured(table) is None:
            made.append(([i], rule.plan(df, table).select(F.lit(i).alias("test"), "failed_rows", "observed")))
        else:
            shared["days" if rule.reads == "rows" and not table.whole else rule.reads].append((i, rule))
    joint = [([i for i, _ in tests], _aggregated(sources[name](), tests, table)) for name, tests in shared.items() if tests]
    return [*joint, *made]


def _aggregated(df: DataFrame, tests: list[tuple[int, Rule]], table: Table) -> DataFrame:
    """All given tests in one aggregation."""
    rows = []
    for i, rule in tests:
        failed, observed = rule.measured(table)
        rows.append(F.struct(F.lit(i).alias("test"), failed.cast("bigint").alias("failed_rows"), observed.cast("double").alias("observed")).alias(f"t{i}"))
    return df.agg(*rows).select(F.inline(F.array(*[f"t{i}" for i, _ in tests])))


def check_frame(
    df: DataFrame, settings: DqSettings, on: date, references: Mapping[str, DataFrame] | None = None, dates: DataFrame | None = None
) -> DataFrame:
    """(test_key, failed_rows, observed) for all tests of a table, in one plan; the key is a label and may repeat."""
    every = reduce(DataFrame.unionByName, [frame for _, frame in passes(df, settings, settings.table(on, references), dates)])
    labels = F.array(*[F.lit(rule.key) for rule in settings.tests])
    return every.select(F.get(labels, F.col("test")).alias("test_key"), "failed_rows", "observed")


def history_days(df: DataFrame, table: Table) -> DataFrame:
    """Number of earlier partition dates, as a one-row frame."""
    return df.where(table.day < day(table.on)).select(table.day.alias("d")).distinct().agg(F.count(F.lit(1)).alias("n"))
