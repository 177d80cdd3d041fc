"""Sums of trailing windows as differences of running totals, so that a daily run reads one day and not the whole window.

The totals of each key up to a day are a version of a bucketed state table (``operators/state_table``). A daily run adds the rows
since the last version to it: only these are read and shuffled. A window (B, E] is the version of E less that of B, joined bucket
by bucket without a shuffle, whatever the number of windows and of days in them.

A key without rows for ``span`` days leaves the totals; when it comes back it starts again from 0 and from that day, which is why a
total says since when it counts: an earlier version is subtracted only if it belongs to the same stretch. So the table has the size
of the keys of one window, not of all keys ever seen.

``span`` + 2 versions are kept: windows of the newest day and of the day before can be asked for.

Defined results: rows with NULL in a key are not kept; a NULL measure adds 0; rows of a day that are repeated are added each; a key
without rows in the longest window has no row. Measures are integers or decimals, so that differences are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremill.functions.dates import Bound, day, window_end, window_start
from featuremill.operators.state_table import StateTable

ONE_DAY = timedelta(days=1)


@dataclass(frozen=True)
class RunningSums:
    """Running totals of ``measures`` by ``keys`` (column to type); ``span`` is the longest window that can be asked for, in days."""

    name: str
    folder: str
    keys: Mapping[str, str]
    measures: Mapping[str, str]
    span: int
    buckets: int = 200
    date_col: str = "date"

    @property
    def state(self) -> StateTable:
        fields = {**self.keys, "_since": "date", "_last": "date", **self.measures}
        schema = T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in fields.items()))
        return StateTable(self.name, self.folder, schema, tuple(self.keys), self.buckets, keep=self.span + 2)

    def unread(self, daily: DataFrame, on: date) -> DataFrame:
        """The rows that the version of the day has and the version before it has not; a plain range, so it prunes partitions."""
        earlier = [v for v in self.state.versions(daily.sparkSession) if v < on]
        until = daily.where(F.col(self.date_col) <= day(on))
        return until.where(F.col(self.date_col) > day(earlier[-1])) if earlier else until

    def advance(self, daily: DataFrame, on: date) -> DataFrame:
        """Make the version of the day from the version before it and the rows since; the first version reads all earlier days.

        A day that is run again gives the same version again; versions after it are not changed (see ``replace``).
        """
        known = reduce(and_, [F.col(k).isNotNull() for k in self.keys])
        sums = [F.coalesce(F.sum(m), F.lit(0)).cast(t).alias(f"_n_{m}") for m, t in self.measures.items()]
        added = (
            self.unread(daily, on).select(F.col(self.date_col).alias("_day"), *[F.col(k).cast(t).alias(k) for k, t in self.keys.items()], *self.measures)
            .where(known).groupBy(*self.keys)
            .agg(F.min("_day").alias("_n_since"), F.max("_day").alias("_n_last"), *sums)
        )
        both = self.state.before(daily.sparkSession, on).join(added, list(self.keys), "full")
        zero = F.lit(0)
        totals = both.select(
            *self.keys, F.coalesce("_since", "_n_since").alias("_since"), F.greatest("_last", "_n_last").alias("_last"),
            *[(F.coalesce(m, zero) + F.coalesce(f"_n_{m}", zero)).cast(t).alias(m) for m, t in self.measures.items()],
        )
        return self.state.write(on, totals.where(F.col("_last") > day(on - timedelta(days=self.span))))

    def replace(self, daily: DataFrame, since: date) -> None:
        """Make all versions from ``since`` on again, after rows of that day or later days have come late or have changed.

        These versions are dropped first: a window asked for meanwhile, or after a failure, is refused instead of mixed. Where no
        version is older than ``since``, the first one is made from all earlier days.
        """
        changed = [v for v in self.state.versions(daily.sparkSession) if v >= since]
        self.state.drop(daily.sparkSession, changed)
        for on in changed:
            self.advance(daily, on)

    def edges(self, as_of: date, windows: Iterable[int], bound: Bound) -> list[date]:
        """The days whose versions the windows need, oldest first."""
        return sorted({window_end(as_of, bound), *[window_start(as_of, w, bound) - ONE_DAY for w in windows]})

    def windows(
        self, spark: SparkSession, as_of: date, windows: Iterable[int], bound: Bound, names: Mapping[str, str], as_type: str | None = "double"
    ) -> DataFrame:
        """(keys, one sum for each window and measure) of the keys with rows in the longest window.

        ``names`` maps a measure to an output name with a ``{w}`` slot. A version that is missing is an error, not 0.
        """
        widths = sorted(windows)
        end, first = window_end(as_of, bound), window_start(as_of, widths[-1], bound)
        if (end - first).days >= self.span:
            raise ValueError(f"windows of {(end - first).days + 1} days from totals that keep {self.span}")
        out = self.state.version(spark, end).where(F.col("_last") >= day(first))
        sums: list[Column] = []
        for w in widths:
            edge = window_start(as_of, w, bound) - ONE_DAY
            earlier = self.state.version(spark, edge).select(*self.keys, *[F.col(m).alias(f"_{w}_{m}") for m in names])
            out = out.join(earlier, list(self.keys), "left")
            for m, pattern in names.items():
                gone = F.when(F.col("_since") <= day(edge), F.col(f"_{w}_{m}")).otherwise(F.lit(0))
                total = F.col(m) - F.coalesce(gone, F.lit(0))
                sums.append((total.cast(as_type) if as_type else total).alias(pattern.format(w=w)))
        return out.select(*self.keys, *sums)
