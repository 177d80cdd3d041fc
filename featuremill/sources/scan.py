"""Scans: everything is a predicate on the source, so it prunes partitions or pushes down."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremill.functions.dates import Bound, between_instants, day, day_start, in_window, ts
from featuremill.sources.sink import _file


def partition(df: DataFrame, on: date, date_col: str = "date") -> DataFrame:
    """One partition date."""
    return df.where(F.col(date_col) == day(on))


def trailing(df: DataFrame, as_of: date, days: int, bound: Bound, date_col: str = "date") -> DataFrame:
    """A trailing range of partition dates."""
    return df.where(in_window(F.col(date_col), as_of, days, bound))


def instants(df: DataFrame, start: datetime, end: datetime, ts_col: str) -> DataFrame:
    """start <= ts < end."""
    return df.where(between_instants(F.col(ts_col), start, end))


def received_on(
    df: DataFrame,
    on: date,
    received: str = "received_at",
    logged: str = "logged_at",
    early_days: int = 3,
    late_days: int = 3,
) -> DataFrame:
    """Rows received on one day, with a wide range on the log time.

    The exact condition is the received day. The wide one exists for tables
    partitioned by log time: it prunes, and still keeps late and early logs.
    """
    lo, hi = day_start(on), day_start(on + timedelta(days=1))
    wide = between_instants(
        F.col(logged), lo - timedelta(days=early_days), hi + timedelta(days=late_days)
    )
    return df.where(wide & between_instants(F.col(received), lo, hi))


def existing_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet at a path, or FileNotFoundError naming the path."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition() or error):
            raise FileNotFoundError(f"no parquet file or directory at {path}") from error
        raise


def partition_days(spark: SparkSession, path: str, column: str = "date") -> DataFrame:
    """The days of a table partitioned by ``column`` first, one row each, from the names of its folders; no data file is opened.

    Folders without a visible file or folder in them do not count, nor do hidden ones and those of NULL; a table that is not
    there has no days. The name of a folder that counts must be a day. The folders are listed on the driver, one entry for each day.
    """
    root, files = _file(spark, path)
    shown = lambda folder: [x for x in files.listStatus(folder) if not x.getPath().getName().startswith(("_", "."))]
    listed = [x.getPath() for x in shown(root) if x.isDirectory()] if files.exists(root) else []
    values = {x: x.getName().removeprefix(f"{column}=") for x in listed if x.getName().startswith(f"{column}=")}
    days = [date.fromisoformat(v) for folder, v in values.items() if v != "__HIVE_DEFAULT_PARTITION__" and shown(folder)]
    return spark.createDataFrame([(d,) for d in sorted(days)], f"`{column}` date")


def latest_snapshot(df: DataFrame, snapshot_col: str, up_to: date | None = None) -> DataFrame:
    """Rows of the newest snapshot, at or before ``up_to`` when given.

    The newest value is a scalar subquery: no driver round trip, the filter can
    prune, and an empty source simply gives an empty result.
    """
    source = df if up_to is None else df.where(F.col(snapshot_col) <= day(up_to))
    newest = source.select(F.max(snapshot_col)).scalar()
    return source.where(F.col(snapshot_col) == newest)


def latest_run(parts: DataFrame, keys: Sequence[str], run_col: str = "run_id") -> DataFrame:
    """Among raw part rows keep, per key, those of the newest run."""
    newest = parts.groupBy(*keys).agg(F.max(run_col).alias(run_col))
    return parts.join(newest, [*keys, run_col], "left_semi")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, plain or gzip, with the file each row came from."""
    return spark.read.schema(schema).json(path).select("*", F.col("_metadata.file_path").alias("source_file"))


def live_and_history(
    live: DataFrame,
    history: DataFrame,
    now: datetime,
    history_days: int,
    columns: Sequence[str],
    ts_col: str = "created_at",
    date_col: str = "date",
) -> DataFrame:
    """The last 24 hours of a live source plus the stored days before, by name."""
    if history_days < 2:
        raise ValueError("history_days must be at least 2")
    recent = live.where(F.col(ts_col) >= ts(now - timedelta(days=1)))
    stored = history.where(F.col(date_col) > day(now.date() - timedelta(days=history_days - 1)))
    return recent.select(*columns).unionByName(stored.select(*columns))


def not_in_keep_sql_nulls(col: Column, values: Sequence[str]) -> Column:
    """SQL ``NOT IN``: a NULL value is neither in nor out, so a filter drops the row."""
    return ~col.isin(*values)

