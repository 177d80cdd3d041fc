"""Sinks: partition replacement, predicate replacement, append, and guarded publication."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from featuremill.operators.rows import first_row


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set: no shared folder for staged tables")
    return folder.rstrip("/")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("date",)) -> None:
    """Replace exactly the partitions present in ``df``; other partitions stay.

    Rows are rebalanced by partition value before the write: adaptive execution
    merges small partitions and splits large ones, so neither many tiny files
    nor one huge task comes out.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions_in_table(df: DataFrame, table: str) -> None:
    """As :func:`overwrite_partitions` for a catalog table (DataSource V2)."""
    df.writeTo(table).overwritePartitions()


def replace_where_in_table(df: DataFrame, table: str, condition: Column) -> None:
    """Replace the rows matching a condition in a catalog table (DataSource V2)."""
    df.writeTo(table).overwrite(condition)


def append_to_table(df: DataFrame, table: str) -> None:
    df.writeTo(table).append()


class WriteRefused(ValueError):
    """A guard found a reason not to publish."""


def guarded_overwrite(
    df: DataFrame,
    path: str,
    on: date,
    staging: str,
    required: Sequence[str] = (),
    partition_by: Sequence[str] = ("date",),
    date_col: str = "date",
    until: date | None = None,
) -> int:
    """Replace the days from ``on`` up to before ``until`` (one day without it); returns the number of rows.

    The frame is written once, partitioned, to a folder below ``staging``, while
    row counters are observed in the same job. Only when no row lies outside the
    range, every day of it has rows, and no required column is missing or NULL,
    are the folders of the days moved into place; a failure before that leaves
    the target as it was. What is left of the staging folder is always removed.
    ``staging`` must be on the file system of ``path``; ``partition_by`` begins
    with ``date_col``.
    """
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise WriteRefused(f"required columns missing: {absent}")
    until = until or on + timedelta(days=1)
    days = [on + timedelta(days=i) for i in range((until - on).days)]
    spark, seen = df.sparkSession, Observation()
    staged = f"{staging.rstrip('/')}/{uuid.uuid4().hex}"
    at = F.col(date_col).cast("date")
    try:
        (
            df.hint("rebalance", *partition_by)
            .observe(
                seen,
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(~F.coalesce((at >= F.lit(on)) & (at < F.lit(until)), F.lit(False))).alias("outside"),
                *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
            )
            .write.partitionBy(*partition_by)
            .parquet(staged)
        )
        found = seen.get
        if found["n_rows"] == 0:
            raise WriteRefused(f"nothing to write for {on}: the partition is left as it was")
        if found["outside"]:
            raise WriteRefused(f"{found['outside']} rows do not carry the partition date {on}" + (f" to {days[-1]}" if len(days) > 1 else ""))
        nulls = {c: found[f"null_{c}"] for c in required if found[f"null_{c}"]}
        if nulls:
            raise WriteRefused(f"NULL in required columns: {nulls}")
        folders = [f"{date_col}={d.isoformat()}" for d in days]
        empty = [f for f in folders if not _exists(spark, f"{staged}/{f}")]
        if empty:
            raise WriteRefused(f"days without rows: {empty}")
        for folder in folders:
            _move(spark, f"{staged}/{folder}", f"{path.rstrip('/')}/{folder}")
        return found["n_rows"]
    finally:
        _remove(spark, staged)


def _file(spark: SparkSession, path: str):
    """A path and its file system."""
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    made, files = _file(spark, path)
    return files.exists(made)


def _remove(spark: SparkSession, path: str) -> None:
    made, files = _file(spark, path)
    files.delete(made, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another."""
    (old, files), (new, _) = _file(spark, source), _file(spark, target)
    files.mkdirs(new.getParent())
    files.delete(new, True)
    if not files.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def append_new_keys(
    df: DataFrame, known: DataFrame, keys: Sequence[str], path: str, order: Sequence[Column] = (), partition_by: Sequence[str] = ()
) -> None:
    """Append one row for each key that is not known yet: of rows with one key the first in ``order``, or of all columns."""
    one = first_row(df, keys, [*order, *(F.col(c) for c in df.columns if c not in keys)] or [F.lit(1)])
    append(one.join(known.select(*keys).distinct(), list(keys), "left_anti").select(*df.columns), path, partition_by)
