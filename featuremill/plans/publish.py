"""Publishing a built table according to its contract."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.sources.schema import FeatureTable
from featuremill.sources.sink import append_new_keys, guarded_overwrite, overwrite_partitions


def publish(table: FeatureTable, frame: DataFrame, path: str, on: date, staging: str, until: date | None = None) -> None:
    """Write one run of a table; running it again gives the same table.

    ``replace_day`` replaces the days from ``on`` up to before ``until`` (one day
    without it) after the guards have passed. ``replace_snapshot`` replaces the
    snapshots that the frame brings (per promotion where that is part of the
    key). ``append`` adds the rows whose key the table does not have yet, which
    may be none.
    """
    missing = [k for k in table.primary_key if k not in frame.columns]
    if missing:
        raise ValueError(f"{table.name}: key columns missing: {missing}")
    if table.mode == "replace_day":
        guarded_overwrite(frame, path, on, staging, required=["date"], until=until)
    elif table.mode == "replace_snapshot":
        by = [k for k in table.primary_key if k in (table.partition_column, "promotion_id")]
        overwrite_partitions(frame, path, by)
    else:
        by = [table.partition_column] if table.partition_column else []
        append_new_keys(frame, _known(frame, path), list(table.primary_key), path, partition_by=by)


def _known(frame: DataFrame, path: str) -> DataFrame:
    """The table as it is; no rows where there is none."""
    try:
        return frame.sparkSession.read.schema(frame.schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return frame.where("false")


def duplicate_keys(table: FeatureTable, frame: DataFrame) -> DataFrame:
    """Key values that occur more than once."""
    return frame.groupBy(*table.primary_key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
