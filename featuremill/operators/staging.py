"""Computing a frame once when a plan uses it several times, and in how many tasks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Rows that a task holds when it keeps them in memory a few times over (some tens of MB each time).
TASK_ROWS = 250_000

# A stage takes a frame and gives one with the same rows that is cheap to read again.
Stage = Callable[[DataFrame], DataFrame]


def no_stage(df: DataFrame) -> DataFrame:
    """Leave the plan as it is: branches that use the frame compute it each."""
    return df


def write_stage(folder: str) -> Stage:
    """Write frames below ``folder`` and read them back.

    Spark drops unused columns per branch, so two uses of one frame rarely share
    their shuffles. A written table is computed once, cuts the lineage and
    survives the loss of executors. ``folder`` must be shared by all of them.
    """

    def stage(df: DataFrame) -> DataFrame:
        path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return stage


def tasks_for(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Tasks for a step over so many rows: none gets many more than ``task_rows``, and no core is left idle.

    A frame that is repartitioned to this number keeps it: adaptive execution merges only
    partitions of its own number, up to a size in shuffled bytes, where rows are packed.
    """
    return max(spark.sparkContext.defaultParallelism, -(-rows // task_rows))
