"""All registered queries, as the driver wants them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featuremill.operators.staging import write_stage
from featuremill.sources.star_views import StarViews
from registry.gold_queries import GOLD
from registry.kernel_queries import KERNELS, ROWS, SCANS
from registry.public_grid import PUBLIC_GRID
from registry.relational_queries import AGGREGATES, EXTRA, JOINS, QUALITY, RE_AIMED
from registry.silver_queries import SILVER
from registry.views_sql import with_views
from registry.workspace import fresh_dir


def _bind(build: Callable[[StarViews], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Frames that a query uses several times go through a table in the shared folder.
        return build(StarViews(spark, sf_dir, lambda df: write_stage(fresh_dir(spark, "stage"))(df)))

    return run


_ALL = {**SILVER, **GOLD, **SCANS, **KERNELS, **ROWS, **JOINS, **AGGREGATES, **RE_AIMED, **PUBLIC_GRID, **QUALITY}
QUERIES = {name: _bind(build) for name, (build, _) in _ALL.items()}
ORACLES = {name: with_views(sql, EXTRA) for name, (_, sql) in _ALL.items() if sql is not None}
