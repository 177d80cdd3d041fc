"""A fresh folder for queries that write a table and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from featuremill.sources.sink import shared_dir


def fresh_dir(spark: SparkSession, name: str) -> str:
    """Under the shared folder of the cluster."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
