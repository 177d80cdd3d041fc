"""Publication by a manifest: readers see all days of a publication or none of them.

Rows lie in ``path/data/date=…/_version=…``, a folder that is written once and never changed. A manifest in ``path/manifests``
says which version each day has; they are numbered, and the newest one is the table. Publishing writes new folders, checks
them, and then puts the next manifest in place by one rename: whatever fails before that leaves the table as it was, and a reader
that began with an older manifest goes on with its folders. Folders that no manifest names are what failed runs left;
:func:`remove_unlisted` takes them away, with manifests beyond the newest ones.

Two publications at once would take the same number. Where the file system's rename does not replace files the later one is
refused; elsewhere a table must have one publisher at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featuremill.sources.sink import WriteRefused, _exists, _file, _remove

VERSION = "_version"


def manifests(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the manifests, oldest first."""
    made, files = _file(spark, f"{path}/manifests")
    if not files.exists(made):
        return []
    names = [s.getPath().getName() for s in files.listStatus(made)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def days_of(spark: SparkSession, path: str, number: int | None = None) -> dict[str, str]:
    """Version of each day, by the newest manifest or the one of that number."""
    known = manifests(spark, path)
    if not known:
        return {}
    made, files = _file(spark, f"{path}/manifests/{known[-1] if number is None else number:010}.json")
    stream = files.open(made)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _commit(spark: SparkSession, path: str, number: int, days: dict[str, str]) -> None:
    """Write a manifest beside its place, and rename it."""
    target, files = _file(spark, f"{path}/manifests/{number:010}.json")
    draft, _ = _file(spark, f"{path}/manifests/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(days, sort_keys=True).encode()))
    stream.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise WriteRefused(f"manifest {number} of {path} is there already: another run has published")


def _observed(seen: Observation) -> dict[str, int]:
    try:
        return seen.get
    except Py4JJavaError:
        # A frame that the optimiser knows to be empty runs without its counters.
        return {"n_rows": 0, "outside": 0}


def publish_version(df: DataFrame, path: str, on: date, until: date | None = None, required: Sequence[str] = (), date_col: str = "date") -> int:
    """Publish the days from ``on`` up to before ``until`` (one day without it); returns the number of rows.

    The guards are those of ``sink.guarded_overwrite``: no row outside the range, no day of it without rows, no required column
    missing or NULL. They are observed while the rows are written.
    """
    if absent := [c for c in required if c not in df.columns]:
        raise WriteRefused(f"required columns missing: {absent}")
    spark, seen, version = df.sparkSession, Observation(), uuid.uuid4().hex
    until = until or on + timedelta(days=1)
    days = [(on + timedelta(days=n)).isoformat() for n in range((until - on).days)]
    at = F.col(date_col).cast("date")
    within = F.coalesce((at >= F.lit(on)) & (at < F.lit(until)), F.lit(False))
    before = manifests(spark, path)
    table = days_of(spark, path)
    # One column of the range tells outside rows apart, which get a folder of no day.
    counted = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(~within).alias("outside"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required])
    placed = counted.withColumn(VERSION, F.lit(version)).hint("rebalance", date_col)
    placed.write.mode("append").partitionBy(date_col, VERSION).parquet(f"{path}/data")
    folders = {d: f"{path}/data/{date_col}={d}/{VERSION}={version}" for d in days}
    try:
        found = _observed(seen)
        if found["outside"] or not found["n_rows"]:
            raise WriteRefused(f"{found['outside']} of {found['n_rows']} rows lie outside {days[0]} to {days[-1]}")
        if nulls := {c: n for c in required if (n := found[f"null_{c}"])}:
            raise WriteRefused(f"NULL in required columns: {nulls}")
        if empty := [d for d, f in folders.items() if not _exists(spark, f)]:
            raise WriteRefused(f"days without rows: {empty}")
        _commit(spark, path, (before[-1] if before else 0) + 1, {**table, **dict.fromkeys(days, version)})
        return found["n_rows"]
    except WriteRefused:
        for folder in folders.values():
            _remove(spark, folder)
        raise


def read_version(
    spark: SparkSession, path: str, schema: T.StructType, start: date | None = None, end: date | None = None, number: int | None = None, date_col: str = "date"
) -> DataFrame:
    """The published table, or its days from ``start`` up to before ``end``: only folders that the manifest names are listed."""
    wanted = {
        d: v for d, v in days_of(spark, path, number).items()
        if (start is None or d >= start.isoformat()) and (end is None or d < end.isoformat())
    }
    if not wanted:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/{date_col}={d}/{VERSION}={v}" for d, v in sorted(wanted.items())]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def remove_unlisted(spark: SparkSession, path: str, keep: int = 10) -> int:
    """Remove all but the newest ``keep`` manifests and every folder that none of these names; returns the folders removed.

    Not while a publication runs: its folders are not named yet.
    """
    known = manifests(spark, path)
    for number in known[:-keep]:
        _remove(spark, f"{path}/manifests/{number:010}.json")
    named = {(d, v) for number in known[-keep:] for d, v in days_of(spark, path, number).items()}
    made, files = _file(spark, f"{path}/data")
    removed = 0
    for day in files.listStatus(made) if files.exists(made) else []:
        if not day.isDirectory():
            continue
        for version in files.listStatus(day.getPath()):
            at = day.getPath().getName().partition("=")[2], version.getPath().getName().partition("=")[2]
            if at not in named:
                files.delete(version.getPath(), True)
                removed += 1
    return removed
