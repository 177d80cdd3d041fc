"""The newest row of each key as a bucketed table, so that a day's rows meet it without the state being shuffled.

The state is a table of the session catalog, hash-bucketed and sorted by its key. Each day gets a version of its own
(``name_yyyymmdd``), written from the version before and the day's rows: only these are shuffled, to the state's buckets. A day
that is run again starts from the version before it, so it gives the same version again; a failed run leaves earlier
versions as they are. The number of buckets should give buckets of some hundred megabytes; it is the number of tasks of a run,
and must not be below ``spark.sql.shuffle.partitions``, or Spark shuffles both sides to that many.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class StateTable:
    """Versions of a state with the given key, below ``folder``."""

    name: str
    folder: str
    schema: T.StructType
    key: tuple[str, ...]
    buckets: int = 200
    keep: int = 3

    def _table(self, on: date) -> str:
        return f"{self.name}_{on:%Y%m%d}"

    def versions(self, spark: SparkSession) -> list[date]:
        """Days with a version, oldest first."""
        found = []
        for table in spark.catalog.listTables(pattern=f"{self.name}_*"):
            stamp = table.name.removeprefix(f"{self.name}_")
            if len(stamp) == 8 and stamp.isdigit():
                found.append(date(int(stamp[:4]), int(stamp[4:6]), int(stamp[6:])))
        return sorted(found)

    def before(self, spark: SparkSession, on: date) -> DataFrame:
        """The state as the day finds it: the newest version of an earlier day, or no rows."""
        if self.buckets < int(spark.conf.get("spark.sql.shuffle.partitions")):
            raise ValueError("a state with fewer buckets than spark.sql.shuffle.partitions would be shuffled")
        earlier = [v for v in self.versions(spark) if v < on]
        return spark.table(self._table(earlier[-1])) if earlier else spark.createDataFrame([], self.schema)

    def version(self, spark: SparkSession, on: date) -> DataFrame:
        """The state of the day itself; a day without a version is an error."""
        if on not in self.versions(spark):
            raise ValueError(f"{self.name} has no version of {on}")
        return spark.table(self._table(on))

    def drop(self, spark: SparkSession, days: Iterable[date]) -> None:
        """Take versions out of the catalog; their files stay, as those of old versions do."""
        for on in days:
            spark.sql(f"DROP TABLE IF EXISTS {self._table(on)}")

    def merged(self, state: DataFrame, rows: DataFrame) -> DataFrame:
        """The state with the rows in place of those of the same keys; ``rows`` has one row for each key."""
        columns = [f.name for f in self.schema]
        new = rows.select(*[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_new"))
        same = [state[k] == new[f"_{k}"] for k in self.key]
        both = state.join(new, same, "full")
        return both.select(*[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns])

    def write(self, on: date, frame: DataFrame) -> DataFrame:
        """Make ``frame`` the version of the day, and drop the oldest beyond ``keep``."""
        spark = frame.sparkSession
        table = self._table(on)
        (
            frame.write.mode("overwrite").format("parquet").option("path", f"{self.folder}/{table}")
            .bucketBy(self.buckets, *self.key).sortBy(*self.key).saveAsTable(table)
        )
        # The files of dropped versions stay for whoever reads them; removing them is up to the keeper of the folder.
        self.drop(spark, self.versions(spark)[: -self.keep])
        return spark.table(table)

