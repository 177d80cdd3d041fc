"""What the operators share: tables, the shared folder, row maps over Arrow batches.

Conventions of all operators: they select the id and text columns they need and leave every other column alone, so extra
columns never clash; NULL text is empty text; rows with equal ids are separate rows with results of their own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of an Arrow batch that are Python objects at a time.
SLICE_ROWS = 2_000
ASCII_SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder that all executors share (``spark.checkpoint.dir``).

    Only a session inside one process (tests) may do without that setting and gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "featuremill-shared")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, lineage cut, safe against lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of_id(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, empty for NULL."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_texts(
    docs: DataFrame,
    text: str,
    fields: T.StructType,
    open_task: Callable[[], Callable[[dict[str, pa.Array], list[bytes]], list[pa.Array]]],
    carry: list[str],
) -> DataFrame:
    """Append columns computed from texts, one Arrow batch at a time.

    ``open_task`` runs once per task and returns a function from (carried columns, texts) to one array for each field. The
    columns in ``carry`` pass through; where one has the name of a result, the result takes its place.
    """
    names = {f.name.lower() for f in fields}
    sent = list(dict.fromkeys([*carry, text]))
    kept = [c for c in carry if c.lower() not in names]
    source = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(sent)])
    schema = T.StructType([*(T.StructField(c, docs.schema[c].dataType, True) for c in kept), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, work = to_arrow_schema(schema), open_task()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                columns = dict(zip(sent, batch.slice(at, SLICE_ROWS).columns, strict=True))
                made = work(columns, byte_texts(columns[text]))
                yield pa.RecordBatch.from_arrays([*(columns[c] for c in kept), *made], schema=target)

    return source.mapInArrow(run, schema)
