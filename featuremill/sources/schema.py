"""Table contracts and schema tools."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StructType


#: How a run changes a table: it replaces days of a range, replaces the snapshots that it brings, or adds keys not yet known.
WRITE_MODES = ("replace_day", "replace_snapshot", "append")


@dataclass(frozen=True)
class FeatureTable:
    """Contract of one feature table."""

    name: str
    layer: str
    primary_key: tuple[str, ...]
    builder: Callable[..., DataFrame]
    mode: str = "replace_day"

    def __post_init__(self) -> None:
        if self.mode not in WRITE_MODES:
            raise ValueError(f"{self.name}: write mode {self.mode!r} is none of {WRITE_MODES}")

    @property
    def partition_column(self) -> str | None:
        """The snapshot part of the key; None for dictionaries without one."""
        return next((k for k in self.primary_key if k in ("date", "calculated_at", "event_date")), None)

    @property
    def entity_keys(self) -> tuple[str, ...]:
        return tuple(k for k in self.primary_key if k != self.partition_column)


def align_to_schema(
    df: DataFrame, schema: StructType, on_missing: str = "null", retired: Sequence[str] = ()
) -> DataFrame:
    """Project to the target's columns, order and types.

    A missing column becomes a typed NULL (``on_missing="null"``) or an error;
    retired columns are always written as NULL. Extra columns are dropped.
    """
    if on_missing not in ("null", "error"):
        raise ValueError(f"on_missing must be 'null' or 'error', got {on_missing!r}")
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have and f.name not in retired]
    if missing and on_missing == "error":
        raise ValueError(f"columns missing from the frame: {missing}")
    return df.select(
        *[
            (
                F.col(f.name) if f.name in have and f.name not in retired else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def cast_copy(df: DataFrame, schema: StructType) -> DataFrame:
    """Backfill copy: the target's columns cast from the source; bad values become NULL. No shuffle."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class AddColumn:
    name: str
    data_type: DataType | str


@dataclass(frozen=True)
class RenameColumn:
    """Rename if the old name exists and the new one does not.

    ``unless_type``: keep the old column when it already has this type.
    """

    name: str
    new_name: str
    unless_type: str | None = None


def evolve_schema(df: DataFrame, changes: Sequence[AddColumn | RenameColumn]) -> DataFrame:
    """Additive, idempotent schema changes: running them twice changes nothing."""
    for change in changes:
        types = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
        if isinstance(change, AddColumn):
            if change.name.lower() not in types:
                df = df.withColumn(change.name, F.lit(None).cast(change.data_type))
            continue
        old = types.get(change.name.lower())
        if old is None or change.new_name.lower() in types:
            continue
        if change.unless_type and old == change.unless_type.lower():
            continue
        df = df.withColumnRenamed(change.name, change.new_name)
    return df


def fill_by_type(df: DataFrame, named: dict | None = None, skip: Sequence[str] = ()) -> DataFrame:
    """NULL and NaN to 0 in numeric columns; named defaults win; other types keep NULL."""
    named = named or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in named:
            c = F.coalesce(c, F.lit(named[f.name]).cast(f.dataType))
        elif isinstance(f.dataType, NumericType) and f.name not in skip:
            if f.dataType.typeName() in ("double", "float"):
                c = F.nanvl(c, F.lit(0.0).cast(f.dataType))
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)
