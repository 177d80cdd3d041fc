"""Feature export: key text and positional vector per entity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremill.sources.scan import latest_snapshot, partition

# Message field per sorted set of entity keys.
ENTITY_FIELDS = {
    ("account_id",): "accountFeatureSet",
    ("query",): "queryFeatureSet",
    ("sku_group_id",): "skuGroupFeatureSet",
    ("account_id", "category_id"): "accountToCategoryFeatureSet",
    ("category_id", "sku_group_id"): "skuGroupToCategoryFeatureSet",
    ("query", "sku_group_id"): "skuGroupToQueryFeatureSet",
    ("promotion_id", "sku_group_id"): "skuGroupToPromoFeatureSet",
}


@dataclass(frozen=True)
class FeatureGroup:
    """One exported group: which table, which keys, which features in which order."""

    name: str
    source: str
    primary_key: tuple[str, ...]
    features: tuple[str, ...]
    log1p: frozenset[str] = field(default_factory=frozenset)
    timestamp_column: str | None = None

    def __post_init__(self) -> None:
        if "date" not in self.primary_key and self.timestamp_column not in self.primary_key:
            raise ValueError(f"{self.name}: the primary key needs a date or the timestamp column")
        self.entity_field  # unknown key sets fail early

    @property
    def entity_keys(self) -> tuple[str, ...]:
        snapshot = "date" if "date" in self.primary_key else self.timestamp_column
        return tuple(k for k in self.primary_key if k != snapshot)

    @property
    def entity_field(self) -> str:
        try:
            return ENTITY_FIELDS[tuple(sorted(self.entity_keys))]
        except KeyError:
            raise ValueError(f"{self.name}: no message type for keys {self.entity_keys}") from None


def choose(groups: Sequence[FeatureGroup], wanted: Sequence[tuple[str, Sequence[str]]] | None) -> list[FeatureGroup]:
    """The requested groups with the requested features, in the requested order; all by default."""
    if not wanted:
        return list(groups)
    known = {g.name: g for g in groups}
    out = []
    for name, features in wanted:
        if name not in known:
            raise ValueError(f"unknown feature group: {name}")
        g = known[name]
        out.append(replace(g, features=tuple(features), log1p=frozenset(f for f in g.log1p if f in features)))
    return out


def snapshot_frame(table: DataFrame, group: FeatureGroup, on: date) -> DataFrame:
    """Keys and features of the day, or of the newest timestamp; missing features are 0."""
    if "date" in group.primary_key:
        rows = partition(table, on)
    else:
        rows = latest_snapshot(table, group.timestamp_column)
    zero = F.lit(0.0)
    return rows.select(
        *group.entity_keys,
        *[F.coalesce(F.nanvl(F.col(f).cast("double"), zero), zero).alias(f) for f in group.features],
    )


def export_frame(table: DataFrame, group: FeatureGroup, on: date) -> DataFrame:
    """(key, value, features): text key, JSON message and the vector. Built-in functions only."""
    rows = snapshot_frame(table, group, on)
    vector = F.array(*[F.log1p(f) if f in group.log1p else F.col(f) for f in group.features])
    key = F.concat_ws(
        "|", F.lit(group.name), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in group.entity_keys]
    )
    message = F.to_json(
        F.struct(
            F.lit(group.entity_field).alias("update_field"),
            F.lit(group.name).alias("fsName"),
            F.struct(*group.entity_keys).alias("keys"),
            vector.alias("features"),
        )
    )
    return rows.select(key.alias("key"), message.alias("value"), vector.alias("features"))


def write_to_bus(frame: DataFrame, brokers: str, topic: str, options: dict[str, str] | None = None) -> None:
    """Send (key, value) to a Kafka topic; needs the connector on the class path."""
    (
        frame.select("key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .options(**{"kafka.compression.type": "snappy", "kafka.acks": "all", **(options or {})})
        .save()
    )
