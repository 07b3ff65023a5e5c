"""The vault loaded batch by batch: hubs, link and satellites are insert-only, each with an index of its keys."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vault
from ..sources.key_index import KeyIndex
from ..sources.tables import read_or_none

READING_DAY = "reading_day"


@dataclass(frozen=True)
class Load:
    """How a table comes from staged rows, what names a row, and whether it is laid out by reading day."""

    build: Callable[..., DataFrame]
    key: tuple[str, ...]
    by_day: bool = False


LOADS = {
    "hub_device": Load(vault.hub_device, ("hub_device_hk",)),
    "hub_sensor_reading": Load(vault.hub_sensor_reading, ("hub_reading_hk",)),
    "link_device_reading": Load(vault.link_device_reading, ("link_device_reading_hk",), by_day=True),
    "sat_device_details": Load(vault.sat_device_details, ("hub_device_hk", "hashdiff")),
    "sat_reading_metrics": Load(vault.sat_reading_metrics, ("sat_reading_metrics_hk",), by_day=True),
}


@dataclass
class VaultTables:
    """The tables of ``names`` below ``path``; :meth:`apply` takes one batch of staged readings."""

    spark: SparkSession
    path: str
    names: tuple[str, ...] = tuple(LOADS)

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame | None:
        stored = read_or_none(self.spark, self._at(name))
        return None if stored is None else stored.drop("batch")

    def apply(self, batch: DataFrame, batch_id: int, as_of: Column) -> None:
        """Insert what no earlier batch has. A batch goes into folders of its own, so repeating it changes nothing.

        Per table the filters of its index are read and the folders of keys that may hold one of the batch, not the table.
        """
        for name, load in ((name, LOADS[name]) for name in self.names):
            index, own = KeyIndex(self.spark, f"{self._at('index')}/{name}"), f"{self._at(name)}/batch={batch_id:09d}"
            rows = load.build(batch, as_of).withColumn("_key", F.concat_ws("-", *load.key))
            fresh = index.unknown(rows, "_key", batch_id)
            writer = fresh.withColumn(READING_DAY, F.to_date("reading_ts")).write.partitionBy(READING_DAY) if load.by_day else fresh.write
            writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(own)
            index.add(self.spark.read.schema("_key string").parquet(own), "_key", batch_id)

    def average_temperature(self, registry: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
        """The vault's answer of the last hours; link and satellite are read for the days of these hours only."""
        return vault.dv_avg_temp(self.read("sat_reading_metrics"), self.read("link_device_reading"), self.read("hub_device"), registry, as_of, hours, READING_DAY)
