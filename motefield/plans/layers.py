"""The model graph: staging to marts as lazily composed DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import cached_property
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timing import as_ts
from ..operators import dedup, dimensional, enrich, marts, staging, validation, vault
from ..sources.tables import read_or_none


@dataclass
class Layers:
    """Every dataset by name. Nothing runs until a dataset is written or read.

    ``split`` holds the slicing arguments of the rolling z-score.
    """

    staged: DataFrame
    registry: DataFrame
    thresholds: DataFrame
    clusters: DataFrame
    now: Column | dt.datetime | str | None = None
    split: dict = field(default_factory=dict)

    @cached_property
    def as_of(self) -> Column:
        """The time of the run; by default the latest load."""
        return self.staged.agg(F.max("loaded_at")).scalar() if self.now is None else as_ts(self.now)

    def settle(self, path: str, *names: str) -> Layers:
        """Write datasets below ``path`` and go on from the written tables.

        For plans that use a dataset several times: it is computed once, and a lost executor does not
        reach back behind the table.
        """
        for name in names:
            target = f"{path.rstrip('/')}/{name}"
            getattr(self, name).write.mode("overwrite").parquet(target)
            self.__dict__[name] = self.staged.sparkSession.read.parquet(target)
        return self

    @property
    def _split(self) -> dict:
        # staged rows have about the devices and times of the layers made from them, and need no shuffle to profile
        return {"profile": self.staged} | self.split

    @cached_property
    def metadata(self) -> DataFrame:
        return staging.stage_device_metadata(self.staged)

    @cached_property
    def deduped(self) -> DataFrame:
        return dedup.dedup(self.staged)

    @cached_property
    def validated(self) -> DataFrame:
        return validation.validate(self.deduped, self.thresholds, **self._split)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich(self.validated, self.registry)

    @cached_property
    def quarantined(self) -> DataFrame:
        return validation.quarantine(self.validated, self.as_of)

    @cached_property
    def late(self) -> DataFrame:
        return validation.late_arrivals(self.deduped)

    @cached_property
    def hourly(self) -> DataFrame:
        return marts.hourly_readings(self.enriched)

    @cached_property
    def health(self) -> DataFrame:
        return marts.device_health(self.enriched, **self._split)

    @cached_property
    def anomalies(self) -> DataFrame:
        return marts.anomalies(self.validated, self.thresholds)

    @cached_property
    def quality(self) -> DataFrame:
        return marts.data_quality_of(self.staged, self.validated)

    @cached_property
    def overview(self) -> DataFrame:
        return marts.fleet_overview(self.health, self.quality, self.anomalies)

    @cached_property
    def dim_devices(self) -> DataFrame:
        return marts.dim_devices(self.registry, self.metadata, self.as_of)

    @cached_property
    def dim_clusters(self) -> DataFrame:
        return marts.dim_clusters(self.clusters)

    @cached_property
    def obt(self) -> DataFrame:
        return dimensional.obt(self.enriched, self.registry, self.thresholds)

    @cached_property
    def dim_cluster(self) -> DataFrame:
        return dimensional.dim_cluster(self.registry)

    @cached_property
    def dim_device_type(self) -> DataFrame:
        return dimensional.dim_device_type(self.registry)

    @cached_property
    def dim_device_normalized(self) -> DataFrame:
        return dimensional.dim_device_normalized(
            self.registry, self.metadata, self.dim_cluster, self.dim_device_type, self.as_of
        )

    @cached_property
    def dim_time(self) -> DataFrame:
        return dimensional.dim_time_spanning(self.staged)

    @cached_property
    def fct_normalized(self) -> DataFrame:
        return dimensional.fct_readings_normalized(self.enriched, self.dim_device_normalized, self.dim_time)

    @cached_property
    def hub_device(self) -> DataFrame:
        return vault.hub_device(self.staged, self.as_of)

    @cached_property
    def hub_reading(self) -> DataFrame:
        return vault.hub_sensor_reading(self.staged, self.as_of)

    @cached_property
    def link(self) -> DataFrame:
        return vault.link_device_reading(self.staged, self.as_of)

    @cached_property
    def sat_device(self) -> DataFrame:
        return vault.sat_device_details(self.staged, self.as_of)

    @cached_property
    def sat_reading(self) -> DataFrame:
        return vault.sat_reading_metrics(self.staged, self.as_of)


@dataclass(frozen=True)
class Model:
    """A written table: the dataset it holds and the tables it is made from."""

    dataset: str
    inputs: tuple[str, ...] = ()


MODELS = {
    "int_readings_deduped": Model("deduped"),
    "int_readings_validated": Model("validated", ("int_readings_deduped",)),
    "int_readings_enriched": Model("enriched", ("int_readings_validated",)),
    "int_quarantined_readings": Model("quarantined", ("int_readings_validated",)),
    "int_late_arriving_readings": Model("late", ("int_readings_deduped",)),
    "dim_clusters": Model("dim_clusters"),
    "dim_devices": Model("dim_devices"),
    "fct_hourly_readings": Model("hourly", ("int_readings_enriched",)),
    "fct_device_health": Model("health", ("int_readings_enriched",)),
    "fct_anomalies": Model("anomalies", ("int_readings_validated",)),
    "fct_data_quality": Model("quality", ("int_readings_validated",)),
    "rpt_fleet_overview": Model("overview", ("fct_device_health", "fct_data_quality", "fct_anomalies")),
    "obt_readings": Model("obt", ("int_readings_enriched",)),
    "dim_cluster": Model("dim_cluster"),
    "dim_device_type": Model("dim_device_type"),
    "dim_device_normalized": Model("dim_device_normalized", ("dim_cluster", "dim_device_type")),
    "dim_time": Model("dim_time"),
    "fct_readings_normalized": Model("fct_normalized", ("int_readings_enriched", "dim_device_normalized", "dim_time")),
    "hub_device": Model("hub_device"),
    "hub_sensor_reading": Model("hub_reading"),
    "link_device_reading": Model("link"),
    "sat_device_details": Model("sat_device"),
    "sat_reading_metrics": Model("sat_reading"),
}


def in_order(models: dict[str, Model] = MODELS) -> list[str]:
    """Every table after those it is made from; a circle is an error."""
    return list(TopologicalSorter({name: model.inputs for name, model in models.items()}).static_order())


def select_models(*wanted: str, models: dict[str, Model] = MODELS) -> list[str]:
    """The tables asked for, in order: ``name``, ``+name`` with all it is made from, ``name+`` with all made from it. Nothing asked means all."""
    after = {name: [other for other, model in models.items() if name in model.inputs] for name in models}

    def reached(name: str, steps: Callable[[str], Iterable[str]]) -> set[str]:
        found, todo = set(), [name]
        while todo:
            for other in steps(todo.pop()):
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return found

    chosen: set[str] = set() if wanted else set(models)
    for asked in wanted:
        name = asked.strip("+")
        if name not in models:
            raise KeyError(f"no model {name}")
        chosen.add(name)
        if asked.startswith("+"):
            chosen |= reached(name, lambda n: models[n].inputs)
        if asked.endswith("+"):
            chosen |= reached(name, lambda n: after[n])
    return [name for name in in_order(models) if name in chosen]


def run_models(spark: SparkSession, layers: Layers, path: str, *wanted: str) -> dict[str, DataFrame]:
    """Write the models asked for (see :func:`select_models`) below ``path`` and return the written tables by name.

    Each table is read back for the ones after it, so every model is computed once and a lost executor repeats one stage, not the
    whole graph. What a model is made from and was not asked for is read from an earlier run, or computed if there is none.
    """
    layers.__dict__["as_of"] = as_ts(layers.now) if layers.now is not None else F.lit(
        layers.staged.agg(F.max("loaded_at")).first()[0]
    ).cast("timestamp_ntz")
    layers.split.setdefault("profile", None)
    chosen, written = select_models(*wanted), {}
    for name in in_order():
        target = f"{path.rstrip('/')}/{name}"
        dataset = MODELS[name].dataset
        if name in chosen:
            getattr(layers, dataset).write.mode("overwrite").parquet(target)
            written[name] = layers.__dict__[dataset] = spark.read.parquet(target)
        elif wanted and (stored := read_or_none(spark, target)) is not None:
            layers.__dict__[dataset] = stored
    return written
