"""Registration of queries and their inputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixture
from ..functions.numbers import round_to
from ..plans.layers import Layers
from ..session import shared_dir, use_utc
from .oracle import rd, with_ctes


class Data:
    """Inputs of the registered queries, all derived by Spark from the tables of one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = use_utc(spark), sf_dir

    def scratch(self, label: str) -> str:
        return shared_dir(self.spark, label)

    @cached_property
    def events(self) -> DataFrame:
        return fixture.events(self.spark, self.sf_dir)

    @cached_property
    def staged(self) -> DataFrame:
        return fixture.staged(self.events)

    @cached_property
    def registry(self) -> DataFrame:
        return fixture.registry(self.spark)

    @cached_property
    def thresholds(self) -> DataFrame:
        return fixture.thresholds(self.spark)

    @cached_property
    def clusters(self) -> DataFrame:
        return fixture.clusters(self.spark)

    @cached_property
    def layers(self) -> Layers:
        return Layers(self.staged, self.registry, self.thresholds, self.clusters)

    @cached_property
    def settled(self) -> Layers:
        """The layers over a written validated table, for queries that use it several times."""
        layers = Layers(self.staged, self.registry, self.thresholds, self.clusters)
        return layers.settle(self.scratch("layers"), "validated")

    @cached_property
    def as_of(self) -> Column:
        return self.layers.as_of

    @cached_property
    def raw(self) -> DataFrame:
        """The raw table with drift fields."""
        return fixture.raw_variant(self.staged)

    @cached_property
    def raw_plain(self) -> DataFrame:
        return fixture.raw_variant(self.staged, drift=False)

    @cached_property
    def stream(self) -> DataFrame:
        return fixture.stream_raw(self.events)


@dataclass(frozen=True)
class Query:
    run: Callable[[Data], DataFrame]
    sql: str | None
    doubles: tuple[str, ...]
    longs: tuple[str, ...]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The result with doubles at six decimals and counters as bigint, as the SQL text has them.

        Both engines round half up on a decimal; a direct cast of a double rounds ties differently in each.
        """
        df = self.run(Data(spark, sf_dir))
        shown = {c: round_to(F.col(c), 6) for c in self.doubles}
        shown |= {c: F.col(c).cast("long") for c in self.longs}
        return df.withColumns(shown) if shown else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        shown = [f"{rd(c, 6)} AS {c}" for c in self.doubles] + [f"CAST({c} AS BIGINT) AS {c}" for c in self.longs]
        if not shown:
            return with_ctes(self.sql)
        return with_ctes(f"SELECT * REPLACE ({', '.join(shown)}) FROM ({self.sql}) AS result")


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, doubles: str = "", longs: str = ""):
    def add(run: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(run, sql, tuple(doubles.split()), tuple(longs.split()))
        return run

    return add


MEASURES = "temperature humidity pressure battery_pct co2_level latitude longitude"


def joined(column: str) -> Column:
    return F.array_join(column, ",")
