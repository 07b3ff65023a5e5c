"""The layers kept current batch by batch, with the result of a full run.

A reading keeps its first load. Scores are recomputed for new readings and for stored readings whose frame
they changed; facts are recomputed for every day that has such a row, by replacing day partitions. What a batch changes, and what
it keeps of the days it replaces, is written to folders of its own before it is moved in, so a batch that breaks off is finished when
it is repeated. Tables that do not read each other are written at the same time.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dimensional, enrich, marts, validation
from ..operators.dedup import dedup
from ..operators.ordered import flag_anomaly
from ..sources.key_index import KeyIndex
from ..sources.tables import is_written, overwrite_partitions, read_or_none, remove, rows_of, touched_partitions
from ..schemas import STAGED, columns
from ..streaming.rolling import DAY, keep_tails, rescore, stored_history

LOAD_DAY = "load_day"
WRITERS = 4


def together(*work: Callable[[], None]) -> None:
    """Run writes of different tables at the same time: one fills the cores that the last tasks of another leave. The first error is raised
    when all are done."""
    with ThreadPoolExecutor(WRITERS) as pool:
        for done in [pool.submit(inheritable_thread_target(one)) for one in work]:
            done.result()


@dataclass
class IncrementalLayers:
    """State tables below ``path``; :meth:`apply` takes one batch of staged readings."""

    spark: SparkSession
    path: str
    registry: DataFrame
    thresholds: DataFrame

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    @property
    def _index(self) -> KeyIndex:
        return KeyIndex(self.spark, self._at("index"))

    def read(self, name: str) -> DataFrame | None:
        return read_or_none(self.spark, self._at(name))

    def _days(self, name: str, days: list, by: str = DAY) -> DataFrame:
        """Rows of the given days; readings without a time have a day of their own."""
        return rows_of(self.read(name), by, days)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Bring all tables up to date with a batch. Repeating a batch id changes nothing."""
        own = f"{self._at('staged')}/batch_id={batch_id}"
        batch.select(*columns(STAGED)).withColumn(LOAD_DAY, F.to_date("loaded_at")) \
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(LOAD_DAY).parquet(own)
        staged = self.spark.read.parquet(own).select(*columns(STAGED))
        fresh, changed, kept = (self._at(f"{name}/batch={batch_id:09d}") for name in ("fresh", "changed", "kept"))
        if not is_written(self.spark, kept):  # else the batch broke off while its days were moved in
            dedup(self._index.unknown(staged, "reading_id", batch_id)).write.mode("overwrite").parquet(fresh)
            self._rescored(self.spark.read.parquet(fresh), batch_id).write.mode("overwrite").parquet(changed)
            rows, old = self.spark.read.parquet(changed), self.read("validated")
            rest = rows.filter(F.lit(False))
            if old is not None:
                rest = enrich.without(self._days("validated", touched_partitions(rows, DAY)), rows, "reading_id").select(*rows.columns)
            rest.write.mode("overwrite").parquet(kept)
        changed_rows = self.spark.read.parquet(changed)
        days = touched_partitions(changed_rows, DAY)
        work = [lambda: self._index.add(changed_rows.filter(F.col("batch_id") == batch_id), "reading_id", batch_id)]
        if days:
            merged = changed_rows.unionByName(self.spark.read.schema(changed_rows.schema).parquet(kept))
            overwrite_partitions(merged, self._at("validated"), DAY, LOAD_DAY)
            names = [*columns(STAGED), "batch_id"]
            work += [*self._facts(days), lambda: keep_tails(self.spark, self._at("validated"), self._at("tails"), days, names)]
        together(*work, lambda: self._count_files(changed_rows, staged))
        remove(self.spark, kept, changed, fresh)

    def _rescored(self, fresh: DataFrame, batch_id: int) -> DataFrame:
        """New readings and stored ones whose frames they change, validated; days before the first one are not read for scores."""
        names = [*columns(STAGED), "batch_id"]
        places = fresh.select("device_id", "reading_ts", "reading_id")
        history = None
        if self.read("validated") is not None:  # rows of this batch come again when it is repeated
            low = fresh.agg(F.min(F.to_date("reading_ts"))).first()[0]
            history = stored_history(self.spark, self._at("validated"), self._at("tails"), low, names)
            history = history.filter(F.col("batch_id") != batch_id)
            places = places.unionByName(history.select(*places.columns))
        scored = rescore(history, fresh.select(*columns(STAGED)).withColumn("batch_id", F.lit(batch_id)), profile=places)
        flagged = validation.flag_ranges(scored, self.thresholds).withColumn("is_anomaly", flag_anomaly())
        return flagged.withColumns({
            "validation_error_count": validation.error_count(),
            DAY: F.to_date("reading_ts"),
            LOAD_DAY: F.to_date("loaded_at"),
        })

    def _facts(self, days: list) -> list[Callable[[], None]]:
        """The writes of all facts of the given days."""
        validated = self._days("validated", days)
        enriched = enrich.enrich(validated, self.registry)
        rows = {  # a row per reading or sensor: they lie by day as the validated rows do, so they are written from where they are read
            "enriched": (enriched, F.to_date("reading_ts")),
            "quarantined": (validation.quarantine(validated, F.col("loaded_at")), F.to_date("reading_ts")),
            "late": (validation.late_arrivals(validated), F.to_date("reading_ts")),
            "obt": (dimensional.obt(enriched, self.registry, self.thresholds), F.to_date("reading_ts")),
            "anomalies": (marts.anomalies(validated, self.thresholds), F.to_date("detected_at")),
        }
        groups = {
            "hourly": (lambda: marts.hourly_readings(enriched), F.to_date("reading_hour")),
            "health": (lambda: marts.device_health(enriched, profile=validated), F.col("report_date")),
        }
        valid, bad = (touched_partitions(part, DAY) for part in validation.split_valid(validated))

        def written(name: str) -> None:
            df, day = rows[name] if name in rows else (groups[name][0](), groups[name][1])
            filled = bad if name in ("quarantined", "anomalies") else valid
            old = self.read(name)
            overwrite_partitions(df.withColumn(DAY, day), self._at(name), DAY, rebalance=name in groups)
            if old is not None and name != "late":  # a late reading stays late
                self._empty(name, old, [d for d in days if d not in filled])

        # the longest first
        return [lambda name=name: written(name) for name in ("obt", "enriched", "health", "hourly", "anomalies", "quarantined", "late")]

    def _empty(self, name: str, old: DataFrame, days: list) -> None:
        """Days whose last row of a fact went away, for instance because it became an anomaly."""
        for day in days:
            folder = f"{DAY}=" + ("__HIVE_DEFAULT_PARTITION__" if day is None else str(day))
            old.drop(DAY).filter(F.lit(False)).write.mode("overwrite").parquet(f"{self._at(name)}/{folder}")

    def _count_files(self, changed: DataFrame, staged: DataFrame) -> None:
        """Counters of the load days with new or changed rows, from the partitions of those days."""
        loads = staged.select(F.to_date("loaded_at").alias(LOAD_DAY)).union(changed.select(LOAD_DAY))
        days = touched_partitions(loads, LOAD_DAY)
        if days:
            counters = marts.quality_counters(
                self._days("staged", days, LOAD_DAY), self._days("validated", days, LOAD_DAY)
            )
            overwrite_partitions(counters, self._at("file_counters"), LOAD_DAY)

    def quality(self) -> DataFrame:
        """Scorecard per file; the counters have one row per file and load day."""
        return marts.scorecard(self.read("file_counters"))

    def overview(self) -> DataFrame:
        return marts.fleet_overview(self.read("health"), self.quality(), self.read("anomalies"))
