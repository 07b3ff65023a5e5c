"""The layer rules on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup
from ..operators.moments import hourly_facts, hourly_moments, merge_hours
from ..operators.staging import stage_readings
from ..operators.validation import REASONS, error_count, flag_ranges, late_arrivals
from ..sources.key_index import KeyIndex
from ..sources.messages import split_deadletter
from ..sources.tables import overwrite_partitions, read_or_none, rows_of, touched_partitions

NO_DAY = "1970-01-01"


def parse_stream(messages: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Staged rows and dead letters of a message stream. Needs ``loaded_at`` and ``source_file`` on the messages."""
    good, bad = split_deadletter(messages)
    return stage_readings(good).select("*"), bad.select("value", "reason", *keep)


def write_deduped(staged: DataFrame, dst: str, checkpoint: str, index: str | None = None, **trigger) -> StreamingQuery:
    """First copy of each reading, whatever its clocks say: ids are looked up in an index of keys, not in a state with a watermark.

    A batch goes into its own folder of ``dst``, so a repeated batch replaces itself. Of earlier batches only the filters of the
    index (below ``index``, by default beside ``dst``) are read, and those of its folders that may hold an id of the batch.
    """
    known = KeyIndex(staged.sparkSession, index or f"{dst.rstrip('/')}_index")

    def land(batch: DataFrame, batch_id: int) -> None:
        own = f"{dst}/batch={batch_id:09d}"
        known.unknown(dedup(batch), "reading_id", batch_id).write.mode("overwrite").parquet(own)
        known.add(batch.sparkSession.read.schema(batch.schema).parquet(own), "reading_id", batch_id)

    return staged.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land).trigger(**(trigger or {"availableNow": True})).start()


def validate_stream(staged: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Range flags, error count and reasons; the z-score needs earlier rows, see :mod:`rolling`."""
    flagged = flag_ranges(staged, thresholds).withColumn("is_anomaly", F.lit(False))
    named = [F.when(~F.col(flag), F.lit(text)) for flag, text in REASONS.items()]
    return flagged.withColumns({
        "validation_error_count": error_count(),
        "rejection_reasons": F.array_compact(F.array(*named)),
    })


def late_stream(staged: DataFrame, minutes: int = 60) -> DataFrame:
    return late_arrivals(staged, minutes)


def write_hourly(enriched: DataFrame, store: str, dst: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Keep the hourly fact table current without a watermark, so no clock, early or late, ever drops a reading.

    No reading is stored. ``store`` holds the mergeable state of each device and hour, partitioned by day. A batch adds the state of its own
    rows and merges it with that of the days it touches, so it reads at most two rows per device and hour of those days.
    The newest batch stays apart from what came before: one that is repeated replaces its own part. Readings without a
    time count to the day ``NO_DAY``.
    """
    day = F.coalesce(F.to_date("reading_hour"), F.lit(NO_DAY).cast("date"))

    def land(batch: DataFrame, batch_id: int) -> None:
        spark, own, state = batch.sparkSession, f"{store}/batch", f"{store}/state"
        hourly_moments(batch).withColumns({"report_day": day, "batch": F.lit(batch_id).cast("long")}).write.mode("overwrite").parquet(own)
        new = spark.read.parquet(own)
        days = touched_partitions(new, "report_day")
        if not days:
            return
        before = hours_of(spark, state, days)
        if before is not None:
            settled = merge_hours(before.filter(F.col("batch") < batch_id))
            new = new.unionByName(settled.withColumns({"report_day": day, "batch": F.lit(batch_id - 1).cast("long")}))
        overwrite_partitions(new, state, "report_day")
        facts = hourly_facts(merge_hours(hours_of(spark, state, days))).withColumn("report_day", day)
        overwrite_partitions(facts, dst, "report_day")

    return enriched.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land).trigger(**(trigger or {"availableNow": True})).start()


def hours_of(spark: SparkSession, state: str, days: list) -> DataFrame | None:
    """The stored states of the given days; other days are not read."""
    stored = read_or_none(spark, state)
    return None if stored is None else rows_of(stored, "report_day", days)
