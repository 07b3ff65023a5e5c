"""Rolling z-score over micro-batches.

Row-count frames do not exist on streams. Each micro-batch is scored together with the last rows of its devices
from the days before, kept in a small table, and the stored days from its first reading on: a reading that arrives out of
order changes the frames of those after it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.enrich import without
from ..operators.ordered import rolling_zscore
from ..sources.tables import is_written, overwrite_partitions, read_or_none, remove, rows_of, touched_partitions

DAY = "reading_day"


def _newest(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """The last ``n`` rows per device (and ``by``); the group limit keeps at most ``n`` per map task and device."""
    order = Window.partitionBy("device_id", *by).orderBy(F.col("reading_ts").desc_nulls_last(), F.col("reading_id").desc())
    return rows.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= n).drop("_row")


def rescore(history: DataFrame | None, new: DataFrame, n: int = 12, parity: bool = False, **split) -> DataFrame:
    """New rows and the stored rows after the first new one of their device, scored as in a full run.

    ``history`` and ``new`` have the same columns, without the score, and no common ids. Readings without a time
    come last. ``parity`` scores every batch by itself, with frames that start anew.
    """
    columns = new.columns
    if history is None or parity:
        return rolling_zscore(new, n=n, **split)
    first = new.groupBy(F.col("device_id").alias("_device")).agg(F.min("reading_ts").alias("_from"))
    touched = history.join(first, F.col("device_id").eqNullSafe(F.col("_device")))
    ts, start = F.col("reading_ts"), F.col("_from")
    after = touched.filter(ts.isNull() | (ts >= start)).select(*columns)
    before = _newest(touched.filter(ts.isNotNull() & (start.isNull() | (ts < start))).select(*columns), n)
    marked = (
        before.withColumn("_keep", F.lit(False))
        .unionByName(after.withColumn("_keep", F.lit(True)))
        .unionByName(new.withColumn("_keep", F.lit(True)))
    )
    return rolling_zscore(marked, n=n, **split).filter("_keep").drop("_keep")


def stored_history(spark: SparkSession, scored: str, tails: str, low: dt.date | None, columns: Sequence[str]) -> DataFrame | None:
    """The stored rows that :func:`rescore` may need for new rows from day ``low`` on.

    Of days before ``low`` only the last rows of each device and day are read, from the small table ``tails``; partition
    pruning keeps the scan of ``scored`` to the days from ``low`` on and to readings without a time.
    """
    table, ends = read_or_none(spark, scored), read_or_none(spark, tails)
    if table is None or ends is None:
        return None if table is None else table.select(*columns)
    untimed = F.col(DAY).isNull()
    if low is None:
        return table.filter(untimed).select(*columns).unionByName(ends.select(*columns))
    recent = table.filter(untimed | (F.col(DAY) >= F.lit(low)))
    return recent.select(*columns).unionByName(ends.filter(F.col(DAY) < F.lit(low)).select(*columns))


def keep_tails(spark: SparkSession, scored: str, tails: str, days: list, columns: Sequence[str], n: int = 12) -> None:
    """Write the last ``n`` rows per device of the given days anew."""
    dated = rows_of(spark.read.parquet(scored), DAY, [d for d in days if d is not None]).select(*columns, DAY)
    overwrite_partitions(_newest(dated, n, DAY), tails, DAY)


def score_stream(readings: DataFrame, dst: str, checkpoint: str, n: int = 12, **trigger) -> StreamingQuery:
    """Deduplicated readings into a scored table partitioned by reading day.

    A batch reads the stored days from its first reading on and the last rows per device of the days before. What it changes is
    written to ``log`` first and then moved in: a batch that broke off while moving is finished from the log, and one that is
    repeated upserts by reading id, so either leaves the same tables.
    """
    scored, tails = f"{dst}/scored", f"{dst}/tails"

    def land(batch: DataFrame, batch_id: int) -> None:
        spark, columns, log = batch.sparkSession, batch.columns, f"{dst}/log/batch={batch_id:09d}"
        if not is_written(spark, log):
            low = batch.agg(F.min(F.to_date("reading_ts"))).first()[0]
            history = stored_history(spark, scored, tails, low, columns)
            if history is not None:  # a repeated batch must not meet its own rows
                history = without(history, batch, "reading_id")
            out = f"{dst}/log/scores={batch_id:09d}"
            rescore(history, batch, n).withColumn(DAY, F.to_date("reading_ts")).write.mode("overwrite").parquet(out)
            by_day = spark.read.parquet(out)
            table = read_or_none(spark, scored)
            if table is not None:
                old = rows_of(table, DAY, touched_partitions(by_day, DAY))
                by_day = by_day.unionByName(without(old, by_day, "reading_id").select(*by_day.columns))
            by_day.write.mode("overwrite").parquet(log)
            remove(spark, out)
        changed = spark.read.parquet(log)
        days = touched_partitions(changed, DAY)
        if days:
            overwrite_partitions(changed, scored, DAY)
            keep_tails(spark, scored, tails, days, columns, n)
        remove(spark, log)

    return readings.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land) \
        .trigger(**(trigger or {"availableNow": True})).start()
