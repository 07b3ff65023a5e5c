"""Files and messages into the raw tables, exactly once per checkpoint."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import CORRUPT, audit_load, stream_raw_variant
from ..sources.messages import split_deadletter, stream_rows
from ..sources.tables import read_or_none


def dead_letters_of(dst: str) -> str:
    """The table of what does not parse: pieces of damaged files, or a file as a whole if none of it can be read, so nothing is lost."""
    return f"{dst}_dead"


def audit_of(dst: str) -> str:
    """The table with one row per file and load."""
    return f"{dst}_audit"


def _load(stream: DataFrame, dst: str, checkpoint: str, trigger: dict, seen: list[int]) -> StreamingQuery:
    """Good rows to ``dst``, broken pieces to the dead letters, a row per file to the audit.

    Each batch writes folders named after its id, so a repeated batch replaces itself. A file that holds an empty array has no
    rows and no audit row.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, f"batch={batch_id:09d}"
        batch = batch.persist(StorageLevel.DISK_ONLY)
        broken = F.col(CORRUPT).isNotNull()
        batch.filter(~broken).drop(CORRUPT).write.mode("overwrite").parquet(f"{dst}/{own}")
        batch.filter(broken).select(F.col(CORRUPT).alias("value"), "source_file", "loaded_at") \
            .write.mode("overwrite").parquet(f"{dead_letters_of(dst)}/{own}")
        audit_load(batch, F.max("loaded_at")).write.mode("overwrite").parquet(f"{audit_of(dst)}/{own}")
        batch.unpersist()
        seen.append(spark.read.parquet(f"{audit_of(dst)}/{own}").count())

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land).trigger(**trigger).start()


def load_new_files(spark: SparkSession, src: str, dst: str, checkpoint: str,
                   loaded_at: Column | dt.datetime | None = None, max_files: int | None = None,
                   pattern: str = "*.json") -> int:
    """Append files not loaded before and return how many files were read; a second run loads none."""
    seen: list[int] = []
    _load(stream_raw_variant(spark, src, pattern, loaded_at, max_files), dst, checkpoint, {"availableNow": True}, seen) \
        .awaitTermination()
    return sum(seen)


def ingest_continuous(spark: SparkSession, src: str, dst: str, checkpoint: str, interval: str = "1 minute",
                      max_files: int | None = None, pattern: str = "*.json") -> StreamingQuery:
    """The same load, running until stopped."""
    stream = stream_raw_variant(spark, src, pattern, max_files=max_files)
    return _load(stream, dst, checkpoint, {"processingTime": interval}, [])


def read_changes(spark: SparkSession, table: str) -> DataFrame:
    """The append-only change feed of a Parquet table."""
    return spark.readStream.schema(spark.read.parquet(table).schema).parquet(table)


def consumed_of(checkpoint: str) -> str:
    """The table of files that a consumer of the change feed has taken."""
    return f"{checkpoint}_consumed"


def consume_changes(spark: SparkSession, table: str, checkpoint: str,
                    handle: Callable[[DataFrame, int], None]) -> int:
    """Hand over what was appended since the last call and remember it; returns the number of rows handed over."""
    changes = read_changes(spark, table).select("*", F.col("_metadata.file_path").alias("_file"))

    def take(batch: DataFrame, batch_id: int) -> None:
        handle(batch.drop("_file"), batch_id)
        batch.groupBy(F.col("_file").alias("path")).agg(F.count(F.lit(1)).alias("rows")) \
            .write.mode("overwrite").parquet(f"{consumed_of(checkpoint)}/batch={batch_id:09d}")

    taken = read_or_none(spark, consumed_of(checkpoint))
    newest = -1 if taken is None else taken.agg(F.max("batch")).first()[0]
    changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take).trigger(availableNow=True).start() \
        .awaitTermination()
    taken = read_or_none(spark, consumed_of(checkpoint))
    if taken is None:
        return 0
    return taken.filter(F.col("batch") > newest).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def has_new(spark: SparkSession, table: str, checkpoint: str) -> bool:
    """Whether the table has files that :func:`consume_changes` has not taken. Lists files, reads no rows and consumes nothing."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(table)
    files, taken = listed.select(F.col("_metadata.file_path").alias("path")), read_or_none(spark, consumed_of(checkpoint))
    return not (files if taken is None else files.join(taken, "path", "left_anti")).isEmpty()


def write_raw_stream(messages: DataFrame, dst: str, dead_letters: str, checkpoint: str, seconds: int | None = 10,
                     loaded_at: Column | None = None) -> StreamingQuery:
    """Message micro-batches into the raw stream table; bad messages go to their own table.

    Batch size is bounded at the source (``maxOffsetsPerTrigger``), latency by ``seconds``; ``None`` drains what is
    there and stops. A batch writes into folders named after its id, so a repeated batch replaces itself.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_deadletter(batch)
        stream_rows(good, loaded_at).write.mode("overwrite").parquet(f"{dst}/batch={batch_id:09d}")
        bad.write.mode("overwrite").parquet(f"{dead_letters}/batch={batch_id:09d}")

    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    return messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land).trigger(**trigger).start()


def replay(spark: SparkSession, src: str, dst: str, checkpoint: str, **options) -> int:
    """Everything again from the beginning: needs a target and a checkpoint that do not exist yet."""
    for path in (dst, checkpoint):
        try:
            used = not spark.read.text(f"{path}/*").isEmpty()
        except AnalysisException:
            used = False
        if used:
            raise ValueError(f"{path} is in use; replay into fresh folders")
    return load_new_files(spark, src, dst, checkpoint, **options)
