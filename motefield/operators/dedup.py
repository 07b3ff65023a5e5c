"""One row per key.

``row_number() = 1`` is planned with a group limit on both sides of the shuffle: each map task keeps at most
one row per key before anything is sent, so a key with very many copies stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order; name enough columns to make the order total."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_row", position).filter(F.col("_row") == 1).drop("_row")


def dedup(df: DataFrame, keys: Sequence[str] = ("reading_id",), order: Sequence[Column] | None = None) -> DataFrame:
    """Earliest load of each reading."""
    if order is None:
        order = [F.col("loaded_at").asc_nulls_last(), F.col("source_file").asc_nulls_last()]
    return first_per(df, keys, order)


def latest_per_key(df: DataFrame, key: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    return first_per(df, [key], [F.col(ts).desc_nulls_last(), *[F.col(t).desc_nulls_last() for t in ties]])


def compact(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Log compaction: the last event of each key."""
    return first_per(log, [key], [F.col(c).desc_nulls_last() for c in order])


def dedup_effect(staged: DataFrame, deduped: DataFrame, day: str = "loaded_at") -> DataFrame:
    """Distinct ids before and after dedup per load day, and the rows removed.

    ``dupes_removed`` compares distinct ids, so it is 0 whenever dedup is up to date; ``rows_removed``
    compares row counts. Ids are first reduced to one row per (day, id), so copies never meet in one task.
    """
    per_id = (
        staged.groupBy(F.to_date(day).alias("run_date"), "reading_id").agg(F.count(F.lit(1)).alias("_rows"))
    )
    known = deduped.select(F.col("reading_id").alias("_known")).distinct()
    joined = per_id.join(known, F.col("reading_id") == F.col("_known"), "left")
    kept = deduped.groupBy(F.to_date(day).alias("_day")).agg(F.count(F.lit(1)).alias("_kept"))
    daily = joined.groupBy("run_date").agg(
        F.count("reading_id").alias("raw_count"),
        F.count("_known").alias("deduped_count"),
        F.sum("_rows").alias("_rows"),
    )
    return daily.join(kept, F.col("run_date").eqNullSafe(F.col("_day")), "left").select(
        "run_date",
        "raw_count",
        "deduped_count",
        (F.col("raw_count") - F.col("deduped_count")).alias("dupes_removed"),
        (F.col("_rows") - F.coalesce("_kept", F.lit(0))).alias("rows_removed"),
    )
