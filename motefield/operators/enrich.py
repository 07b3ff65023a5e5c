"""Joins of readings with device data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timing import day_name, is_business_hours, is_weekend
from .ordered import ROWS_PER_SLICE, Slices
from .validation import split_valid


def enrich(validated: DataFrame, registry: DataFrame) -> DataFrame:
    """Valid readings with device attributes and calendar columns.

    No hint: Catalyst broadcasts a registry below its size threshold, and for a larger one AQE splits
    the partitions of devices with very many readings.
    """
    valid, _ = split_valid(validated)
    devices = registry.select("device_id", "device_type", "cluster_id", "device_name")
    return valid.join(devices, "device_id", "left").select(
        "reading_id", "device_id", "reading_ts", "temperature", "humidity", "pressure", "battery_pct", "co2_level",
        "latitude", "longitude", "firmware_version", "error_profile", "temperature_zscore", "loaded_at",
        "source_file", "device_type", "cluster_id", "device_name",
        F.hour("reading_ts").alias("hour_of_day"),
        day_name("reading_ts").alias("day_of_week"),
        is_weekend("reading_ts").alias("is_weekend"),
        is_business_hours("reading_ts").alias("is_business_hours"),
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key is set but unknown to the parent."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


def without(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``others``; NULL is a key like any other."""
    keys = others.select(F.col(key).alias("_other"))
    return df.join(keys, F.col(key).eqNullSafe(F.col("_other")), "left_anti")


def insert_new(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target does not have yet.

    The target is read for its key column only and reduced to keys of this batch first: with a small batch
    that is a map-only pass over the target (broadcast semi join), so a big target is never shuffled.
    """
    batch_keys = source.select(F.col(key).alias("_batch")).distinct()
    known = target.select(key).join(batch_keys, F.col(key).eqNullSafe(F.col("_batch")), "left_semi").distinct()
    return without(source, known, key)


def join_as_of_version(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    ts: str,
    attributes: Sequence[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Facts with the attributes of the version valid at their time.

    Versions are put among the facts of their key, in the order of time, and the last one is carried forward: a fact sees one
    version, however many its key has, and nothing is joined on the key. Of versions that start together the one that lasts longest counts. Keys
    with very many rows are cut into slices, and what a slice ends with is handed on to those behind it. Facts without a
    key or a time have no version. ``profile`` steers the cuts, see :class:`ordered.Slices`.
    """
    none = F.lit(None)
    state = F.struct("valid_from", "valid_to", *attributes)
    shape = versions.select(state.alias("_state")).schema["_state"].dataType
    order = ["_at", "_kind", "_to", "_tie"]

    def placed(df: DataFrame) -> list[Column]:
        return [F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(1).alias("_kind"), none.cast("timestamp_ntz").alias("_to"),
                F.xxhash64(*[c for c in facts.columns if c in df.columns]).alias("_tie")]

    starts = versions.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull())
    row = facts.select(F.struct(*facts.columns).alias("_fact")).schema["_fact"].dataType
    rows = facts.select(*placed(facts), none.cast(shape).alias("_state"), F.struct(*facts.columns).alias("_fact")).unionByName(starts.select(
        F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.lit(0).alias("_kind"), F.col("valid_to").alias("_to"),
        F.lit(0).cast("long").alias("_tie"), state.alias("_state"), none.cast(row).alias("_fact")))
    steering = rows if profile is None else profile.select(*placed(profile))
    slices = Slices(steering, ["_key"], order, rows_per_slice)

    def carried(*by: str) -> Column:
        sorted_rows = Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        return F.last("_state", ignorenulls=True).over(sorted_rows.rowsBetween(Window.unboundedPreceding, 0))

    if slices.bounds.isEmpty():
        seen = rows.withColumn("_seen", carried("_key"))
    else:
        cut = slices.sliced(rows)
        ends = cut.filter(F.col("_kind") == 0).groupBy("_key", "_slice").agg(F.max_by("_state", F.struct("_at", F.col("_to").isNull(), "_to")).alias("_end"))
        grid = slices.bounds.select(F.col("_h__key").alias("_key"), F.explode(F.sequence(F.lit(0), F.size("_bounds"))).alias("_slice"))
        before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        handed = grid.join(ends, ["_key", "_slice"], "left").select(
            F.col("_key").alias("_k"), F.col("_slice").alias("_s"), F.last("_end", ignorenulls=True).over(before).alias("_handed"))
        own = cut.withColumn("_own", carried("_key", "_slice", "_slices"))
        seen = own.join(handed, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_slice") == F.col("_s")), "left").withColumn(
            "_seen", F.coalesce("_own", "_handed"))
    valid = F.when((F.col("_at") < F.col("_seen.valid_to")) | (F.col("_at").isNotNull() & F.col("_seen.valid_to").isNull()), F.col("_seen"))
    return seen.filter(F.col("_kind") == 1).withColumn("_seen", valid).select(
        *[F.col("_fact")[c].alias(c) for c in facts.columns], *[F.col("_seen")[a].alias(f"{a}_at_reading") for a in attributes],
        F.col("_seen.valid_from").alias("valid_from"), F.col("_seen.valid_to").alias("valid_to"))
