"""Streaming layers (M): each drains a file stream and must give the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.staging import stage_readings
from ..plans.incremental import IncrementalLayers
from ..streaming import ingest, layers, rolling
from .base import joined, query
from .files import BAD_SQL, SALVAGED, landing, message_stream
from .joins import HOURLY_DOUBLES


def as_stream(d, df, label: str):
    """A frame written as files and read as a stream."""
    path = d.scratch(label)
    df.write.parquet(path)
    return d.spark.readStream.schema(df.schema).parquet(path)


def feed(d, df, label: str, slices: list[str], start, ts: str = "loaded_at"):
    """Append one slice of the load time after the other, in as many files as it has tasks, and let the stream that ``start``
    begins (anew, from its checkpoint) take in each slice before the next comes."""
    path = d.scratch(label)
    edges = [None, *slices, None]
    for low, high in zip(edges, edges[1:]):
        part = df
        if low:
            part = part.filter(F.col(ts) >= F.lit(low).cast("timestamp_ntz"))
        if high:
            part = part.filter(F.col(ts) < F.lit(high).cast("timestamp_ntz"))
        part.write.mode("append").parquet(path)
        start(d.spark.readStream.schema(df.schema).parquet(path)).awaitTermination()


def append_to(stream, path: str, checkpoint: str):
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint) \
        .outputMode("append").trigger(availableNow=True).start(path)


def drain(d, stream, label: str = "out"):
    """Run a stream over what is there and return what it wrote."""
    path = d.scratch(label)
    append_to(stream, path, d.scratch("checkpoint")).awaitTermination()
    return d.spark.read.schema(stream.schema).parquet(path)


@query("m1_parse_stream", f"""
    SELECT reading_id, temperature, NULL AS reason FROM stream WHERE ({BAD_SQL}) IS NULL
    UNION ALL SELECT NULL, NULL, {BAD_SQL} FROM stream WHERE ({BAD_SQL}) IS NOT NULL""", doubles="temperature")
def parse_stream(d):
    arrived = message_stream(d).withColumns({"loaded_at": F.col("timestamp"), "source_file": F.col("topic")})
    good, bad = layers.parse_stream(arrived.drop("reading_id"))
    staged = drain(d, good, "staged").select("reading_id", "temperature", F.lit(None).cast("string").alias("reason"))
    dead = drain(d, bad, "dead").select(F.lit(None).cast("string").alias("reading_id"),
                                        F.lit(None).cast("double").alias("temperature"), "reason")
    return staged.unionByName(dead)


@query("m2_dedup_stream", "SELECT reading_id, device_id, reading_ts, temperature FROM deduped", doubles="temperature")
def dedup_stream(d):
    out, checkpoint = d.scratch("out"), d.scratch("checkpoint")
    feed(d, d.staged, "staged", ["2024-01-10", "2024-01-20"],
         lambda stream: layers.write_deduped(stream, out, checkpoint))
    return d.spark.read.parquet(out).select("reading_id", "device_id", "reading_ts", "temperature")


@query("m3_validate_stream", """
    SELECT reading_id, is_temperature_valid, is_humidity_valid, is_pressure_valid, is_battery_valid, is_co2_valid,
           array_to_string(list_filter(rejection_reasons, lambda x: x <> 'ZSCORE_ANOMALY'), ',') AS rejection_reasons
    FROM reasons""")
def validate_stream(d):
    stream = as_stream(d, d.layers.deduped, "deduped")
    out = drain(d, layers.validate_stream(stream, d.thresholds))
    return out.select("reading_id", "is_temperature_valid", "is_humidity_valid", "is_pressure_valid",
                      "is_battery_valid", "is_co2_valid", joined("rejection_reasons").alias("rejection_reasons"))


@query("m4_late_stream", "SELECT reading_id, loaded_at, arrival_delay_minutes FROM late", longs="arrival_delay_minutes")
def late_stream(d):
    out = drain(d, layers.late_stream(as_stream(d, d.layers.deduped, "deduped")))
    return out.select("reading_id", "loaded_at", "arrival_delay_minutes")


@query("m5_hourly_stream", "SELECT * FROM hourly", doubles=HOURLY_DOUBLES)
def hourly_stream(d):
    store, dst, checkpoint = d.scratch("readings"), d.scratch("hourly"), d.scratch("checkpoint")
    feed(d, d.layers.enriched, "enriched", ["2024-01-10", "2024-01-20"],
         lambda stream: layers.write_hourly(stream, store, dst, checkpoint))
    return d.spark.read.parquet(dst).drop("report_day")


@query("m6_score_stream", "SELECT reading_id, temperature_zscore FROM scored", doubles="temperature_zscore")
def score_stream(d):
    dst, checkpoint = d.scratch("scored"), d.scratch("checkpoint")
    feed(d, d.layers.deduped, "deduped", ["2024-01-10", "2024-01-20"],
         lambda stream: rolling.score_stream(stream, dst, checkpoint))
    return d.spark.read.parquet(f"{dst}/scored").select("reading_id", "temperature_zscore")


@query("m7_incremental_layers", "SELECT * FROM overview",
       doubles="avg_quality_score fleet_uptime_pct fleet_avg_battery")
def incremental_layers(d):
    """Staged micro-batches through all layers; the report must be that of a full run."""
    state = IncrementalLayers(d.spark, d.scratch("layers"), d.registry, d.thresholds)
    checkpoint = d.scratch("checkpoint")
    feed(d, d.staged, "staged", ["2024-01-12", "2024-01-22"], lambda stream: stream.writeStream.option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(state.apply).start())
    return state.overview()


@query("m8_replay", f"""
    SELECT reading_id, temperature FROM staged UNION ALL SELECT reading_id, temperature FROM {SALVAGED} AS salvaged""", doubles="temperature")
def replay(d):
    """A second, fresh target gets everything from the beginning."""
    src, dst = landing(d), d.scratch("raw")
    ingest.load_new_files(d.spark, src, dst, d.scratch("checkpoint"), pattern="*.txt")
    again = d.scratch("replayed")
    ingest.replay(d.spark, src, again, d.scratch("checkpoint"), pattern="*.txt")
    return stage_readings(d.spark.read.parquet(again)).select("reading_id", "temperature")

