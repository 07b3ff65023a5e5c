"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and three times for the median, into a sink that takes every row and keeps none.
Ingest figures count the staged readings, taken in once with ``availableNow``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from motefield.queries import REGISTRY  # noqa: E402
from motefield.queries.base import Data  # noqa: E402
from motefield.queries.files import landing, message_stream  # noqa: E402
from motefield.queries.streams import as_stream  # noqa: E402
from motefield.session import build_session  # noqa: E402
from motefield.streaming import ingest, layers  # noqa: E402

HEADLINE = ["d1_enrich", "f1_dedup", "f4_rolling_zscore", "f4_rolling_zscore_sliced", "f8_rank_in", "e1_hourly_readings",
            "e2_device_health", "e4_data_quality", "e6_fleet_overview", "h4_anomalies", "j1_merge_upsert", "j12_obt", "d12_as_of_version"]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


BATCHES = 10


def last_batch(spark, df, columns: str, run) -> float:
    """Rows per second of the last of ``BATCHES`` batches in load order, when nine lie before it: what grows with history shows here."""
    spent = rows = 0
    for number, low in enumerate(range(0, 100, 100 // BATCHES)):
        part = df.filter(F.pmod(F.xxhash64(F.date_trunc("hour", columns)), F.lit(100)).between(low, low + 100 // BATCHES - 1))
        spent = seconds(lambda: run(part, number))  # noqa: B023
        rows = part.count()
    return rows / spent


def ingest_rates(spark, sf_dir: str) -> dict[str, float]:
    """Rows per second of the file load and of the streaming layers; ``_batch10`` is the last of ten batches alone."""
    d = Data(spark, sf_dir)
    rows = d.staged.count()
    src = landing(d)
    rates = {"a5_file_ingest": rows / seconds(
        lambda: ingest.load_new_files(spark, src, d.scratch("raw"), d.scratch("checkpoint"), pattern="*.txt"))}

    def run(stream) -> float:
        return rows / seconds(lambda: stream.writeStream.format("noop").option(
            "checkpointLocation", d.scratch("checkpoint")).trigger(availableNow=True).start().awaitTermination())

    messages = message_stream(d).withColumnsRenamed({"timestamp": "loaded_at", "topic": "source_file"})
    rates["m1_parse"] = run(layers.parse_stream(messages)[0])
    staged = as_stream(d, d.staged, "staged")
    rates["m2_dedup"] = rows / seconds(
        lambda: layers.write_deduped(staged, d.scratch("deduped"), d.scratch("checkpoint")).awaitTermination())
    rates["m3_validate"] = run(layers.validate_stream(staged, d.thresholds))
    rates["m4_late"] = run(layers.late_stream(staged))
    enriched = as_stream(d, d.layers.enriched, "enriched")
    rates["m5_hourly"] = rows / seconds(lambda: layers.write_hourly(
        enriched, d.scratch("readings"), d.scratch("hourly"), d.scratch("checkpoint")).awaitTermination())

    def fed(label, start):
        path = d.scratch(label)

        def feed(part, _):
            part.write.mode("append").parquet(path)
            start(spark.readStream.schema(part.schema).parquet(path)).awaitTermination()

        return feed

    deduped, seen, store, hourly, at = (d.scratch(n) for n in ("deduped10", "seen10", "store10", "hourly10", "hours10"))
    rates["m2_dedup_batch10"] = last_batch(spark, d.staged, "loaded_at", fed("staged10", lambda s: layers.write_deduped(s, deduped, seen)))
    rates["m5_hourly_batch10"] = last_batch(spark, d.layers.enriched, "reading_ts", fed("enriched10", lambda s: layers.write_hourly(s, store, hourly, at)))
    return {name: round(rate) for name, rate in rates.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "motefield-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        runs = [seconds(lambda: drain(REGISTRY[name].frame(spark, sf_dir))) for _ in range(4)]
        timings[name] = round(statistics.median(runs[1:]), 3)
    rates = ingest_rates(spark, sf_dir)
    readings = Data(spark, sf_dir).staged.count()
    print(json.dumps({
        "metric": "headline_total_median", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "rows_per_sec": rates, "input_rows": readings, "cores": int(cpus),
        "shuffle_partitions": int(cpus), "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
