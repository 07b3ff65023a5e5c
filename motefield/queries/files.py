"""Sources and sinks (A): every query writes its input below the shared folder and reads it back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..fixture import payload
from ..functions.parsing import json_field
from ..operators.dedup import dedup
from ..operators.history import merge_upsert
from ..operators.staging import stage_readings
from ..sources import files, messages, tables
from ..streaming import ingest
from .base import query

PER_FILE = 500  # readings of a landing file; ids are unique, so a file holds at most 2 * PER_FILE rows
BROKEN = f"(SELECT 1 + count(DISTINCT event_id // {PER_FILE}) FROM events)"


#: The readings that the broken file still yields: it is the first file once more, cut in its third element.
SALVAGED = f"""(SELECT * FROM staged WHERE CAST(substring(reading_id, 2) AS BIGINT) // {PER_FILE} = 0
    ORDER BY CAST(substring(reading_id, 2) AS BIGINT), loaded_at, source_file LIMIT 2)"""


def _arrays(d, drift: bool = False):
    """JSON-array texts of consecutive readings, and the first text once more, cut in its third element."""
    number = F.substring("reading_id", 2, 20).cast("long")
    element = F.struct(number.alias("number"), "loaded_at", "source_file", payload(d.staged, drift).alias("json"))
    blocks = d.staged.groupBy(F.floor(number / PER_FILE).alias("block")).agg(F.array_sort(F.collect_list(element))["json"].alias("json"))
    whole = blocks.select(F.concat(F.lit("["), F.array_join("json", ","), F.lit("]")).alias("value"))
    cut = blocks.filter("block = 0").select(F.concat(
        F.lit("["), F.array_join(F.slice("json", 1, 2), ","), F.lit(","), F.expr("left(json[2], length(json[2]) - 20)")).alias("value"))
    return whole.unionByName(cut)


def landing(d, drift: bool = False) -> str:
    """A folder with one JSON array per file, one of them broken."""
    path = d.scratch("landing")
    _arrays(d, drift).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query("a1_read_reading_files", """
    SELECT reading_id, device_id, temperature, co2_level, error_profile, false AS broken FROM staged
    UNION ALL SELECT reading_id, device_id, temperature, co2_level, error_profile, false FROM """ + SALVAGED + """ AS salvaged
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, true""", doubles="temperature co2_level")
def read_reading_files(d):
    rows = files.read_reading_files(d.spark, landing(d), "*.txt")
    return rows.select("reading_id", "device_id", "temperature", "co2_level", "error_profile",
                       F.col(files.CORRUPT).isNotNull().alias("broken"))


@query("a2_read_raw_variant", """
    SELECT reading_id, device_id, temperature, false AS broken FROM staged
    UNION ALL SELECT reading_id, device_id, temperature, false FROM """ + SALVAGED + """ AS salvaged
    UNION ALL SELECT NULL, NULL, NULL, true""", doubles="temperature")
def read_raw_variant(d):
    rows = files.read_raw_variant(d.spark, landing(d), "*.txt", "2024-02-01 00:00:00")
    return rows.select(json_field("raw_data", "reading_id").alias("reading_id"),
                       json_field("raw_data", "device_id").alias("device_id"),
                       json_field("raw_data", "temperature", "double").alias("temperature"),
                       F.col(files.CORRUPT).isNotNull().alias("broken"))


@query("a3_provenance", f"SELECT {BROKEN} AS file_count, count(*) + 3 AS row_count FROM staged")
def provenance(d):
    rows = files.read_raw_variant(d.spark, landing(d), "*.txt")
    per_file = rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count("source_file").alias("file_count"), F.sum("n").alias("row_count"))


@query("a4_partitioned_layout", """
    SELECT reading_id, loaded_at, year(reading_ts) AS year, month(reading_ts) AS month, day(reading_ts) AS day,
           hour(reading_ts) AS hour FROM staged WHERE CAST(reading_ts AS DATE) = DATE '2024-01-10'""",
       longs="year month day hour")
def partitioned_layout(d):
    path = d.scratch("layout")
    files.write_partitioned(d.staged, path, "reading_ts")
    return files.read_partition(d.spark, path, dt.date(2024, 1, 10)).select(
        "reading_id", "loaded_at", "year", "month", "day", "hour")


@query("a5_load_new_files", f"""
    SELECT {BROKEN} AS first_run, 0::BIGINT AS second_run, count(*) + 2 AS row_count, count(DISTINCT device_id) AS devices,
           1::BIGINT AS dead_letters, 1::BIGINT AS partial, {BROKEN} - 1 AS succeeded, count(*) + 2 AS audited_rows
    FROM staged""", longs="row_count succeeded audited_rows")
def load_new_files(d):
    src, dst, checkpoint = landing(d), d.scratch("raw"), d.scratch("checkpoint")
    runs = [ingest.load_new_files(d.spark, src, dst, checkpoint, pattern="*.txt") for _ in range(2)]
    table = d.spark.read.parquet(dst)
    dead = d.spark.read.parquet(ingest.dead_letters_of(dst)).agg(F.count("value")).scalar()
    audit = d.spark.read.parquet(ingest.audit_of(dst))
    partial = audit.filter("load_status = 'PARTIAL' AND error_details IS NOT NULL AND rows_loaded = 2").agg(F.count(F.lit(1))).scalar()
    succeeded = audit.filter("load_status = 'SUCCESS'").agg(F.count(F.lit(1))).scalar()
    return table.agg(
        dead.alias("dead_letters"), partial.alias("partial"), succeeded.alias("succeeded"),
        audit.agg(F.sum("rows_loaded")).scalar().alias("audited_rows"),
        F.lit(runs[0]).cast("long").alias("first_run"), F.lit(runs[1]).cast("long").alias("second_run"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(json_field("raw_data", "device_id")).alias("devices"))


@query("a6_ingest_continuous", f"""
    SELECT device_id, count(*) AS n FROM (SELECT device_id FROM staged UNION ALL SELECT device_id FROM {SALVAGED} AS salvaged) GROUP BY 1""")
def ingest_continuous(d):
    src, dst = landing(d), d.scratch("raw")
    running = ingest.ingest_continuous(d.spark, src, dst, d.scratch("checkpoint"), "1 second", pattern="*.txt")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return d.spark.read.parquet(dst).groupBy(json_field("raw_data", "device_id").alias("device_id")).agg(
        F.count(F.lit(1)).alias("n"))


@query("a7_reload_files", f"""
    SELECT reading_id, temperature + CASE WHEN CAST(substring(reading_id, 2) AS BIGINT) // {PER_FILE} % 2 = 1 THEN 1 ELSE 0 END
           AS temperature FROM deduped""", doubles="temperature")
def reload_files(d):
    """The files of one folder were corrected after they had been loaded: loaded again and merged by key, they replace their rows."""
    odd = F.floor(F.substring("reading_id", 2, 20).cast("long") / PER_FILE) % 2 == 1

    def write(rows, path):
        block = F.floor(F.substring("reading_id", 2, 20).cast("long") / PER_FILE)
        rows.groupBy(block.alias("block")).agg(F.collect_list(payload(rows, False)).alias("json")) \
            .select(F.concat(F.lit("["), F.array_join("json", ","), F.lit("]")).alias("value")) \
            .write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)

    src = d.scratch("landing")
    write(d.staged.filter(~odd), f"{src}/even")
    write(d.staged.filter(odd), f"{src}/odd")
    target = d.scratch("target")
    dedup(stage_readings(files.read_raw_variant(d.spark, src, "*.txt", "2024-02-01 00:00:00")
                         .filter("raw_data IS NOT NULL"))).write.parquet(target)
    write(d.staged.filter(odd).withColumn("temperature", F.col("temperature") + 1), f"{src}/odd")
    again = dedup(stage_readings(files.reload_files(d.spark, f"{src}/odd", "*.txt", "2024-02-02 00:00:00")
                                 .filter("raw_data IS NOT NULL")))
    return merge_upsert(d.spark.read.parquet(target), again, "reading_id").select("reading_id", "temperature")


@query("a8_change_feed", """
    SELECT count(*) FILTER (WHERE loaded_at < TIMESTAMP '2024-01-20') AS first_change,
           count(*) FILTER (WHERE loaded_at >= TIMESTAMP '2024-01-20') AS second_change, 0::BIGINT AS third_change,
           true AS new_before, false AS new_after FROM staged""")
def change_feed(d):
    table, checkpoint = d.scratch("table"), d.scratch("checkpoint")
    early = F.col("loaded_at") < F.lit("2024-01-20").cast("timestamp_ntz")
    seen = []

    def take(batch, batch_id):
        seen.append(batch.count())

    def consume():
        before = len(seen)
        ingest.consume_changes(d.spark, table, checkpoint, take)
        return sum(seen[before:])

    d.raw_plain.filter(early).write.mode("append").parquet(table)
    first = consume()
    d.raw_plain.filter(~early).write.mode("append").parquet(table)
    new_before = ingest.has_new(d.spark, table, checkpoint)
    second = consume()
    third = consume()
    return d.spark.read.parquet(table).agg(
        F.lit(first).cast("long").alias("first_change"), F.lit(second).cast("long").alias("second_change"),
        F.lit(third).cast("long").alias("third_change"), F.lit(new_before).alias("new_before"),
        F.lit(ingest.has_new(d.spark, table, checkpoint)).alias("new_after"))


def message_table(d) -> str:
    """Messages as a topic delivers them, some of them bad, stored as files a stream can read."""
    path = d.scratch("topic")
    rows = d.stream.select(
        F.col("kafka_key").alias("key"), F.to_json("raw_data").alias("json"), F.col("source_topic").alias("topic"),
        F.col("source_partition").alias("partition"), F.col("source_offset").alias("offset"),
        F.col("loaded_at").alias("timestamp"), json_field("raw_data", "reading_id").alias("reading_id"))
    e = F.substring("reading_id", 2, 20).cast("long")
    value = F.when(e % 29 == 0, F.expr("left(json, length(json) - 5)")).when(e % 67 == 0, F.lit(None)) \
        .when(e % 71 == 0, F.lit("[1]")).otherwise(F.col("json"))
    rows.withColumn("value", value).drop("json").write.parquet(path)
    return path


def message_stream(d):
    path = message_table(d)
    return d.spark.readStream.schema(d.spark.read.parquet(path).schema).parquet(path)


BAD_SQL = """CASE WHEN e % 29 = 0 THEN 'malformed JSON' WHEN e % 67 = 0 THEN 'empty message'
             WHEN e % 71 = 0 THEN 'not an object' END"""


@query("a10_write_raw_stream", f"""
    SELECT source_partition, count(*) FILTER (WHERE ({BAD_SQL}) IS NULL) AS good, count({BAD_SQL}) AS bad,
           max(source_offset) FILTER (WHERE ({BAD_SQL}) IS NULL) AS max_offset FROM stream GROUP BY 1""")
def write_raw_stream(d):
    dst, dead = d.scratch("stream"), d.scratch("dead")
    ingest.write_raw_stream(message_stream(d), dst, dead, d.scratch("checkpoint"), seconds=None).awaitTermination()
    good = d.spark.read.parquet(dst).groupBy("source_partition").agg(
        F.count(F.lit(1)).alias("good"), F.max("source_offset").alias("max_offset"))
    bad = d.spark.read.parquet(dead).groupBy(F.col("partition").alias("source_partition")).agg(
        F.count(F.lit(1)).alias("bad"))
    return good.join(bad, "source_partition").select("source_partition", "good", "bad", "max_offset")


@query("a11_keyed_messages", "SELECT device_id AS key, count(*) AS n, sum(pressure) AS pressure FROM deduped GROUP BY 1",
       doubles="pressure")
def keyed_messages(d):
    rows = messages.keyed_messages(d.layers.deduped, "device_id")
    return rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("value", "$.pressure").cast("double")).alias("pressure"))


@query("a12_split_deadletter", f"""
    SELECT coalesce({BAD_SQL}, 'good') AS outcome, count(*) AS n FROM stream GROUP BY 1""")
def split_deadletter(d):
    good, bad = messages.split_deadletter(d.spark.read.parquet(message_table(d)))
    both = good.select(F.lit("good").alias("outcome")).unionByName(bad.select(F.col("reason").alias("outcome")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("a13_route_alerts", """
    SELECT device_id AS key, severity, count(*) AS n FROM anomalies WHERE severity <> 'info' GROUP BY ALL""")
def route_alerts(d):
    rows = messages.route_alerts(d.layers.anomalies)
    return rows.groupBy("key", F.get_json_object("value", "$.severity").alias("severity")).agg(
        F.count(F.lit(1)).alias("n"))


@query("a14_load_seeds", """
    SELECT r.device_id, r.install_date, c.cluster_city, count(*) AS readings,
           count(*) FILTER (WHERE s.temperature > (SELECT warning_high FROM thresholds WHERE sensor_type = 'temperature'))
           AS hot FROM staged s JOIN registry r USING (device_id) JOIN cluster_seed c USING (cluster_id) GROUP BY ALL""")
def load_seeds(d):
    """Reference tables through CSV files, joined with the readings."""
    path = d.scratch("seeds")
    for name, table in (("device_registry", d.registry), ("sensor_thresholds", d.thresholds),
                        ("cluster_metadata", d.clusters)):
        table.write.option("header", True).csv(f"{path}/{name}.csv")
    seeds = files.load_seeds(d.spark, path)
    limit = seeds["sensor_thresholds"].filter("sensor_type = 'temperature'").select("warning_high").scalar()
    return (
        d.staged.join(seeds["device_registry"], "device_id").join(seeds["cluster_metadata"], "cluster_id")
        .groupBy("device_id", "install_date", "cluster_city")
        .agg(F.count(F.lit(1)).alias("readings"), F.count(F.when(F.col("temperature") > limit, 1)).alias("hot"))
    )


@query("a15_versions", """
    SELECT 'first' AS asked, 2::BIGINT AS versions, count(*) AS n FROM staged WHERE loaded_at < TIMESTAMP '2024-01-20'
    UNION ALL SELECT 'newest', 2, count(*) FROM staged""")
def versions(d):
    path = d.scratch("versions")
    early = d.staged.filter(F.col("loaded_at") < F.lit("2024-01-20").cast("timestamp_ntz"))
    tables.write_version(early, path, dt.datetime(2024, 1, 20))
    tables.write_version(d.staged, path, dt.datetime(2024, 2, 1))
    known = tables.list_versions(d.spark, path).agg(F.count(F.lit(1))).scalar()

    def asked(name, ts):
        return tables.read_as_of(d.spark, path, ts).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("asked"), known.alias("versions"), "n")

    return asked("first", dt.datetime(2024, 1, 25)).unionByName(asked("newest", None))


@query("a15_appended_versions", """
    SELECT 'first' AS asked, 1::BIGINT AS parts, count(*) AS n FROM staged WHERE loaded_at < TIMESTAMP '2024-01-10'
    UNION ALL SELECT 'newest', 3, count(*) FROM staged""")
def appended_versions(d):
    """Three loads, each a version that carries the parts of the one before over."""
    path, loaded = d.scratch("versions"), F.col("loaded_at")
    low, high = (F.lit(day).cast("timestamp_ntz") for day in ("2024-01-10", "2024-01-20"))
    for day, part in ((10, loaded < low), (20, (loaded >= low) & (loaded < high)), (31, loaded >= high)):
        tables.append_version(d.staged.filter(part), path, dt.datetime(2024, 1, day))

    def asked(name, ts):
        parts = len(tables.version_at(d.spark, path, ts)["parts"])
        return tables.read_as_of(d.spark, path, ts).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("asked"), F.lit(parts).cast("long").alias("parts"), "n")

    return asked("first", dt.datetime(2024, 1, 15)).unionByName(asked("newest", None))


@query("a16_audit_load", f"""
    SELECT CASE WHEN n = 1 THEN 'PARTIAL' ELSE 'SUCCESS' END AS load_status, CASE WHEN n = 1 THEN 1 ELSE {BROKEN} - 1 END
           AS file_count, CASE WHEN n = 1 THEN 2 ELSE (SELECT count(*) FROM staged) END AS rows_loaded,
           CASE WHEN n = 1 THEN 1 ELSE 0 END AS errors_seen FROM range(2) AS t(n)""",
       longs="file_count rows_loaded errors_seen")
def audit_load(d):
    rows = files.read_reading_files(d.spark, landing(d), "*.txt")
    audit = files.audit_load(rows, "2024-02-01 00:00:00")
    return audit.groupBy("load_status").agg(F.count(F.lit(1)).alias("file_count"),
                                            F.sum("rows_loaded").alias("rows_loaded"),
                                            F.sum("errors_seen").alias("errors_seen"))


@query("a17_validate_load", """
    SELECT count(*) AS total_rows, count(DISTINCT source_file) AS total_files, max(loaded_at) AS latest_load,
           count(DISTINCT source_file) FILTER (WHERE loaded_at >= TIMESTAMP '2024-01-20') AS new_files,
           count(*) FILTER (WHERE loaded_at >= TIMESTAMP '2024-01-20') AS new_rows, true AS has_new_data FROM staged""")
def validate_load(d):
    new = d.staged.filter(F.col("loaded_at") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    return files.validate_load(d.staged, new.agg(F.count(F.lit(1))).scalar(),
                               new.select("source_file").distinct().agg(F.count(F.lit(1))).scalar())


@query("a18_typed_parquet", """
    SELECT CAST(reading_ts AS DATE) AS reading_day, cluster_id, count(*) AS n, sum(temperature) AS total FROM enriched
    GROUP BY ALL""", doubles="total")
def typed_parquet(d):
    path = d.scratch("typed")
    files.to_typed_parquet(d.layers.enriched, path)
    return d.spark.read.parquet(path).groupBy("reading_day", "cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("temperature").alias("total"))
