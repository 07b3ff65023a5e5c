"""Sensor readings derived from the ``events`` table, computed by Spark from every row.

The same expressions exist as SQL text in ``queries/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.timing import shift, trunc
from .schemas import CLUSTER_METADATA, SENSOR_THRESHOLDS, STAGED, columns

# fixed values: validity, warning and critical limits per sensor
THRESHOLDS = """
    ('temperature', -20D, 60D, -10D, 50D, -20D, 60D),
    ('humidity', 10D, 95D, 15D, 90D, 10D, 95D),
    ('pressure', 950D, 1050D, 960D, 1040D, 950D, 1050D),
    ('battery', 0D, 100D, 15D, 100D, 5D, 100D),
    ('co2', 300D, 2000D, 400D, 1500D, 300D, 2000D)
"""

# fixed values: the five sites (the managers are placeholders)
CLUSTERS = """
    ('FACTORY_A', 'New York', 'NY', 'America/New_York', 'indoor_stable', 'Manager 1', 20),
    ('FACTORY_B', 'Los Angeles', 'CA', 'America/Los_Angeles', 'indoor_warm', 'Manager 2', 20),
    ('WAREHOUSE_A', 'Chicago', 'IL', 'America/Chicago', 'semi_outdoor', 'Manager 3', 20),
    ('WAREHOUSE_B', 'Houston', 'TX', 'America/Chicago', 'semi_outdoor_humid', 'Manager 4', 20),
    ('OUTDOOR', 'Seattle', 'WA', 'America/Los_Angeles', 'outdoor', 'Manager 5', 20)
"""


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {THRESHOLDS} AS t({', '.join(columns(SENSOR_THRESHOLDS))})")


def clusters(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {CLUSTERS} AS t({', '.join(columns(CLUSTER_METADATA))})")


def device_name_of(number: Column) -> Column:
    return F.concat(F.lit("DEV_"), F.lpad(number.cast("string"), 3, "0"))


def registry(spark: SparkSession, devices: int = 50) -> DataFrame:
    n = F.col("id")
    site = F.element_at(
        F.array(*[F.lit(c) for c in ("FACTORY_A", "FACTORY_B", "WAREHOUSE_A", "WAREHOUSE_B", "OUTDOOR")]),
        (F.floor((n - 1) / 10) + 1).cast("int"),
    )
    kind = F.when(n % 3 == 0, "Type_A").when(n % 3 == 1, "Type_B").otherwise("Type_C")
    return spark.range(1, devices + 1).select(
        device_name_of(n).alias("device_id"),
        F.concat(F.lit("Sensor "), F.lower(site), F.lit("_"), F.lpad(n.cast("string"), 3, "0")).alias("device_name"),
        kind.alias("device_type"),
        site.alias("cluster_id"),
        F.lit(40.0).alias("base_latitude"),
        F.lit(-74.0).alias("base_longitude"),
        F.when(n <= 30, F.lit("2025-01-15")).otherwise(F.lit("2025-06-01")).cast("date").alias("install_date"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _file_of(loaded: Column) -> Column:
    return F.concat(F.lit("batch_"), F.date_format(loaded, "yyyy-MM-dd_HH"), F.lit(".json"))


def staged(source: DataFrame, copies: bool = True) -> DataFrame:
    """The 16 staging columns; with ``copies`` every twentieth reading arrives a second time one hour later."""
    e, k, dev = F.col("event_id"), F.col("k"), F.col("dev")
    # own projection: the JSON text is parsed once, not once per use
    source = source.withColumns({
        "k": F.get_json_object("props", "$.k").cast("int"),
        "dev": F.col("user_id") % 50 + 1,
        "first_hour": shift(trunc("hour", "ts"), "hour", 1),
    })

    def every(n: int) -> Column:
        return e % n == 0

    null = F.lit(None)
    loaded = F.col("first_hour")
    twice = F.explode(F.when(every(20), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = source.select(
        F.concat(F.lit("R"), e.cast("string")).alias("reading_id"),
        device_name_of(dev).alias("device_id"),
        F.col("ts").alias("reading_ts"),
        F.when(every(31), null).when(every(37), F.lit(75.0) + k).otherwise(F.col("value") / 10).alias("temperature"),
        F.when(every(41), F.lit(5.0)).otherwise(F.lit(40.0) + k / 4.0).alias("humidity"),
        F.when(every(43), F.lit(1100.0)).otherwise(F.lit(1000.0) + e % 40).alias("pressure"),
        F.when(every(47), null).otherwise(F.lit(100.0) - e % 97).alias("battery_pct"),
        F.when(every(53), F.lit(2500.0))
        .when(F.col("event_type").isin("click", "view"), F.lit(400.0) + k * 10).alias("co2_level"),
        (F.lit(40.0) + (k - 50) / 1000.0).alias("latitude"),
        (F.lit(-74.0) + (e % 100 - 50) / 1000.0).alias("longitude"),
        F.when((F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")) | (dev % 3 == 0), "1.0.0")
        .otherwise("2.0.0").alias("firmware_version"),
        F.element_at(F.array(*[F.lit(p) for p in ("none", "normal", "high", "chaos")]), (e % 4 + 1).cast("int"))
        .alias("error_profile"),
        null.cast("double").alias("signal_strength"),
        null.cast("string").alias("temp_celsius_renamed"),
        F.when(every(23), shift(loaded, "hour", 3)).otherwise(loaded).alias("_loaded"),
        (twice if copies else F.lit(0)).alias("_copy"),
    )
    arrival = F.when(F.col("_copy") == 1, shift(F.col("_loaded"), "hour", 1)).otherwise(F.col("_loaded"))
    rows = rows.withColumn("loaded_at", arrival).withColumn("source_file", _file_of(F.col("loaded_at")))
    return rows.select(*columns(STAGED))


def payload(reading: DataFrame, drift: bool = True) -> Column:
    """A staged row as producer JSON: ISO times with an offset, NULL co2 left out, optional drift fields."""
    number = F.substring("reading_id", 2, 20).cast("long")
    renamed = (number % 61 == 0) if drift else F.lit(False)
    iso = F.date_format("reading_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = F.struct(
        "reading_id", "device_id",
        F.concat(iso, F.lit("+00:00")).alias("reading_ts"),
        F.when(~renamed, F.col("temperature")).alias("temperature"),
        "humidity", "pressure", "battery_pct", "co2_level", "latitude", "longitude",
        "firmware_version", "error_profile",
        F.when((number % 59 == 0) if drift else F.lit(False), F.lit(-50.0)).alias("signal_strength"),
        F.when(renamed, F.col("temperature")).alias("temp_celsius"),
    )
    return F.to_json(fields)


def raw_variant(readings: DataFrame, drift: bool = True) -> DataFrame:
    return readings.select(
        F.parse_json(payload(readings, drift)).alias("raw_data"), "loaded_at", "source_file"
    )


def stream_raw(source: DataFrame) -> DataFrame:
    """The raw table of the stream path: readings with topic, partition, offset and key.

    The offset of a message is its rank inside its partition. It is computed as the rows in earlier id blocks
    plus the position inside the own block, so no partition is sorted in one task.
    """
    number = F.substring("reading_id", 2, 20).cast("long")
    device = F.substring("device_id", 5, 10).cast("int")
    first = staged(source, copies=False).withColumns({
        "_e": number,
        "source_partition": (device % 5).cast("long"),
        "_block": F.floor(number / 100_000),
    })
    counts = first.groupBy("source_partition", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("source_partition").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("source_partition", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("source_partition", "_block").orderBy("_e"))
    rows = first.withColumn("_place", place).join(starts, ["source_partition", "_block"])
    return rows.select(
        F.parse_json(payload(rows, drift=False)).alias("raw_data"),
        F.timestamp_add("SECOND", (F.col("_e") % 10).cast("int"), F.col("reading_ts")).cast("timestamp_ntz")
        .alias("loaded_at"),
        F.lit("readings").alias("source_topic"),
        "source_partition",
        (F.col("_start") + F.col("_place") - 1).alias("source_offset"),
        F.col("device_id").alias("kafka_key"),
    )


def usage_log(source: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    compute, cloud = F.col("value") / 1000, k / 100_000.0
    return source.select(
        F.col("event_type").alias("warehouse_name"),
        F.col("ts").alias("start_time"),
        compute.alias("credits_used_compute"),
        cloud.alias("credits_used_cloud_services"),
        (compute + cloud).alias("credits_used"),
    )


def job_log(source: DataFrame) -> DataFrame:
    e, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("int")
    texts = F.array(*[F.lit(t) for t in ("copy into t", "call task", "select streamlit", "select 1")])
    return source.select(
        F.concat(F.lit("R"), e.cast("string")).alias("query_id"),
        F.element_at(texts, (e % 4 + 1).cast("int")).alias("query_text"),
        F.when(e % 5 == 0, "dbt").alias("query_tag"),
        F.when(e % 7 == 0, "STREAMLIT").otherwise("U").alias("user_name"),
        F.col("event_type").alias("warehouse_name"),
        F.lit("SUCCESS").alias("execution_status"),
        (F.col("value") * 1000).alias("total_elapsed_time"),
        (k / 100_000.0).alias("credits_used_cloud_services"),
        F.col("ts").alias("start_time"),
    )
