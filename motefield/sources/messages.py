"""Message topics: source, keyed publish, dead letters, alerts.

The Kafka connector is a separate package; without it these calls fail when the query starts. Everything
after the source works on plain ``key, value, topic, partition, offset, timestamp`` frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

READINGS = "iot.sensor.readings"  # fixed values: topic names
ALERTS = "iot.sensor.alerts"
DEAD_LETTERS = "iot.sensor.deadletter"


def kafka_options(servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str = READINGS, starting: str = "latest",
               max_offsets: int | None = None) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, max_offsets)).load()


def keyed_messages(df: DataFrame, key: str) -> DataFrame:
    """(key, value) with the row as JSON; one key always goes to one partition, which keeps its order."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish_kafka(df: DataFrame, servers: str, topic: str, key: str = "device_id") -> None:
    keyed_messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).save()


def dead_letter_reason(value: Column) -> Column:
    parsed = F.try_parse_json(value)
    kind = F.schema_of_variant(parsed)
    return (
        F.when(value.isNull(), "empty message")
        .when(parsed.isNull(), "malformed JSON")
        .when(~kind.startswith("OBJECT"), "not an object")
    )


def split_deadletter(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Messages that hold a JSON object, and the others with the reason."""
    text = F.col(value).cast("string")
    judged = messages.withColumn("_reason", dead_letter_reason(text))
    good = judged.filter(F.col("_reason").isNull()).withColumn("raw_data", F.try_parse_json(text)).drop("_reason")
    bad = judged.filter(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, bad


def stream_rows(good: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Parsed messages in the shape of the raw stream table."""
    when = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else loaded_at
    return good.select(
        "raw_data",
        when.alias("loaded_at"),
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("long").alias("source_partition"),
        F.col("offset").cast("long").alias("source_offset"),
        F.col("key").cast("string").alias("kafka_key"),
    )


def route_alerts(anomalies: DataFrame) -> DataFrame:
    """Critical and warning anomalies as keyed messages."""
    serious = anomalies.filter(F.col("severity").isin("critical", "warning"))
    return keyed_messages(serious, "device_id")
