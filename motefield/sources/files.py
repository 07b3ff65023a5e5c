"""Landing files, reference tables and partitioned layouts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timing import as_ts
from ..schemas import CLUSTER_METADATA, DEVICE_REGISTRY, READING_JSON, SENSOR_THRESHOLDS

CORRUPT = "_corrupt_record"


#: The tokens of a JSON text: a string as a whole (its end may be missing), a bracket or comma, or whatever stands between them.
TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"?|[\[\]{},]|[^"\[\]{},]++'


def salvage(text: Column) -> Column:
    """The pieces of a damaged or cut-off JSON array in order, as ``text`` and ``json``: elements, and what is left behind the last whole one.

    Brackets are counted outside of strings. An element is whole if a comma or the closing bracket follows it, or its own end does. ``json`` is
    the text of a piece that is whole and parses. A text that is no array, or has no such element, is one piece without.
    """
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))

    def step(state: Column, token: Column) -> Column:
        depth, current, whole = state["depth"], state["current"], state["whole"]
        after = depth + F.when(token.isin("[", "{"), 1).when(token.isin("]", "}"), -1).otherwise(0)
        opens = (depth == 0) & (token == "[")
        ends = ((depth == 1) & (token == ",")) | ((after == 0) & (token == "]"))
        return F.struct(
            after.alias("depth"), F.when(opens | ends, "").otherwise(F.concat(current, token)).alias("current"),
            F.when(ends, F.concat(whole, F.array(F.regexp_replace(current, r"^\s+|\s+$", "")))).otherwise(whole).alias("whole"))

    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("current"), F.array().cast("array<string>").alias("whole"))
    scanned = F.aggregate(tokens, start, step)
    last = F.regexp_replace(scanned["current"], r"^\s+|\s+$", "")

    def closed(p: Column) -> Column:
        """The parser reads the first value and lets pass what follows; a piece has to end with its own bracket."""
        return ((p.startswith("{") & p.endswith("}")) | (p.startswith("[") & p.endswith("]"))) & F.try_parse_json(p).isNotNull()

    plain = lambda p: ~p.rlike(r"^[{\[]") & F.try_parse_json(p).isNotNull()
    elements = F.transform(scanned["whole"], lambda p: F.struct(p.alias("text"), F.when(closed(p) | plain(p), p).alias("json")))
    # a cut number may look like one, a cut object or array cannot
    rest = F.struct(last.alias("text"), F.when((scanned["depth"] == 1) & closed(last), last).alias("json"))
    pieces = F.filter(F.concat(elements, F.array(rest)), lambda p: p["text"] != "")
    readable = F.ltrim(text).startswith("[") & F.exists(pieces, lambda p: p["json"].isNotNull())
    return F.when(readable, pieces).otherwise(F.array(F.struct(text.alias("text"), F.lit(None).cast("string").alias("json"))))


def read_reading_files(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """JSON-array files as typed rows, one per array element. Of a broken file the whole elements are rows, too; each other piece
    becomes a ``_corrupt_record`` row.

    NULL fields and duplicate rows are kept, and ``source_file`` says where a row came from.
    """
    rows = (
        spark.read.schema(f"{READING_JSON}, {CORRUPT} string")
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    fields = [c for c in rows.columns if c not in (CORRUPT, "source_file")]
    typed = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c in fields)

    def piece(p: Column) -> Column:
        parsed = F.from_json(p["json"], typed)
        return F.struct(*[parsed[c].alias(c) for c in fields], F.when(p["json"].isNull(), p["text"]).alias(CORRUPT))

    whole = F.array(F.struct(*[F.col(c) for c in fields], F.col(CORRUPT)))
    parts = F.when(F.col(CORRUPT).isNull(), whole).otherwise(F.transform(salvage(F.col(CORRUPT)), piece))
    return rows.select(F.inline(parts), "source_file").select(*rows.columns)


def array_elements(text: Column) -> Column:
    """Elements of a JSON text as ``raw_data`` and ``broken``: those of an outer array, or the value itself; of a broken text its pieces."""
    value = F.try_parse_json(text)
    good = F.transform(F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array(value)), lambda v: F.struct(v.alias("raw_data"), F.lit(None).cast("string").alias("broken")))
    pieces = F.transform(salvage(text), lambda p: F.struct(F.try_parse_json(p["json"]).alias("raw_data"), F.when(p["json"].isNull(), p["text"]).alias("broken")))
    return F.when(value.isNotNull(), good).otherwise(pieces)


def explode_payload(texts: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per array element with the payload as VARIANT; a piece of a broken text that is no JSON gives one row with ``_corrupt_record``."""
    return texts.select(*keep, F.inline(array_elements(F.col(text)))).select("raw_data", *keep, F.col("broken").alias(CORRUPT))


def _whole_files(reader, pattern: str):
    return reader.format("text").option("wholetext", True).option("pathGlobFilter", pattern) \
        .option("recursiveFileLookup", True)


def _as_raw(files: DataFrame, loaded_at: Column | dt.datetime | None) -> DataFrame:
    when = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else as_ts(loaded_at)
    named = files.select("value", F.col("_metadata.file_path").alias("source_file"))
    return explode_payload(named, "value", "source_file").select(
        "raw_data", when.alias("loaded_at"), "source_file", CORRUPT
    )


def read_raw_variant(spark: SparkSession, path: str, pattern: str = "*.json",
                     loaded_at: Column | dt.datetime | None = None) -> DataFrame:
    """JSON-array files with the whole payload kept as VARIANT. Reads the given files whether loaded before or not."""
    return _as_raw(_whole_files(spark.read, pattern).load(path), loaded_at)


def reload_files(spark: SparkSession, path: str, glob: str, loaded_at: Column | dt.datetime | None = None) -> DataFrame:
    """Selected files again, bypassing the load history; merge the result by key afterwards."""
    return read_raw_variant(spark, path, glob, loaded_at)


def stream_raw_variant(spark: SparkSession, path: str, pattern: str = "*.json",
                       loaded_at: Column | dt.datetime | None = None, max_files: int | None = None) -> DataFrame:
    reader = _whole_files(spark.readStream, pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _as_raw(reader.load(path), loaded_at)


PARTS = ("year", "month", "day", "hour")


def write_partitioned(df: DataFrame, path: str, ts_col: str, mode: str = "append", fmt: str = "parquet") -> None:
    """``year=/month=/day=/hour=`` folders. Rebalancing lets AQE cut a busy hour into several files and join small ones."""
    ts = F.col(ts_col)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    parts = {"year": F.year(ts).cast("string"), "month": two(F.month(ts)), "day": two(F.dayofmonth(ts)),
             "hour": two(F.hour(ts))}
    df.withColumns(parts).hint("rebalance", *PARTS).write.mode(mode).partitionBy(*PARTS).format(fmt).save(path)


def read_partition(spark: SparkSession, path: str, day: dt.date, hour: int | None = None,
                   fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """One day, or one hour of it; only the matching folders are listed and read."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    wanted = (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    if hour is not None:
        wanted = wanted & (F.col("hour") == hour)
    return df.filter(wanted)


SEEDS = {
    "device_registry": DEVICE_REGISTRY,
    "sensor_thresholds": SENSOR_THRESHOLDS,
    "cluster_metadata": CLUSTER_METADATA,
}


def load_seeds(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The CSV reference tables of a directory, with fixed schemas."""
    return {
        name: spark.read.schema(ddl).option("header", True).csv(f"{directory.rstrip('/')}/{name}.csv")
        for name, ddl in SEEDS.items()
    }


def audit_load(parsed: DataFrame, as_of: Column | dt.datetime) -> DataFrame:
    """Per file: rows parsed, rows loaded, errors, what is wrong and a status. ``parsed`` carries ``_corrupt_record``.

    ``as_of`` is a time or an aggregate of the rows of a file.
    """
    # the JSON reader wants a data column next to the corrupt one
    witness = F.coalesce(F.col("reading_id"), F.lit("")) if "reading_id" in parsed.columns else F.lit("")
    broken = F.col(CORRUPT).isNotNull()
    counted = parsed.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows_parsed"),
        F.count(F.when(broken, witness)).alias("errors_seen"),
        F.max(F.when(broken, F.length(CORRUPT))).alias("_length"),
        as_ts(as_of).alias("_now"),
    )
    loaded = F.col("rows_parsed") - F.col("errors_seen")
    status = F.when(F.col("errors_seen") == 0, "SUCCESS").when(loaded == 0, "FAILED").otherwise("PARTIAL")
    details = F.when(F.col("errors_seen") > 0, F.format_string("%d of %d values do not parse as JSON, the longest of %d characters",
                                                               "errors_seen", "rows_parsed", "_length"))
    load_id = F.md5(F.concat_ws("-", "source_file", F.date_format("_now", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    return counted.select(
        load_id.alias("load_id"), "source_file", loaded.alias("rows_loaded"), "rows_parsed", "errors_seen",
        details.alias("error_details"), status.alias("load_status"), F.col("_now").alias("loaded_at"),
    )


def validate_load(raw: DataFrame, new_rows: Column | int, new_files: Column | int = 0) -> DataFrame:
    """Totals after a load and whether it brought anything."""
    per_file = raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("_n"), F.max("loaded_at").alias("_last"))
    new = new_rows if isinstance(new_rows, Column) else F.lit(new_rows).cast("long")
    files = new_files if isinstance(new_files, Column) else F.lit(new_files).cast("long")
    return per_file.agg(
        F.sum("_n").alias("total_rows"), F.count("source_file").alias("total_files"),
        F.max("_last").alias("latest_load"),
    ).select("total_rows", "total_files", "latest_load", files.alias("new_files"), new.alias("new_rows"),
             (new > 0).alias("has_new_data"))


def to_typed_parquet(enriched: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The ETL variant: typed, validated, enriched rows written by reading day."""
    day = F.to_date("reading_ts").alias("reading_day")
    enriched.select("*", day).hint("rebalance", "reading_day").write.mode(mode).partitionBy("reading_day").parquet(path)
