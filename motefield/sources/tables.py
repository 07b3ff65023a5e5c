"""Parquet tables: versions, partition upserts, insert-only loads."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timing import as_ts
from ..operators.history import merge_upsert, scd2_apply

_MANIFEST = "_versions"
_VERSIONS = "version long, committed_at timestamp_ntz, parts array<string>"


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` was committed."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables that nothing reads any more, on whatever store they are."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class VersionConflict(RuntimeError):
    """Another writer has announced the version first. What was written for it is not part of the table."""


def _manifests(spark: SparkSession, path: str):
    """The folder of manifests, its file system, and the numbers of all versions announced so far."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{_MANIFEST}")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in store.listStatus(folder)] if store.exists(folder) else []
    return folder, store, [int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n)]


def list_versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, committed_at, parts) of every committed version; ``parts`` are the folders whose files make it up."""
    _, _, numbers = _manifests(spark, path)
    if not numbers:
        return spark.createDataFrame([], _VERSIONS)
    return spark.read.schema(_VERSIONS).json(f"{path}/{_MANIFEST}").orderBy("version")


def write_part(df: DataFrame, path: str) -> str:
    """Write rows into a folder of their own, which no version has yet; two writers never share one."""
    part = f"data/part-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{path}/{part}")
    return part


def commit_version(spark: SparkSession, path: str, after: int, committed_at: dt.datetime, parts: Sequence[str]) -> int:
    """Announce the version that follows ``after``, made of ``parts``; of two writers who follow the same version one fails.

    The manifest is created only if it is absent, which the store decides. Parts of earlier versions may be named again: they are
    carried over as they are.
    """
    folder, store, _ = _manifests(spark, path)
    text = json.dumps({"version": after + 1, "committed_at": committed_at.isoformat(sep=" "), "parts": list(parts)}) + "\n"
    try:
        out = store.create(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{after + 1:09d}.json"), False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise VersionConflict(f"{path} has a version {after + 1} by another writer") from error
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return after + 1


def newest_version(spark: SparkSession, path: str) -> int:
    """The last number given out, 0 before the first; also that of a writer who broke off after it took the number."""
    return max(_manifests(spark, path)[2], default=0)


def write_version(df: DataFrame, path: str, committed_at: dt.datetime, carry: Sequence[str] = (), after: int | None = None) -> int:
    """Write rows and then announce a version of them and of the parts in ``carry``; readers never see a half-written one.

    ``after`` is the version the rows were made from, by default the newest at the start.
    """
    spark = df.sparkSession
    after = newest_version(spark, path) if after is None else after
    return commit_version(spark, path, after, committed_at, [*carry, write_part(df, path)])


def version_at(spark: SparkSession, path: str, ts: dt.datetime | None = None):
    """The row of the version current at a time, of the newest without one; None before the first."""
    versions = list_versions(spark, path)
    if ts is not None:
        versions = versions.filter(F.col("committed_at") <= as_ts(ts))
    return versions.orderBy(F.col("version").desc()).first()


def read_as_of(spark: SparkSession, path: str, ts: dt.datetime | None = None) -> DataFrame:
    """The version current at a time; without a time the newest."""
    found = version_at(spark, path, ts)
    if found is None:
        raise LookupError(f"{path} has no version at {ts}")
    return spark.read.parquet(*[f"{path}/{part}" for part in found["parts"]])


def append_version(df: DataFrame, path: str, committed_at: dt.datetime) -> int:
    """A version of all rows so far and those of ``df``; only these are written."""
    found = version_at(df.sparkSession, path)
    return write_version(df, path, committed_at, found["parts"] if found else (), newest_version(df.sparkSession, path))


def overwrite_partitions(df: DataFrame, path: str, *by: str, rebalance: bool = True) -> None:
    """Replace exactly the partitions that occur in ``df``.

    Files are staged and moved in when the job commits, so ``df`` may read from ``path`` itself, and a
    repeated run gives the same table. Rows read from a table with the same partitions need no ``rebalance``: a task then holds
    few of them and writes about as many files as it reads.
    """
    (df.hint("rebalance", *by) if rebalance else df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*by).parquet(path)


def touched_partitions(df: DataFrame, by: str) -> list:
    """Distinct partition values of a batch: calendar values, so their number is small."""
    return [row[0] for row in df.select(by).distinct().collect()]


def rows_of(table: DataFrame, by: str, values: list) -> DataFrame:
    """The given partitions, NULL included."""
    known = [v for v in values if v is not None]
    wanted = F.col(by).isin(known) if known else F.lit(False)
    return table.filter(wanted | F.col(by).isNull() if None in values else wanted)


def upsert_partitions(new: DataFrame, path: str, key: str | Sequence[str], by: str) -> None:
    """Upsert into a table partitioned by ``by``, which must be a function of the key.

    Only partitions with new rows are read and written; the rest of the table is untouched.
    """
    spark = new.sparkSession
    target = read_or_none(spark, path)
    if target is None:
        overwrite_partitions(new, path, by)
        return
    old = rows_of(target, by, touched_partitions(new, by))
    overwrite_partitions(merge_upsert(old, new, key), path, by)


def snapshot_table(current: DataFrame, path: str, key: str, check_cols: Sequence[str], as_of: dt.datetime) -> DataFrame:
    """Bring the stored type-2 history at ``path`` up to date with the current state and return it.

    The last part of a version holds the open versions of the keys, the parts before it closed ones. A run reads the open part, writes
    it anew together with a part of what it closed, and carries all other parts over: closed rows are never written again. A run that
    breaks off, or meets another one, leaves the history as it was.
    """
    spark = current.sparkSession
    after, found = newest_version(spark, path), version_at(spark, path)
    stamp = F.lit(None).cast("timestamp_ntz")
    if found is None:
        carried, opened = [], current.limit(0).withColumns({"valid_from": stamp, "valid_to": stamp})
    else:
        *carried, last = found["parts"]
        opened = spark.read.parquet(f"{path}/{last}")
    changed = write_part(scd2_apply(opened, current, key, check_cols, as_of), f"{path}/scratch")
    rows = spark.read.parquet(f"{path}/scratch/{changed}")
    closed = rows.filter(F.col("valid_to").isNotNull())
    if not closed.isEmpty():
        carried.append(write_part(closed, path))
    write_version(rows.filter(F.col("valid_to").isNull()), path, as_of, carried, after)
    remove(spark, f"{path}/scratch/{changed}")
    return read_as_of(spark, path)


def merge_into_table(new: DataFrame, table: str, key: str) -> None:
    """The same upsert as ``MERGE INTO`` on a table whose format supports it."""
    condition = F.expr(f"{table}.{key} = source.{key}")
    new.alias("source").mergeInto(table, condition).whenMatched().updateAll().whenNotMatched().insertAll().merge()
