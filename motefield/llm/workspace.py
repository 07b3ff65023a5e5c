"""Tables that an operator writes on its way, in the shared folder of the session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def fold_ascii(text: Column) -> Column:
    """Lower case for A-Z only. ``lower`` would fold other letters too, so it serves texts of ASCII alone."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


class Workspace:
    """One folder below ``spark.checkpoint.dir``. A settled table cuts the lineage and outlives its executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, shared_dir(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def settle(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write a table once, with options of the Parquet writer, and go on from what was written."""
        df.write.options(**options).parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more, on whatever store the folder is."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
