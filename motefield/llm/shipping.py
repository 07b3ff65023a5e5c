"""Gives the executors' Python workers this package where it is not installed."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application, as ``spark-submit --py-files`` does."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp()) / package.name
        spark.sparkContext.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _SHIPPED.add(app)
