"""Hash keys over column lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed value: text that stands for NULL inside a surrogate key
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def key_text(value: Column, type_: T.DataType) -> Column:
    """Engine-independent text: full microseconds for times, six decimals for doubles."""
    if isinstance(type_, (T.TimestampNTZType, T.TimestampType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(type_, (T.DoubleType, T.FloatType)):
        return value.try_cast("decimal(38,6)").cast("string")
    return value.cast("string")


def surrogate_key(df: DataFrame, *parts: str | Column) -> Column:
    """md5 over the parts joined by '-'. Names take their type from ``df``; Column parts must be text."""
    texts = [
        key_text(F.col(p), df.schema[p].dataType) if isinstance(p, str) else p
        for p in parts
    ]
    return F.md5(F.concat_ws("-", *[F.coalesce(t, F.lit(NULL_TOKEN)) for t in texts]))
