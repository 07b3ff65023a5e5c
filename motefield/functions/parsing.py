"""Tolerant extraction and casts: bad or missing input becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_field(payload: Column | str, path: str, type_: str = "string") -> Column:
    """Read one field of a VARIANT; a value that does not fit ``type_`` is NULL."""
    variant = F.col(payload) if isinstance(payload, str) else payload
    return F.try_variant_get(variant, path if path.startswith("$") else f"$.{path}", type_)


def strict_field(payload: Column | str, path: str, type_: str) -> Column:
    """Like :func:`json_field`, but a value of the wrong type raises."""
    variant = F.col(payload) if isinstance(payload, str) else payload
    return F.variant_get(variant, path if path.startswith("$") else f"$.{path}", type_)


def try_double(text: Column) -> Column:
    return text.try_cast("double")


def safe_numeric(value: Column, precision: int = 10, scale: int = 2) -> Column:
    return value.try_cast(f"decimal({precision},{scale})")


def try_ts(text: Column) -> Column:
    """ISO-8601 text, with or without an offset, to a UTC wall-clock timestamp."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def coalesce_renamed(df: DataFrame, new: str, old: str, type_: str = "double") -> DataFrame:
    """Fold a renamed field back into its contract column."""
    return df.withColumn(new, F.coalesce(F.col(new), F.col(old).try_cast(type_))).drop(old)


def mask_columns(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Replace sensitive text: ``hash`` keeps equality joins possible, ``mask`` keeps only the shape."""
    how = {"hash": lambda c: F.sha2(c, 256), "mask": lambda c: F.mask(c)}
    return df.withColumns({name: how[rule](F.col(name).cast("string")) for name, rule in rules.items()})
