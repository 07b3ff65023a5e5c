"""Upserts and type-2 history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timing import as_ts
from .ordered import with_previous


def merge_upsert(target: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """New rows replace target rows of the same key, the rest is kept."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(new.select(*target.columns))


def reprocess(target: DataFrame, source: DataFrame, ts: str, low, high) -> DataFrame:
    """Drop the target rows of a closed time range and take them from the source again."""
    inside = F.col(ts).between(as_ts(low), as_ts(high))
    return target.filter(~F.coalesce(inside, F.lit(False))).unionByName(source.filter(inside))


def _changed(check_cols: Sequence[str], left: str, right: str) -> Column:
    differs = F.lit(False)
    for name in check_cols:
        differs = differs | ~F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return differs


def scd2_apply(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: Column | dt.datetime,
) -> DataFrame:
    """Compare the open versions with the current state: close what changed, open what is new.

    Keys that vanished from the current state keep their open version.
    """
    now = as_ts(as_of)
    attributes = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    closed = history.filter(F.col("valid_to").isNotNull())
    opened = history.filter(F.col("valid_to").isNull()).alias("o")
    pairs = opened.join(current.alias("c"), F.col(f"o.{key}") == F.col(f"c.{key}"), "full_outer")

    had, has = F.col(f"o.{key}").isNotNull(), F.col(f"c.{key}").isNotNull()
    differs = _changed(check_cols, "o", "c")
    old = F.struct(*[F.col(f"o.{c}").alias(c) for c in attributes], F.col("o.valid_from").alias("valid_from"),
                   F.when(has & differs, now).alias("valid_to"))
    fresh = F.struct(*[F.col(f"c.{c}").alias(c) for c in attributes], now.alias("valid_from"),
                     F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    versions = F.array_compact(F.array(F.when(had, old), F.when(has & (~had | differs), fresh)))
    return closed.unionByName(pairs.select(F.inline(versions)))


def scd2_from_log(
    log: DataFrame,
    key: str,
    check_cols: Sequence[str],
    ts: str,
    ties: Sequence[str] = (),
    **split,
) -> DataFrame:
    """All versions of each key from an event log.

    Change detection looks one row back and is split for hot keys; only the change rows, which are few,
    are then chained by ``lead``.
    """
    state = F.struct(*check_cols)
    seen = with_previous(log.select(key, *check_cols, ts, *ties), key, ts, ties,
                         {"_before": state, "_first": F.lit(1)}, **split)
    changes = seen.filter(F.col("_first").isNull() | ~F.col("_before").eqNullSafe(state))
    chain = Window.partitionBy(key).orderBy(F.col(ts).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])
    return changes.select(key, *check_cols, F.col(ts).alias("valid_from"), F.lead(ts).over(chain).alias("valid_to"))


def scd2_changes(history: DataFrame, key: str) -> DataFrame:
    """Versions that were replaced."""
    return history.filter(F.col("valid_to").isNotNull()).orderBy(key, "valid_from")
