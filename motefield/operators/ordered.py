"""Ordered windows that do not put a whole key into one task.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task. When one key holds a large share of the data that
task never ends, and AQE does not split windows. Here such keys are cut along the order into slices of about
``rows_per_slice`` rows. Each slice is its own window partition, and the few rows at its ends, whose frames reach into the
slices beside it, are computed again over the rows at the ends alone. The result is that of the plain window for every input.

Where to cut follows from the rows alone: a hash of its place in the order draws a row, and every ``SAMPLES``-th drawn row of a key
starts a slice. So the cuts are a relation like any other, joined to the rows; places are compared as they are, whatever their types,
and both uses of a sliced frame see the same slices without relying on a reused shuffle. A key below about
``rows_per_slice`` rows gets no cut, and without any cut the plan is the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ROWS_PER_SLICE = 5_000_000
SAMPLES = 16


def _same(names: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).eqNullSafe(F.col(f"{prefix}{name}"))
    return cond


def _prefixed(names: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(n).alias(f"{prefix}{n}") for n in names]


def _place(order: Sequence[str]) -> Column:
    """The place of a row in ``ORDER BY ... NULLS LAST`` as one value that compares like it."""
    return F.struct(*[c for i, n in enumerate(order) for c in (F.col(n).isNull().alias(f"n{i}"), F.col(n).alias(f"v{i}"))])


def _bounds_up_to(bounds: Column, place: Column) -> Column:
    """How many of the sorted ``bounds`` are at or before ``place``, by halving."""

    def halve(state: Column, _: Column) -> Column:
        low, high = state["low"], state["high"]
        middle = F.shiftright(low + high, 1)
        nearer = F.when(F.element_at(bounds, middle + 1) <= place, F.struct((middle + 1).alias("low"), high.alias("high"))).otherwise(
            F.struct(low.alias("low"), middle.alias("high")))
        return F.when(low < high, nearer).otherwise(state)

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + F.lit(1))).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high")), halve)["low"]


class Slices:
    """Cuts for the keys of ``profile`` that have many rows, and other frames cut accordingly.

    ``profile`` only steers the cuts, so it may be any cheap frame with about the same distribution, for instance the input of an
    expensive plan instead of its output. ``bounds`` has a row per key that is cut, about one bound per ``rows_per_slice`` rows.
    """

    def __init__(self, profile: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE):
        self.keys, self.order = list(keys), list(order)
        samples = max(min(SAMPLES, rows_per_slice), 1)
        drawn = profile.filter(F.pmod(F.xxhash64(*self.order), F.lit(max(rows_per_slice // samples, 1))) == 0)
        places = drawn.groupBy(*_prefixed(self.keys, "_h_")).agg(F.array_sort(F.collect_set(_place(self.order))).alias("_places"))
        starts = F.filter("_places", lambda _, i: (i + 1) % samples == 0)
        self.bounds = places.select(*[f"_h_{k}" for k in self.keys], starts.alias("_bounds")).filter(F.size("_bounds") > 0)

    def sliced(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_slice``, which grows with the order of the rows of a key, and its largest value ``_slices``."""
        cut = df.join(self.bounds, _same(self.keys, "_h_"), "left")
        number = F.when(F.col("_bounds").isNull(), 0).otherwise(_bounds_up_to(F.col("_bounds"), _place(self.order)))
        return cut.select(*df.columns, number.alias("_slice"), F.coalesce(F.size("_bounds"), F.lit(0)).alias("_slices"))


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: Sequence[str],
    back: int,
    outputs: dict[str, Callable[[WindowSpec], Column]],
    rows_per_slice: int = ROWS_PER_SLICE,
    profile: DataFrame | None = None,
    ahead: int = 0,
) -> DataFrame:
    """Add window columns that look at the current row, at most ``back`` rows before and ``ahead`` rows after it, per key by time.

    Each output is a function of the ordered window (``lag``, ``lead``) or of a row frame taken from it. One look at ``profile`` tells
    whether any key is cut; nothing of it comes to the driver.
    """
    order = [F.col(c).asc_nulls_last() for c in (ts, *ties)]
    whole = Window.partitionBy(*keys).orderBy(*order)
    slices = Slices(profile if profile is not None else df, keys, (ts, *ties), rows_per_slice)
    if slices.bounds.isEmpty():
        return df.withColumns({name: make(whole) for name, make in outputs.items()})

    part = Window.partitionBy(*keys, "_slice", "_slices")
    cut = slices.sliced(df).withColumns(
        {name: make(part.orderBy(*order)) for name, make in outputs.items()}
        | {"_pos": F.row_number().over(part.orderBy(*order)), "_size": F.count(F.lit(1)).over(part)})
    first, last = F.col("_slice") == 0, F.col("_slice") == F.col("_slices")
    right = (first | (F.col("_pos") > back)) & (last | (F.col("_pos") <= F.col("_size") - ahead))
    reach = back + ahead
    near = (~first & (F.col("_pos") <= reach)) | (~last & (F.col("_pos") > F.col("_size") - reach))
    ends = cut.filter(F.col("_slices") > 0).filter(near).withColumn("_again", ~right).drop(*outputs)
    again = ends.withColumns({name: make(whole) for name, make in outputs.items()}).filter("_again")
    names = [*df.columns, *outputs]
    return cut.filter(right).select(names).union(again.select(names))


def rank_in(df: DataFrame, group: Sequence[str], metric: str, name: str = "rank", rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``rank()`` of ``metric`` within a group, highest first, NULL on top.

    Rows are counted per value first, so ties cost nothing. A group with very many values is cut into slices of them; a value's rank
    is one more than the rows above it in its slice and those of the group's slices above. No task holds such a group.
    """
    counts = df.groupBy(*group, metric).agg(F.count(F.lit(1)).alias("_n"))
    parts = Slices(counts, group, [metric], rows_per_slice).sliced(counts)
    above = Window.partitionBy(*group, "_slice").orderBy(F.col(metric).desc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    higher = Window.partitionBy(*group).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    whole = parts.groupBy(*group, "_slice").agg(F.sum("_n").alias("_whole"))
    offsets = whole.select(*_prefixed(group, "_o_"), F.col("_slice").alias("_o_slice"), F.coalesce(F.sum("_whole").over(higher), F.lit(0)).alias("_before"))
    local = parts.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
    ranks = local.join(offsets, _same(group, "_o_") & (F.col("_slice") == F.col("_o_slice"))).select(
        *_prefixed([*group, metric], "_r_"), (F.col("_above") + F.col("_before") + 1).cast("int").alias(name))
    return df.join(ranks, _same([*group, metric], "_r_")).select(*df.columns, name)


def rolling_zscore(
    df: DataFrame,
    value: str = "temperature",
    key: str = "device_id",
    ts: str = "reading_ts",
    ties: Sequence[str] = ("reading_id",),
    n: int = 12,
    name: str = "temperature_zscore",
    **split,
) -> DataFrame:
    """Distance from the mean of the last ``n`` rows and this one, in sample standard deviations."""

    def zscore(window: WindowSpec) -> Column:
        frame = window.rowsBetween(-n, 0)
        spread = F.nullif(F.stddev_samp(value).over(frame), F.lit(0.0))
        return (F.col(value) - F.avg(value).over(frame)) / spread

    return rolling(df, [key], ts, ties, n, {name: zscore}, **split)


def rolling_avg(
    df: DataFrame,
    value: str = "temperature",
    key: str = "device_id",
    ts: str = "reading_ts",
    ties: Sequence[str] = ("reading_id",),
    n: int = 11,
    name: str = "rolling_avg",
    **split,
) -> DataFrame:
    """Mean of this row and the ``n`` rows before it."""
    return rolling(df, [key], ts, ties, n, {name: lambda w: F.avg(value).over(w.rowsBetween(-n, 0))}, **split)


def with_previous(
    df: DataFrame,
    key: str,
    ts: str,
    ties: Sequence[str],
    previous: dict[str, Column | str],
    **split,
) -> DataFrame:
    """Values of the row before, by name; the first row of a key gets NULL."""
    outputs = {
        name: (lambda w, source=source: F.lag(source, 1).over(w))
        for name, source in previous.items()
    }
    return rolling(df, [key], ts, ties, 1, outputs, **split)


def flag_anomaly(zscore: str = "temperature_zscore", k: float = 3.0) -> Column:
    return F.coalesce(F.abs(F.col(zscore)) > k, F.lit(False))
