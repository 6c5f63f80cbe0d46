"""Cutting long series into slices, so that no window ever needs a whole series in one task.

A window per series is one task per series: one hot series would hold up the job. Rows are numbered
along their series first, then dealt into slices of `rows_per_slice`. A slice also receives copies of
the rows just before and after it (its halo), so frames that count rows, gaps or not, see exactly the
rows they would have seen in the whole series. Copies are dropped at the end.

Numbering needs no whole series either: rows are counted per block of hours (small, combined on the
map side), block counts are added up along the series, and each row is numbered inside its block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SERIES = ("series_id",)
TS = "timestamp"
ROWS_PER_SLICE = 4096
BLOCK_HOURS = 4096

_BLOCK, _POS, _SLICE, _OWN, _SEC = "__block", "__pos", "__slice", "__own", "__sec"


def seconds(ts: str = TS) -> Column:
    return F.unix_seconds(F.col(ts))


def with_position(
    df: DataFrame,
    name: str,
    keys: Sequence[str] = SERIES,
    ts: str = TS,
    block_hours: int = BLOCK_HOURS,
    total: str | None = None,
) -> DataFrame:
    """Adds `name`, the 1-based position of a row along its series by time, and if asked `total`, the
    length of the series, which comes with the block counts and costs nothing more."""
    keys = list(keys)
    blocked = df.withColumn(_BLOCK, F.floor(seconds(ts) / (3600 * block_hours)))
    along = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    lengths = [F.sum("__rows").over(Window.partitionBy(*keys)).alias(total)] if total else []
    before = (
        blocked.groupBy(*keys, _BLOCK)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*keys, _BLOCK, F.coalesce(F.sum("__rows").over(along), F.lit(0)).alias("__before"), *lengths)
    )
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(seconds(ts))
    return (
        blocked.withColumn("__nth", F.row_number().over(inside))
        .join(before, [*keys, _BLOCK])
        .withColumn(name, F.col("__before") + F.col("__nth"))
        .drop(_BLOCK, "__before", "__nth")
    )


def slice_by_rows(
    df: DataFrame,
    back: int,
    ahead: int = 0,
    keys: Sequence[str] = SERIES,
    ts: str = TS,
    rows_per_slice: int = ROWS_PER_SLICE,
    min_rows: int = 0,
) -> DataFrame:
    """Slices with a halo of `back` rows before and `ahead` rows after. Series of fewer than `min_rows` rows are left out: their
    length comes with the numbering, without another pass or join by series."""
    placed = with_position(df, _POS, keys, ts, total="__total" if min_rows else None)
    if min_rows:
        placed = placed.filter(F.col("__total") >= min_rows).drop("__total")
    zero_based = F.col(_POS) - 1
    home = F.floor(zero_based / rows_per_slice)
    first = F.greatest(F.floor((zero_based - ahead) / rows_per_slice), F.lit(0))
    last = F.floor((zero_based + back) / rows_per_slice)
    return (
        placed.withColumn("__home", home)
        .withColumn(_SLICE, F.explode(F.sequence(first, last)))
        .withColumns({_OWN: F.col("__home") == F.col(_SLICE), _SEC: seconds(ts)})
        .drop(_POS, "__home")
    )


def slice_by_hours(
    df: DataFrame, back_hours: int, ahead_hours: int = 0, ts: str = TS, slice_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Slices of fixed length in time. Enough for frames measured in hours, and one shuffle cheaper."""
    hour = F.floor(seconds(ts) / 3600)
    home = F.floor(hour / slice_hours)
    first = F.floor((hour - ahead_hours) / slice_hours)
    # Anything within the last second of the halo still belongs to it.
    last = F.floor((hour + back_hours + 1) / slice_hours)
    return (
        df.withColumn("__home", home)
        .withColumn(_SLICE, F.explode(F.sequence(first, last)))
        .withColumns({_OWN: F.col("__home") == F.col(_SLICE), _SEC: seconds(ts)})
        .drop("__home")
    )


def in_slice(keys: Sequence[str] = SERIES) -> WindowSpec:
    """The one window specification every sliced operator shares: one exchange, one sort.

    It orders by a column of whole seconds, which serves ROWS and RANGE frames alike.
    """
    return Window.partitionBy(*keys, _SLICE).orderBy(_SEC)


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(F.col(_OWN)).drop(_SLICE, _OWN, _SEC)


def over_rows(
    df: DataFrame,
    apply: Callable[[DataFrame, WindowSpec], DataFrame],
    back: int,
    ahead: int = 0,
    keys: Sequence[str] = SERIES,
    ts: str = TS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Runs `apply` on the sliced frame and returns only the rows each slice owns."""
    sliced = slice_by_rows(df, back, ahead, keys, ts, rows_per_slice)
    return drop_halo(apply(sliced, in_slice(keys)))


def over_hours(
    df: DataFrame,
    apply: Callable[[DataFrame, WindowSpec], DataFrame],
    back_hours: int,
    ahead_hours: int = 0,
    keys: Sequence[str] = SERIES,
    ts: str = TS,
    slice_hours: int = BLOCK_HOURS,
) -> DataFrame:
    sliced = slice_by_hours(df, back_hours, ahead_hours, ts, slice_hours)
    return drop_halo(apply(sliced, in_slice(keys)))
