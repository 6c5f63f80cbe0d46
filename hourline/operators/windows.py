"""Window operators along a series: lags, targets, rolling statistics, imputation, runs of flags.

Every public operator cuts the series into slices (see `slices`). The `*_columns` functions hold the
expressions, so the feature matrix can apply all of them on one sliced frame: one exchange, one sort.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hourline.config import (
    CENTERED_ROWS, FILL_LIMIT, LAG_HOURS, ROLLING, WEATHER_COLUMNS, Rolling,
)
from hourline.functions.exact import dec, exponent_of, finite, mean_of, whole, whole_mean, whole_std, wide
from hourline.operators.slices import ROWS_PER_SLICE, SERIES, TS, over_hours, over_rows


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def value_at(column: str, w: WindowSpec, hours: int) -> Column:
    """The value exactly `hours` after the row (negative: before); NULL when that hour is absent."""
    offset = hours * 3600
    return F.first(F.col(column)).over(w.rangeBetween(offset, offset))


# --- lags -----------------------------------------------------------------------------------------

def lag_columns(df: DataFrame, w: WindowSpec, column: str, hours: Sequence[int]) -> DataFrame:
    names = [f"lag_{h}h" for h in hours]
    lagged = df.withColumns({n: value_at(column, w, -h) for n, h in zip(names, hours)})
    return lagged.withColumn("has_lag_gap", any_null(names))


def add_lags(
    df: DataFrame, hours: Sequence[int] = LAG_HOURS, column: str = "value", keys: Sequence[str] = SERIES
) -> DataFrame:
    """Time-exact lags and `has_lag_gap`; gaps in the series give NULL, never a shifted value."""
    return over_hours(df, lambda d, w: lag_columns(d, w, column, hours), max(hours), keys=keys)


def add_target(
    df: DataFrame, hours: int, column: str = "value", mode: str = "time", keys: Sequence[str] = SERIES
) -> DataFrame:
    """`target`: the value `hours` ahead, by the clock (`time`) or by row count (`row`)."""
    if mode == "time":
        return over_hours(
            df, lambda d, w: d.withColumn("target", value_at(column, w, hours)), 0, hours, keys=keys
        )
    if mode != "row":
        raise ValueError(f"mode must be 'time' or 'row', not {mode!r}")
    return over_rows(
        df, lambda d, w: d.withColumn("target", F.lead(column, hours).over(w)), 0, hours, keys=keys
    )


def temperature_lag_column(w: WindowSpec, time_exact: bool = False, column: str = "temperature") -> Column:
    return value_at(column, w, -24) if time_exact else F.lag(column, 24).over(w)


def add_temperature_lag(
    df: DataFrame, time_exact: bool = False, column: str = "temperature", keys: Sequence[str] = SERIES
) -> DataFrame:
    """`temperature_lag_24h`: 24 rows back, or 24 hours back with `time_exact`."""
    return over_rows(
        df,
        lambda d, w: d.withColumn(f"{column}_lag_24h", temperature_lag_column(w, time_exact, column)),
        24, keys=keys,
    )


# --- rolling --------------------------------------------------------------------------------------

def rolling_columns(
    df: DataFrame, w: WindowSpec, column: str = "value", specs: Sequence[Rolling] = ROLLING
) -> DataFrame:
    """Trailing statistics as differences of running sums: constant work per row for any length.

    The running sums are whole numbers of a power of ten that the slice's largest value decides, so the
    difference is the exact sum of the frame, and the deviation has no cancellation. Values that are not finite
    count as unknown.
    """
    largest = F.max(F.abs(finite(F.col(column)))).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    scaled = df.withColumn("__e", exponent_of(largest)).withColumn("__d", whole(F.col(column), F.col("__e")))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {"__n": F.count("__d").over(running), "__s": F.sum("__d").over(running)}
    if any(s.stat == "std" for s in specs):
        # Turning numbers into decimals is the dear part: once per row, not once per aggregate.
        scaled = scaled.withColumn("__w", wide(F.col("__d"))).withColumn("__dd", F.col("__w") * F.col("__w"))
        totals["__ss"] = F.sum("__dd").over(running)
    out = scaled.withColumns(totals)

    lengths = sorted({s.rows for s in specs})
    before = {f"{t}_{rows}": F.lag(t, rows).over(w) for rows in lengths for t in totals}
    out = out.withColumns(before)

    def inside(total: str, rows: int) -> Column:
        earlier = F.col(f"{total}_{rows}")
        return F.when(earlier.isNull(), F.col(total)).otherwise(F.col(total) - earlier)

    stats = {}
    for s in specs:
        n, total = inside("__n", s.rows), inside("__s", s.rows)
        if s.stat == "mean":
            value = whole_mean(total, n, F.col("__e"))
        elif s.stat == "std":
            value = whole_std(total, inside("__ss", s.rows), n, F.col("__e"))
        else:
            raise ValueError(f"unknown statistic {s.stat!r}")
        stats[s.name] = F.when(n >= s.min_rows, value)
    return out.withColumns(stats).drop("__e", "__d", "__w", "__dd", *totals, *before)


def add_rolling(
    df: DataFrame,
    specs: Sequence[Rolling] = ROLLING,
    column: str = "value",
    keys: Sequence[str] = SERIES,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Trailing mean and sample deviation over the last n rows, this one included."""
    # One row more than the frame: the running sum is subtracted as of the row before it.
    back = max(s.rows for s in specs)
    return over_rows(
        df, lambda d, w: rolling_columns(d, w, column, specs), back, keys=keys, rows_per_slice=rows_per_slice
    )


# --- imputation -----------------------------------------------------------------------------------

def bounded_fill_columns(df: DataFrame, w: WindowSpec, columns: Sequence[str], limit: int) -> DataFrame:
    forward = {c: F.last(c, ignorenulls=True).over(w.rowsBetween(-limit, 0)) for c in columns}
    backward = {c: F.first(c, ignorenulls=True).over(w.rowsBetween(0, limit)) for c in columns}
    return df.withColumns(forward).withColumns(backward)


def centered_fill_columns(df: DataFrame, w: WindowSpec, columns: Sequence[str], rows: int) -> DataFrame:
    """What is still missing becomes the mean of the known values in the `rows` rows around it.

    The frame has rows//2 rows before and, for an even length, one row fewer after.
    """
    before, after = rows // 2, rows - rows // 2 - 1
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    exact = {f"__d_{c}": dec(c, "decimal(18,6)") for c in columns}
    sums: dict[str, Column] = {}
    for c in columns:
        sums |= {f"__n_{c}": F.count(f"__d_{c}").over(running), f"__s_{c}": F.sum(f"__d_{c}").over(running)}
    out = df.withColumns(exact).withColumns(sums)
    ends: dict[str, Column] = {}
    for c in columns:
        for t in ("n", "s"):
            total = f"__{t}_{c}"
            # Past the end of the series the running sum stays what it is on the last row.
            ends[f"__{t}hi_{c}"] = F.coalesce(F.lead(total, after).over(w), F.last(total).over(whole))
            ends[f"__{t}lo_{c}"] = F.lag(total, before + 1).over(w)
    out = out.withColumns(ends)

    def inside(t: str, c: str) -> Column:
        high, low = F.col(f"__{t}hi_{c}"), F.col(f"__{t}lo_{c}")
        return F.when(low.isNull(), high).otherwise(high - low)

    filled = {c: F.coalesce(F.col(c), mean_of(inside("s", c), inside("n", c))) for c in columns}
    return out.withColumns(filled).drop(*exact, *sums, *ends)


def impute_columns(
    df: DataFrame,
    w: WindowSpec,
    columns: Sequence[str] = WEATHER_COLUMNS,
    limit: int = FILL_LIMIT,
    rows: int = CENTERED_ROWS,
) -> DataFrame:
    was = {f"__was_{c}": F.col(c).isNull() for c in columns}
    out = df.withColumns(was)
    out = centered_fill_columns(bounded_fill_columns(out, w, columns, limit), w, columns, rows)
    filled = reduce(or_, [F.col(f"__was_{c}") & F.col(c).isNotNull() for c in columns])
    flag = F.coalesce(F.col("is_weather_imputed"), F.lit(False)) if "is_weather_imputed" in df.columns else F.lit(False)
    return out.withColumns(
        {"temp_missing": F.col(f"__was_{columns[0]}"), "is_weather_imputed": flag | filled}
    ).drop(*was)


def impute_halo(limit: int = FILL_LIMIT, rows: int = CENTERED_ROWS) -> tuple[int, int]:
    """Rows before and after a row that its imputed value can depend on."""
    return rows // 2 + 1 + limit, rows - rows // 2 - 1 + limit


def fill_bounded(
    df: DataFrame, columns: Sequence[str], limit: int = FILL_LIMIT, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Forward fill over at most `limit` rows, then backward fill over at most `limit` rows."""
    return over_rows(
        df, lambda d, w: bounded_fill_columns(d, w, columns, limit), limit, 2 * limit, keys=keys
    )


def fill_centered(
    df: DataFrame, columns: Sequence[str], rows: int = CENTERED_ROWS, keys: Sequence[str] = SERIES
) -> DataFrame:
    return over_rows(
        df, lambda d, w: centered_fill_columns(d, w, columns, rows), rows // 2 + 1, rows // 2, keys=keys
    )


def impute_weather(
    df: DataFrame,
    columns: Sequence[str] = WEATHER_COLUMNS,
    limit: int = FILL_LIMIT,
    rows: int = CENTERED_ROWS,
    keys: Sequence[str] = SERIES,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Bounded fills, then the centred mean; flags what was missing and what was filled."""
    back, ahead = impute_halo(limit, rows)
    return over_rows(
        df, lambda d, w: impute_columns(d, w, columns, limit, rows), back, ahead,
        keys=keys, rows_per_slice=rows_per_slice,
    )


# --- holiday eve ----------------------------------------------------------------------------------

def eve_column(w: WindowSpec) -> Column:
    """The next row is a holiday or falls on a weekend; false on the last row."""
    return F.coalesce(F.lead("is_holiday").over(w), F.lit(False)) | F.coalesce(
        F.lead("day_of_week").over(w) >= 5, F.lit(False)
    )


def add_holiday_eve(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Row mode; `functions.calendar.add_calendar` has the day mode, which needs no window."""
    return over_rows(df, lambda d, w: d.withColumn("is_holiday_eve", eve_column(w)), 0, 1, keys=keys)


# --- newest rows and runs of flags ----------------------------------------------------------------

def latest_per(df: DataFrame, keys: Sequence[str], *order: Column, n: int = 1) -> DataFrame:
    """The newest `n` rows of each key.

    `row_number() <= n` is cut on the map side before the shuffle, so a hot key sends n rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n)
    return kept.drop("__rank")


def consecutive_true(
    df: DataFrame,
    flag: str,
    keys: Sequence[str] = SERIES,
    order: str = "check_timestamp",
    cap: int | None = None,
    contiguous: bool = False,
) -> DataFrame:
    """Length of the run of true flags that ends at each key's newest check; `cap` bounds the answer, not the rows read.

    The newest false flag ends the run, and the newer rows are counted: two hash aggregates. With
    `contiguous` an hour without a check also ends the run; gaps are then looked for in the run alone.
    """
    keys = list(keys)
    rows = df.select(*keys, order, flag)
    ends = F.max(F.when(~F.coalesce(F.col(flag), F.lit(False)), F.col(order)))
    run = after_end(rows, rows.groupBy(*keys).agg(ends.alias("__end")), keys, order)
    if contiguous:
        newer = F.lag(seconds_of(order)).over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
        gaps = run.withColumn("__gap", F.coalesce(newer - seconds_of(order), F.lit(3600)) != 3600)
        ends = F.max(F.when(F.col("__gap"), F.col(order)))
        run = after_end(run, gaps.groupBy(*keys).agg(ends.alias("__end")), keys, order)
    counted = run.groupBy(*keys).agg(F.count(F.lit(1)).alias("__counted"))
    found = df.select(*keys).distinct().join(counted, keys, "left")
    length = F.coalesce("__counted", F.lit(0)) if cap is None else F.least(F.coalesce("__counted", F.lit(0)), F.lit(cap))
    return found.select(*keys, length.cast("int").alias("consecutive"))


def after_end(rows: DataFrame, ends: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The rows of each key that are newer than its `__end`, all where that is NULL."""
    return rows.join(ends, list(keys)).filter(F.col("__end").isNull() | (F.col(order) > F.col("__end"))).drop("__end")


def seconds_of(column: str) -> Column:
    return F.unix_seconds(F.col(column))


def cooldown(
    df: DataFrame,
    now: Column,
    keys: Sequence[str] = SERIES,
    order: str = "check_timestamp",
    flag: str = "retrain_triggered",
) -> DataFrame:
    """Hours since each key's last trigger; NULL if it never triggered."""
    last = F.max(F.when(F.col(flag), F.col(order)))
    return df.groupBy(*keys).agg(last.alias("last_trigger")).withColumn(
        "hours_since_trigger",
        (F.unix_seconds(now) - F.unix_seconds("last_trigger")) / F.lit(3600.0),
    )


def tail_stats(
    df: DataFrame, keys: Sequence[str] = SERIES, column: str = "value", long: int = 168, short: int = 24,
    as_of: Column | None = None,
) -> DataFrame:
    """Per series: mean and deviation of the newest `long` rows, mean of the newest `short`, last value.
    With `as_of` later rows do not count."""
    if as_of is not None:
        df = df.filter(F.col(TS) <= as_of)
    newest = Window.partitionBy(*keys).orderBy(F.col(TS).desc())
    recent = (
        df.select(*keys, TS, column)
        .withColumn("__rank", F.row_number().over(newest))
        .filter(F.col("__rank") <= long)
    )
    known = F.col(column).isNotNull()
    return with_whole(recent, column, keys).groupBy(*keys).agg(
        *newest_moments(F.lit(True), "tail_mean", "tail_std"),
        newest_moments(F.col("__rank") <= short, "tail_short_mean")[0],
        F.max_by(F.when(known, F.col(column)), F.when(known, F.col(TS))).alias("last_value"),
    )


def with_whole(recent: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Adds `__e` and `__d`, the value as a whole number scaled by the largest value of its key. For a bounded number of rows
    per key: the window needs no exchange beyond the one that ranked them."""
    largest = F.max(F.abs(finite(F.col(column)))).over(Window.partitionBy(*keys))
    return recent.withColumn("__e", exponent_of(largest)).withColumn("__d", whole(F.col(column), F.col("__e")))


def newest_moments(where: Column, mean: str, std: str | None = None) -> list[Column]:
    """Aggregates over the rows of `with_whole` that `where` admits: mean and, if named, deviation (0 for one row)."""
    value = F.when(where, F.col("__d"))
    n, total, exponent = F.count(value), F.sum(value), F.max("__e")
    out = [whole_mean(total, n, exponent).alias(mean)]
    if std:
        squares = F.sum(wide(value) * wide(value))
        out.append(F.coalesce(whole_std(total, squares, n, exponent), F.lit(0.0)).alias(std))
    return out
