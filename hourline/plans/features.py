"""The feature matrix: one plan from load and weather to every model input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from hourline.config import FEATURE_COLUMNS, FeatureOptions
from hourline.functions.calendar import add_calendar
from hourline.operators.joins import join_weather
from hourline.operators.project import require_columns
from hourline.operators.slices import drop_halo, in_slice, slice_by_rows
from hourline.operators.windows import (
    eve_column, impute_columns, impute_halo, lag_columns, rolling_columns, temperature_lag_column,
)


def halo(options: FeatureOptions = FeatureOptions()) -> tuple[int, int]:
    """Rows before and after a row that its features can depend on. Lags by the clock reach no further: an hour has one row."""
    fill_back, fill_ahead = impute_halo()
    return max(*options.lag_hours, *(s.rows for s in options.rolling), fill_back + 24), max(fill_ahead, 1)


def build_features(
    load: DataFrame,
    weather: DataFrame | None = None,
    options: FeatureOptions = FeatureOptions(),
    built_at: Column | None = None,
    extra_holidays: DataFrame | None = None,
) -> DataFrame:
    """One row per load row with calendar, lag, rolling and weather features.

    `load` has one row per series and hour (`operators.quality.hourly` makes it so). Series with fewer
    than `options.min_rows` rows are left out; `operators.quality.require_rows` reports them.
    """
    require_columns(load, ("series_id", "timestamp", "value"))
    joined = join_weather(load, weather)

    back, fill_ahead = halo(options)
    sliced = slice_by_rows(joined, back, fill_ahead, rows_per_slice=options.rows_per_slice, min_rows=options.min_rows)
    w = in_slice()
    out = lag_columns(sliced, w, "value", options.lag_hours)
    out = rolling_columns(out, w, "value", options.rolling)
    out = impute_columns(out, w)
    out = out.withColumn(
        "temperature_lag_24h", temperature_lag_column(w, options.temperature_lag_time_exact)
    )
    # Calendar columns come last: they are computed where the rows are and never shuffled.
    out = add_calendar(out, options.timezone, options.eve_mode, extra_holidays)
    if options.eve_mode == "row":
        out = out.withColumn("is_holiday_eve", eve_column(w))
    out = drop_halo(out)
    return out if built_at is None else out.withColumn("feature_built_at", built_at)


def feature_columns() -> list[str]:
    return list(FEATURE_COLUMNS)
