"""Forecasts: seasonal-naive, future frames for a trained model, and the forecast table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourline.config import LAG_HOURS, TIMEZONE, WEATHER_COLUMNS
from hourline.functions import scalar
from hourline.functions.calendar import add_calendar
from hourline.operators.joins import lookup_at
from hourline.operators.slices import SERIES, TS
from hourline.operators.windows import latest_per, newest_moments, with_whole

MIN_HISTORY = 168


def naive_forecast(df: DataFrame, hours: int, column: str = "value", name: str = "baseline") -> DataFrame:
    """Adds the value of the same series `hours` earlier; NULL where that hour is absent."""
    return lookup_at(df, df, (hours,), column, (name,), fallback=False)


def history_rows(horizon: int, lag_hours: Sequence[int] = LAG_HOURS) -> int:
    """Newest hourly rows that hold every hour a lookup of the next `horizon` hours can ask for."""
    return max(horizon + 168, max(lag_hours, default=0), 200)


def future_features(
    history: DataFrame,
    run_at,
    horizon: int,
    lag_hours: Sequence[int] = LAG_HOURS,
    weather: Sequence[str] = WEATHER_COLUMNS,
    timezone: str = TIMEZONE,
    keys: Sequence[str] = SERIES,
    extra_holidays: DataFrame | None = None,
    strict: bool = False,
) -> DataFrame:
    """Model inputs for the next `horizon` hours of every series.

    Lags come from the exact hour, else the last known value; weather from the same hour a week ago,
    else the last row; trailing statistics from the newest rows. A series with fewer than 168 rows is
    left out, or with `strict` is an error.

    Rows after `run_at` are not looked at. Lookups and statistics use the newest `history_rows` rows of a series,
    so the per-series lookup table below has a fixed bound; the last known value is sought in all rows.
    """
    keys = list(keys)
    history = history.filter(F.col(TS) <= scalar.as_time(run_at))
    newest = Window.partitionBy(*keys).orderBy(F.col(TS).desc())
    recent = (
        history.select(*keys, TS, "value", *weather)
        .withColumn("__rank", F.row_number().over(newest))
        .filter(F.col("__rank") <= history_rows(horizon, lag_hours))
    )
    known = F.col("value").isNotNull()
    bundle = F.struct("value", *weather)
    per_series = with_whole(recent, "value", keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.map_from_entries(F.collect_list(F.struct(F.col(TS), bundle))).alias("__at"),
        F.max_by(F.struct(*weather), F.col(TS)).alias("__last_weather"),
        *newest_moments(F.col("__rank") <= 168, "rolling_7d_mean", "rolling_7d_std"),
        newest_moments(F.col("__rank") <= 24, "rolling_24h_mean")[0],
    )
    last = history.groupBy(*keys).agg(F.max_by(F.when(known, F.col("value")), F.when(known, F.col(TS))).alias("__last"))
    per_series = per_series.join(last, keys)
    enough = F.col("__rows") >= MIN_HISTORY
    if strict:
        text = F.format_string(f"{MIN_HISTORY} rows of history needed, a series has %d", F.col("__rows"))
        per_series = per_series.filter(F.when(enough, True).otherwise(F.raise_error(text).cast("boolean")))
    else:
        per_series = per_series.filter(enough)

    start = F.date_trunc("hour", scalar.as_time(run_at))
    out = per_series.withColumn("__i", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        TS, F.timestamp_add("HOUR", F.col("__i"), start)
    )

    def hour_before(hours: int) -> Column:
        return F.timestamp_add("HOUR", F.lit(-hours), F.col(TS))

    def has(hours: int) -> Column:
        return F.map_contains_key("__at", hour_before(hours))

    def at(hours: int) -> Column:
        return F.try_element_at("__at", hour_before(hours))

    lags = {
        f"lag_{h}h": F.when(has(h), at(h).getField("value")).otherwise(F.col("__last")) for h in lag_hours
    }
    proxy = F.when(has(168), F.struct(*[at(168).getField(c).alias(c) for c in weather])).otherwise(
        F.col("__last_weather")
    )
    out = out.withColumns(lags | {c: proxy.getField(c) for c in weather})
    out = out.drop("__rows", "__at", "__last", "__last_weather", "__i")
    return add_calendar(out, timezone, "day", extra_holidays)


def shape_forecasts(
    predictions: DataFrame,
    model_name: str,
    model_version: str,
    horizon: int,
    run_at,
    run_id: str,
    predicted: str = "prediction",
    target_hours_ahead: int = 0,
) -> DataFrame:
    """Forecast rows from predictions: clipped at zero, with the deterministic id.

    For a model trained on the value `target_hours_ahead` later, the forecast is filed under that hour
    and the hour of its features is kept beside it. A flag of filled inputs is kept too.
    """
    target = F.timestamp_add("HOUR", F.lit(target_hours_ahead), F.col(TS))
    name, run_at = F.lit(model_name), scalar.as_time(run_at)
    return predictions.select(
        scalar.forecast_id(name, F.lit(str(horizon)), target).alias("forecast_key"),
        "series_id",
        target.alias(TS),
        F.col(TS).alias("feature_timestamp"),
        run_at.alias("forecast_run_at"),
        name.alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.lit(horizon).alias("horizon_hours"),
        scalar.clip_at_zero(F.col(predicted)).alias("predicted"),
        F.lit(None).cast("double").alias("actual"),
        F.lit(False).alias("is_backfilled"),
        F.lit(run_id).alias("run_id"),
        run_at.alias("created_at"),
        *[c for c in ("inputs_imputed",) if c in predictions.columns],
    ).withColumnRenamed("forecast_key", "forecast_id")


def serving_run(runs: DataFrame, primary: str, fallback: str) -> DataFrame:
    """The run that serves each horizon: the primary family if it has any run, else the fallback;
    within a family a production run before any other, then the lowest MAPE."""
    ours = runs.filter(F.col("family").isin(primary, fallback))
    return latest_per(
        ours, ["horizon_hours"],
        (F.col("family") == primary).desc(), F.col("production").desc(),
        F.col("mape").asc_nulls_last(), F.col("started_at").desc(), F.col("run_id"),
    )
