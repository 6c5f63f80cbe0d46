"""Quality of a load table: counts, NULL rates, duplicates, ranges, gaps, sufficiency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline.config import FEATURE_NULL_WARNING, MIN_TRAINING_ROWS, NULL_RATE_WARNING
from hourline.functions.scalar import as_time, days_before, hours_before
from hourline.operators.joins import absent_spans
from hourline.operators.project import between_ts
from hourline.operators.slices import SERIES, TS
from hourline.operators.windows import latest_per

KEY = (*SERIES, TS)


def load_quality(
    df: DataFrame, by: Sequence[str] = (), column: str = "value", warn_above: float = NULL_RATE_WARNING
) -> DataFrame:
    """Rows, NULLs, NULL rate and the warning, in one aggregation."""
    rows, nulls = F.count(F.lit(1)), F.count_if(F.col(column).isNull())
    out = df.groupBy(*by).agg(rows.alias("rows"), nulls.alias("nulls"))
    rate = F.coalesce(F.col("nulls") / F.nullif(F.col("rows"), F.lit(0)), F.lit(0.0))
    return out.withColumn("null_rate", rate).withColumn("high_gap_rate", F.col("null_rate") > warn_above)


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def dedup_latest(
    df: DataFrame, keys: Sequence[str] = KEY, order: str = "fetched_at", *tie: Column
) -> DataFrame:
    """One row per key: the latest by `order`, then by `tie`, so that reruns agree."""
    return latest_per(df, keys, F.col(order).desc_nulls_last(), *tie)


def hourly(df: DataFrame, order: str = "fetched_at", *tie: Column) -> DataFrame:
    """Timestamps floored to the hour and one row per series and hour."""
    return dedup_latest(df.withColumn(TS, F.date_trunc("hour", TS)), KEY, order, *tie)


def series_range(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(TS).alias("first"), F.max(TS).alias("last"), F.count(F.lit(1)).alias("rows")
    )


def null_rates(
    df: DataFrame, columns: Sequence[str], warn_above: float = FEATURE_NULL_WARNING
) -> DataFrame:
    """One row per column: NULL rate and whether it is above the limit. One pass over the data."""
    # count_if of zero rows is 0 and its rate NULL, which coalesces to 0.
    n = F.nullif(F.count(F.lit(1)), F.lit(0))
    wide = df.agg(*[F.coalesce(F.count_if(F.col(c).isNull()) / n, F.lit(0.0)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column_name", "null_rate").withColumn(
        "mostly_null", F.col("null_rate") > warn_above
    )


def require_rows(
    df: DataFrame, minimum: int = MIN_TRAINING_ROWS, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Per series: row count and `ok`, `insufficient_data` or (no usable value) `skipped`."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("known"))
    status = (
        F.when(F.col("known") == 0, "skipped").when(F.col("rows") < minimum, "insufficient_data").otherwise("ok")
    )
    return counted.withColumn("status", status).withColumn(
        "rows_written", F.when(F.col("status") == "ok", F.col("rows")).otherwise(F.lit(0))
    )


def long_enough(df: DataFrame, minimum: int, keys: Sequence[str] = SERIES) -> DataFrame:
    """Only the series with at least `minimum` rows."""
    enough = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") >= minimum)
    )
    return df.join(enough.select(*keys), list(keys), "left_semi")


def gap_report(
    df: DataFrame,
    now,
    keys: Sequence[str] = SERIES,
    days: int = 30,
    settle_hours: int = 3,
    absent_too: bool = True,
) -> DataFrame:
    """Gap hours per series in `[now - days, now - settle_hours]`: count and first.

    A gap is a row with a NULL value, and with `absent_too` also an hour with no row between the
    series' first row in the window and the window's end.
    """
    now = as_time(now)
    start, end = days_before(now, days), hours_before(now, settle_hours)
    recent = between_ts(df, start, end).select(*keys, TS, "value")
    gaps = recent.filter(F.col("value").isNull()).select(*keys, F.lit(1).cast("long").alias("n"), F.col(TS).alias("first"))
    if absent_too:
        hours = lambda a, b: F.floor((F.unix_seconds(b) - F.unix_seconds(a)) / 3600)
        after = F.timestamp_add("HOUR", F.lit(1), F.col("before")).alias("first")
        between = absent_spans(recent, keys).select(*keys, (hours("before", "after") - 1).alias("n"), after)
        newest = recent.groupBy(*keys).agg(F.max(F.date_trunc("hour", TS)).alias("before"))
        rest = newest.withColumn("__end", F.date_trunc("hour", end)).select(*keys, hours("before", "__end").alias("n"), after)
        gaps = gaps.unionByName(between).unionByName(rest.filter("n > 0"))
    return gaps.groupBy(*keys).agg(F.sum("n").alias("gaps"), F.min("first").alias("first_gap"))


def run_summary(
    df: DataFrame, now, run_id: str, files_found: int, files_missing: int, dry_run: bool = False
) -> DataFrame:
    """The one-row record a load run leaves: rows, NULLs, gaps, window and status."""
    whole = df.agg(
        F.count(F.lit(1)).alias("rows_ingested"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.min(TS).alias("window_start"),
        F.max(TS).alias("window_end"),
    )
    gaps = gap_report(df, now).agg(
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps_detected"), F.min("first_gap").alias("first_gap")
    )
    # Two one-row aggregates; adding them up row-wise needs no join.
    both = whole.unionByName(gaps, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(
        F.lit(run_id).alias("run_id"),
        as_time(now).alias("run_date"),
        F.when(F.col("rows_ingested") == 0, "skipped").otherwise("success").alias("status"),
        F.lit(files_found).alias("files_found"),
        F.lit(files_missing).alias("files_missing"),
        "rows_ingested", "null_count", "gaps_detected", "first_gap", "window_start", "window_end",
        F.lit(dry_run).alias("dry_run"),
    )
