"""Scalar expressions: identifiers, times, buckets, guarded arithmetic and reason texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ssxxx"
FILE_HOUR_PATTERN = "yyyy-MM-dd'T'HH-mm-ss'Z'"


def as_time(now: Column | str | dt.datetime) -> Column:
    """The reference time of a report: always a parameter, never the clock."""
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def iso(ts: Column | str) -> Column:
    return F.date_format(ts, ISO_PATTERN)


def file_hour(ts: Column | str) -> Column:
    """Name of the landing file of an hour."""
    return F.concat(F.date_format(ts, FILE_HOUR_PATTERN), F.lit(".json"))


def parse_utc(text: Column | str) -> Column:
    return F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ssX")


def forecast_id(model: Column | str, horizon: Column | str, ts: Column | str) -> Column:
    return F.md5(F.concat_ws("_", model, horizon, iso(ts)))


def promotion_id(model: Column | str, run: Column | str, ts: Column | str) -> Column:
    return F.md5(F.concat_ws("_", model, run, iso(ts)))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Whole hours from start to end, rounded towards zero."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    return F.timestamp_diff("HOUR", start, end)


def hours_before(now: Column, hours: int) -> Column:
    return now - F.make_dt_interval(F.lit(0), F.lit(hours))


def days_before(now: Column, days: int) -> Column:
    return now - F.make_dt_interval(F.lit(days))


def ratio_pct(part: Column, whole: Column) -> Column:
    """part / whole in percent; NULL when the whole is zero."""
    return part / F.nullif(whole, F.lit(0.0)) * 100


def clip_at_zero(value: Column | str) -> Column:
    return F.greatest(value, F.lit(0.0))


def join_names(names: Column | str) -> Column:
    return F.concat_ws(",", names)


def split_names(text: Column | str, empty: str = "none") -> Column:
    """The names of a comma-joined list; one placeholder when the list is empty."""
    text = F.col(text) if isinstance(text, str) else text
    missing = text.isNull() | (text == "")
    return F.when(missing, F.array(F.lit(empty))).otherwise(F.split(text, ","))


def health_status(hours: Column) -> Column:
    return F.when(hours < 2, "HEALTHY").when(hours < 6, "WARNING").otherwise("CRITICAL")


def model_age(days: Column) -> Column:
    return (
        F.when(days > 30, "STALE — consider retraining").when(days > 14, "AGING").otherwise("FRESH")
    )


def decision_label(first_run: Column, promoted: Column) -> Column:
    return F.when(first_run, "FIRST RUN").when(promoted, "PROMOTED").otherwise("SKIPPED")


def decision_icon(first_run: Column, promoted: Column) -> Column:
    return F.when(first_run, "🆕").when(promoted, "✅").otherwise("⏭️")


def percent_text(value: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", value * 100)


def number_text(value: Column, digits: int = 3) -> Column:
    return F.format_string(f"%.{digits}f", value)
