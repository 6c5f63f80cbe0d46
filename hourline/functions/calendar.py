"""Calendar features of the local hour, and the holiday dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline.config import EASTER_HOLIDAYS, EPOCH_DAY, FIXED_HOLIDAYS, TIMEZONE

FIRST_YEAR, LAST_YEAR = 1970, 2100


def local_time(ts: Column | str, timezone: str = TIMEZONE) -> Column:
    return F.from_utc_timestamp(ts, timezone)


def floor_hour(ts: Column | str) -> Column:
    return F.date_trunc("hour", ts)


def days_since_epoch(ts: Column | str, epoch: str = EPOCH_DAY) -> Column:
    """Whole UTC days since the epoch, rounded down."""
    return F.datediff(ts, F.lit(epoch).cast("date"))


def easter_sunday(years: DataFrame) -> DataFrame:
    """Adds `easter` to a frame with `year`: the anonymous Gregorian computus in whole numbers."""
    steps = [
        ("a", "year % 19"),
        ("b", "year div 100"),
        ("c", "year % 100"),
        ("h", "(19 * a + b - b div 4 - (b - (b + 8) div 25 + 1) div 3 + 15) % 30"),
        ("l", "(32 + 2 * (b % 4) + 2 * (c div 4) - h - c % 4) % 7"),
        ("m", "(a + 11 * h + 22 * l) div 451"),
        ("s", "h + l - 7 * m + 114"),
    ]
    out = years
    for name, formula in steps:
        out = out.withColumn(name, F.expr(formula))
    easter = F.expr("make_date(year, cast(s div 31 as int), cast(s % 31 + 1 as int))")
    return out.withColumn("easter", easter).drop(*[name for name, _ in steps])


def easter_of(year: Column) -> Column:
    """Easter Sunday of a year, any year of the Gregorian calendar."""
    a, b, c = year % 19, F.floor(year / 100), year % 100
    h = (19 * a + b - F.floor(b / 4) - F.floor((b - F.floor((b + 8) / 25) + 1) / 3) + 15) % 30
    k = (32 + 2 * (b % 4) + 2 * F.floor(c / 4) - h - c % 4) % 7
    s = h + k - 7 * F.floor((a + 11 * h + 22 * k) / 451) + 114
    return F.make_date(year, F.floor(s / 31).cast("int"), (s % 31 + 1).cast("int"))


def is_public_holiday(
    date: Column,
    fixed: Sequence[tuple[int, int]] = FIXED_HOLIDAYS,
    movable: Sequence[tuple[int, int]] = EASTER_HOLIDAYS,
) -> Column:
    """Whether the rules make a date a holiday, in any year; NULL is none. No dimension and no join."""
    year, gap = F.year(date), F.datediff(date, easter_of(F.year(date)))
    hit = (F.month(date) * 100 + F.dayofmonth(date)).isin([m * 100 + d for m, d in fixed])
    for days, since in movable:
        hit = hit | ((gap == days) & (year >= since))
    return F.coalesce(hit, F.lit(False))


def holiday_dim(
    spark: SparkSession,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    fixed: Sequence[tuple[int, int]] = FIXED_HOLIDAYS,
    movable: Sequence[tuple[int, int]] = EASTER_HOLIDAYS,
    extra: DataFrame | None = None,
) -> DataFrame:
    """One row per holiday date. `extra` (column `holiday_date`) adds days the rules cannot know.

    Size is known beforehand: years times rules, 1,703 rows with the defaults.
    """
    years = spark.range(first_year, last_year + 1, 1, 1).select(F.col("id").cast("int").alias("year"))
    pairs = F.array(*[F.struct(F.lit(m).alias("month"), F.lit(d).alias("day")) for m, d in fixed])
    dates = years.select("year", F.explode(pairs).alias("rule")).select(
        F.make_date("year", F.col("rule.month"), F.col("rule.day")).alias("holiday_date")
    )
    offsets = F.array(*[F.struct(F.lit(o).alias("days"), F.lit(y).alias("since")) for o, y in movable])
    moving = (
        easter_sunday(years)
        .select("year", "easter", F.explode(offsets).alias("rule"))
        .filter(F.col("year") >= F.col("rule.since"))
        .select(F.date_add("easter", F.col("rule.days")).alias("holiday_date"))
    )
    days = dates.union(moving)
    if extra is not None:
        days = days.union(extra.select("holiday_date"))
    return days.distinct()


def mark_holidays(df: DataFrame, date_column: str, name: str, extra: DataFrame | None = None) -> DataFrame:
    """Adds the boolean `name`: by the rules, or a day of `extra` (column `holiday_date`), which is joined."""
    if extra is None:
        return df.withColumn(name, is_public_holiday(F.col(date_column)))
    days = extra.select(F.col("holiday_date").alias("__holiday")).distinct()
    joined = df.join(days, F.col(date_column) == F.col("__holiday"), "left")
    return joined.withColumn(name, F.col("__holiday").isNotNull() | is_public_holiday(F.col(date_column))).drop("__holiday")


def add_calendar(
    df: DataFrame,
    timezone: str = TIMEZONE,
    eve_mode: str = "row",
    extra_holidays: DataFrame | None = None,
    ts: str = "timestamp",
) -> DataFrame:
    """Hour, weekday (Monday 0), month, quarter, weekend and holiday of the local hour; days since epoch.

    With `eve_mode="day"` also `is_holiday_eve`: the next calendar day is a holiday or on a weekend.
    The default eve looks one row ahead and is a window operator (`operators.windows`).
    """
    if eve_mode not in ("row", "day"):
        raise ValueError(f"eve_mode must be 'row' or 'day', not {eve_mode!r}")
    out = df.withColumn("__local", local_time(ts, timezone)).withColumns(
        {
            "hour_of_day": F.hour("__local"),
            "day_of_week": F.weekday("__local"),
            "month": F.month("__local"),
            "quarter": F.quarter("__local"),
            "days_since_epoch": days_since_epoch(ts),
            "__date": F.to_date("__local"),
        }
    )
    out = out.withColumn("is_weekend", F.col("day_of_week") >= 5)
    out = mark_holidays(out, "__date", "is_holiday", extra_holidays)
    if eve_mode == "day":
        out = out.withColumn("__next", F.date_add("__date", 1))
        out = mark_holidays(out, "__next", "__next_holiday", extra_holidays)
        out = out.withColumn(
            "is_holiday_eve", F.col("__next_holiday") | (F.weekday("__next") >= 5)
        ).drop("__next", "__next_holiday")
    return out.drop("__local", "__date")
