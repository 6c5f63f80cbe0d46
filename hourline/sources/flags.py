"""Retrain flags as rows: raised by drift checks, consumed by a promotion run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.functions.scalar import as_time, iso

VERSION = "1.0"


def pending_flags(flags: DataFrame, consumed: DataFrame) -> DataFrame:
    return flags.join(consumed.select("flag_id"), "flag_id", "left_anti")


def raise_flags(decisions: DataFrame, pending: DataFrame) -> DataFrame:
    """Flag rows of the triggered decisions, unless the series already has one pending."""
    triggered = decisions.filter("retrain_triggered").join(pending.select("series_id"), "series_id", "left_anti")
    return triggered.select(
        F.md5(F.concat_ws("_", "series_id", iso("check_timestamp"))).alias("flag_id"),
        "series_id",
        F.col("check_timestamp").alias("triggered_at"),
        "reason",
        "consecutive_drift_hours",
        F.split("drifted_features", ",").alias("drifted_features"),
        F.lit(VERSION).alias("version"),
    )


def consume_flags(pending: DataFrame, now) -> DataFrame:
    """Consumption rows to append; once they are written, their flags are no longer pending."""
    return pending.select("flag_id", as_time(now).alias("consumed_at"))
