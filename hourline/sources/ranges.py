"""Time ranges to fetch or to rebuild, planned as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.config import MAX_RANGE_DAYS
from hourline.functions.scalar import file_hour

_DAY = 86400


def chunk_ranges(spans: DataFrame, max_days: int = MAX_RANGE_DAYS) -> DataFrame:
    """Splits each `[start, end)` into `[chunk_start, chunk_end)` of at most `max_days` days."""
    step = max_days * _DAY
    start, end = F.unix_seconds("start"), F.unix_seconds("end")
    # Whole steps that begin before the end; a span without length has none.
    last = F.ceil((end - start) / step) - 1
    pieces = F.when(last >= 0, F.sequence(F.lit(0), last.cast("int"))).otherwise(F.array().cast("array<int>"))
    begin = F.timestamp_add("SECOND", F.col("__i") * step, F.col("start"))
    return (
        spans.withColumn("__i", F.explode(pieces))
        .withColumn("chunk_start", begin)
        .withColumn("chunk_end", F.least(F.timestamp_add("SECOND", F.lit(step), F.col("chunk_start")), F.col("end")))
        .drop("__i")
    )


def hourly_targets(spans: DataFrame) -> DataFrame:
    """Every hour in `[start, end)` with the name of its landing file."""
    last = F.timestamp_add("HOUR", F.lit(-1), F.col("end"))
    hours = F.when(
        last >= F.col("start"), F.sequence(F.col("start"), last, F.expr("interval 1 hour"))
    ).otherwise(F.array().cast("array<timestamp>"))
    return spans.withColumn("timestamp", F.explode(hours)).withColumn("file_name", file_hour("timestamp"))
