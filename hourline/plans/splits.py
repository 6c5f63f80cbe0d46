"""Holdouts and cross-validation folds along time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.config import CV_FOLDS, CV_GAP, CV_TEST, TEST_DAYS, VAL_DAYS
from hourline.functions.scalar import days_before
from hourline.operators.slices import SERIES, TS, with_position


def holdout_split(
    df: DataFrame, val_days: int = VAL_DAYS, test_days: int = TEST_DAYS, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Adds `split`: the newest `test_days` are test, the `val_days` before them val, the rest train.

    With `val_days=0` it is the two-way holdout. The newest hour of each series is one aggregated row,
    joined back, so no series has to sit in one task. With no `keys` the newest hour is the table's.
    """
    newest = F.max(TS).alias("__last")
    if keys:
        out = df.join(df.groupBy(*keys).agg(newest), list(keys))
    else:
        out = df.withColumn("__last", df.agg(newest).scalar())
    ts, last = F.col(TS), F.col("__last")
    split = (
        F.when(ts <= days_before(last, val_days + test_days), "train")
        .when(ts <= days_before(last, test_days), "val")
        .otherwise("test")
    )
    return out.withColumn("split", split).drop("__last")


def rows_needed(folds: int = CV_FOLDS, gap: int = CV_GAP, test: int = CV_TEST) -> int:
    return folds * (test + gap) + test


def ts_folds(
    df: DataFrame, folds: int = CV_FOLDS, gap: int = CV_GAP, test: int = CV_TEST,
    keys: Sequence[str] = SERIES, strict: bool = True,
) -> DataFrame:
    """One copy of a row per fold that uses it, with `fold` (from 0) and `role` (`train` or `test`).

    Each fold tests `test` rows, leaves out the `gap` rows before them and trains on all rows before
    the gap. A series that is too short is an error, or with `strict=False` is left out.
    """
    need = rows_needed(folds, gap, test)
    placed = with_position(df, "__pos", keys, total="__total")
    enough = F.col("__total") >= need
    if strict:
        text = F.format_string(f"{folds} folds need {need} rows, a series has %d", F.col("__total"))
        enough = F.when(enough, True).otherwise(F.raise_error(text).cast("boolean"))
    placed = placed.filter(enough)
    copies = placed.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(folds)])))
    end = F.col("__total") - (folds - 1 - F.col("fold")) * (test + gap)
    start, index = end - test, F.col("__pos") - 1
    role = F.when(index < start - gap, "train").when((index >= start) & (index < end), "test")
    return copies.withColumn("role", role).filter(F.col("role").isNotNull()).drop("__pos", "__total")
