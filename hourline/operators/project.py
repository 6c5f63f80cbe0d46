"""Projections, filters and column contracts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.functions.scalar import as_time
from hourline.operators.slices import SERIES, TS


DAY = "day"


def prune_days(df: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    """Bounds on the partition column of a stored hourly table, where the frame has it.

    A bound on the timestamp skips row groups; the same bound on the day skips whole directories.
    """
    if DAY not in df.columns:
        return df
    if start is not None:
        df = df.filter(F.col(DAY) >= F.to_date(start))
    return df if end is None else df.filter(F.col(DAY) <= F.to_date(end))


def between_ts(df: DataFrame, start, end, ts: str = TS) -> DataFrame:
    """Rows from start to end, both included. Bounds are literals, so they reach the scan."""
    start, end = as_time(start), as_time(end)
    pruned = prune_days(df, start, end) if ts == TS else df
    return pruned.filter(F.col(ts).between(start, end))


def since_ts(df: DataFrame, start: Column, ts: str = TS) -> DataFrame:
    pruned = prune_days(df, start, None) if ts == TS else df
    return pruned.filter(F.col(ts) >= start)


def scan_window(
    df: DataFrame, start, end, series: str | Sequence[str] | None = None, columns: Sequence[str] = ()
) -> DataFrame:
    """Time-bounded scan, optionally of some series and some columns only."""
    out = between_ts(df, start, end)
    if series is not None:
        wanted = [series] if isinstance(series, str) else list(series)
        out = out.filter(F.col("series_id").isin(wanted))
    return out.select(*columns) if columns else out


def stamp_load(df: DataFrame, run_id: str) -> DataFrame:
    """Bronze columns of a load row: the run that brought it, and whether it is a gap."""
    return (
        df.filter(F.col(TS).isNotNull())
        .withColumns({"run_id": F.lit(run_id), "is_gap": F.col("value").isNull()})
    )


def stamp_weather(df: DataFrame, run_id: str) -> DataFrame:
    return (
        df.filter(F.col(TS).isNotNull())
        .withColumn("run_id", F.lit(run_id))
        .fillna({"is_weather_imputed": False})
    )


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema`, in its order and types; raises on a missing one."""
    require_columns(df, schema.fieldNames())
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def align_features(df: DataFrame, trained: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """The keys plus the trained features that exist; also the missing and the surplus names."""
    have = set(df.columns)
    keys = [c for c in (*SERIES, TS) if c in have]
    missing = [c for c in trained if c not in have]
    extra = [c for c in df.columns if c not in trained and c not in keys]
    return df.select(*keys, *[c for c in trained if c in have]), missing, extra


def not_yet_run(candidates: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Candidates whose key has no row in `done`; appending only these makes a retry harmless."""
    return candidates.join(done.select(*on), list(on), "left_anti")


def already_ran(done: DataFrame, check_time: Column, column: str = "check_timestamp") -> DataFrame:
    """One row, `already_ran`: whether a check of this hour exists. Stops at the first hit."""
    hit = done.filter(F.col(column) == check_time).select(F.lit(True).alias("hit")).limit(1)
    return hit.agg((F.count("hit") > 0).alias("already_ran"))


def with_known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))
