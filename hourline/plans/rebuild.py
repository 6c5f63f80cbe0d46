"""Features for a part of the table, or for all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourline.config import CENTERED_ROWS, LAG_HOURS, REBUILD_CHUNK_DAYS, FeatureOptions
from hourline.functions.scalar import as_time, hours_before
from hourline.operators.project import between_ts
from hourline.operators.slices import SERIES, TS, seconds
from hourline.plans.features import build_features, halo
from hourline.session import written


def build_window(
    load: DataFrame,
    weather: DataFrame | None,
    start,
    end,
    overlap_hours: int = max(LAG_HOURS),
    ahead_hours: int = CENTERED_ROWS,
    options: FeatureOptions = FeatureOptions(),
    built_at: Column | None = None,
) -> DataFrame:
    """Features of the hours from start to end, reading `overlap_hours` before and `ahead_hours` after.

    The overlap rows are dropped: their lags are incomplete, and upserting them would replace good
    values. Series with many gaps need a longer overlap for the statistics that count rows.
    """
    start, end = as_time(start), as_time(end)
    first, last = hours_before(start, overlap_hours), hours_before(end, -ahead_hours)
    rows = between_ts(load, first, last)
    side = None if weather is None else between_ts(weather, first, last)
    return between_ts(build_features(rows, side, options, built_at), start, end)


def rebuild(
    load: DataFrame,
    weather: DataFrame | None = None,
    chunk_days: int = REBUILD_CHUNK_DAYS,
    options: FeatureOptions = FeatureOptions(min_rows=0),
    built_at: Column | None = None,
) -> DataFrame:
    """Features of the whole table with `chunk_start`, the chunk of days a row belongs to.

    Slices overlap by rows, so all chunks are built in one job and none has an edge that shows; the
    chunk is what a writer partitions or restarts by.
    """
    built = build_features(load, weather, options, built_at)
    first = load.agg(F.unix_seconds(F.date_trunc("day", F.min("timestamp")))).scalar()
    step = chunk_days * 86400
    age = F.unix_seconds("timestamp") - F.col("__first")
    begin = F.timestamp_seconds(F.col("__first") + F.floor(age / step) * step)
    return built.withColumn("__first", first).withColumn("chunk_start", begin).drop("__first")


BLOCK = "__rebuild_block"


def block_of(block_hours: int, ts: str = TS) -> Column:
    return F.floor(seconds(ts) / (3600 * block_hours))


def dirty_blocks(
    load: DataFrame, changed: DataFrame, options: FeatureOptions = FeatureOptions(min_rows=0), block_hours: int = 168
) -> DataFrame:
    """Blocks of hours per series (`series_id`, `__rebuild_block`, `rows`), each with `dirty`: some row of it can have other features
    after the changes; and `needed`: its rows are inputs of such a row. Other blocks are left out.

    Features look back and ahead by rows, so what a change reaches is found along the row counts of the blocks, gaps or not. The
    counts are one aggregate of the keys of the series that have changes; windows run over blocks, not over rows.
    """
    back, ahead = halo(options)
    touched = changed.select(*SERIES, block_of(block_hours).alias(BLOCK)).distinct().withColumn("__hit", F.lit(True))
    mine = load.join(changed.select(*SERIES).distinct(), list(SERIES), "left_semi")
    counts = mine.groupBy(*SERIES, block_of(block_hours).alias(BLOCK)).agg(F.count(F.lit(1)).alias("rows"))
    blocks = counts.join(touched, [*SERIES, BLOCK], "full_outer").withColumn("rows", F.coalesce("rows", F.lit(0)))
    along = Window.partitionBy(*SERIES).orderBy(BLOCK)
    until = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = along.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    blocks = blocks.withColumn("__end", F.sum("rows").over(until)).withColumn("__start", F.col("__end") - F.col("rows"))

    def reached(mark: Column, after: int, before: int) -> Column:
        """Within `after` rows behind a marked block, or `before` rows ahead of one, or marked."""
        last = F.max(F.when(mark, F.col("__end"))).over(until)
        following = F.min(F.when(mark, F.col("__start"))).over(onward)
        return F.coalesce(F.col("__start") < last + after, F.lit(False)) | F.coalesce(F.col("__end") > following - before, F.lit(False)) | mark

    hit = F.coalesce("__hit", F.lit(False))
    out = blocks.withColumn("dirty", reached(hit, back, ahead))
    out = out.withColumn("needed", reached(F.col("dirty"), ahead, back))
    return out.filter("needed").select(*SERIES, BLOCK, "rows", "dirty", "needed")


def rebuild_changed(
    features: DataFrame,
    load: DataFrame,
    weather: DataFrame | None,
    changed: DataFrame,
    changed_weather: DataFrame | None = None,
    options: FeatureOptions = FeatureOptions(min_rows=0),
    built_at: Column | None = None,
    block_hours: int = 168,
) -> DataFrame:
    """The matrix after changes of its inputs: only blocks that a change can reach are built again, the others are kept.

    `features` is the matrix before; `load` and `weather` are the inputs now. `changed` has the keys (series_id, timestamp) of load rows
    that were inserted, updated or deleted, as a change feed names them; `changed_weather` the timestamps of changed weather, which
    count for every series with a row then. The result equals building the whole matrix anew.
    """
    keys = changed.select(*SERIES, TS)
    if changed_weather is not None:
        hours = changed_weather.select(TS).distinct()
        keys = keys.unionByName(load.select(*SERIES, TS).join(hours, TS, "left_semi"))
    blocks = written(dirty_blocks(load, keys, options, block_hours), "dirty-blocks")
    place = block_of(block_hours)
    by = [*SERIES, BLOCK]
    inputs = load.withColumn(BLOCK, place).join(blocks.select(*by), by, "left_semi").drop(BLOCK)
    built = build_features(inputs, weather, options, built_at).withColumn(BLOCK, place)
    dirty = blocks.filter("dirty").select(*by)
    kept = features.withColumn(BLOCK, place).join(dirty, by, "left_anti")
    return kept.unionByName(built.join(dirty, by, "left_semi")).drop(BLOCK)
