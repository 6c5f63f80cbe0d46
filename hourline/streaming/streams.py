"""The hourly path as streams: landing files, late duplicates, hourly sums, flag runs, upsert sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hourline.functions.exact import exact_sum
from hourline.operators.quality import dedup_latest
from hourline.operators.slices import SERIES, TS
from hourline.session import remove, scratch_path
from hourline.sources.upsert import merge_into
from hourline.sources.versions import expire, merge_version

HOUR_MS = 3_600_000


def landing_stream(
    spark: SparkSession,
    directory: str,
    schema: T.StructType,
    archive_dir: str | None = None,
    max_files: int | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Landing files as they arrive. With `archive_dir`, files of finished batches are moved there."""
    reader = spark.readStream.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(directory)


def dedup_within(df: DataFrame, lateness: str, keys: Sequence[str] = (*SERIES, TS), ts: str = TS) -> DataFrame:
    """The first row of each key; its state is dropped once the watermark has passed."""
    return df.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def hourly_load(
    events: DataFrame, lateness: str, ts: str = "ts", value: str = "value", series: Column | str = "series_id"
) -> DataFrame:
    """Events to one row per series and closed hour. Rows later than the watermark are dropped, and
    counted by the query's progress (`late_rows`)."""
    key = F.col(series) if isinstance(series, str) else series
    return (
        events.withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 hour").alias("hour"), key.alias("series_id"))
        .agg(exact_sum(value).alias("value"), F.count(F.lit(1)).alias("events"))
        .select("series_id", F.col("hour.start").alias(TS), "value", "events")
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows every stateful operator of the finished batches dropped for being late."""
    return sum(
        int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"]
    )


RUN_STATE = T.StructType([
    T.StructField("last_ms", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("waiting_ms", T.ArrayType(T.LongType())), T.StructField("waiting_flag", T.ArrayType(T.BooleanType())),
])
RUN_OUTPUT = T.StructType([
    T.StructField("series_id", T.StringType()), T.StructField("check_timestamp", T.TimestampType()),
    T.StructField("consecutive", T.IntegerType()),
])


def _counted(times: pd.Series, flags: pd.Series, last: int, length: int, contiguous: bool) -> pd.Series:
    """Lengths of the runs of true flags that the checks end, in time order, after a run of `length` that ended at `last`."""
    broken = ~flags
    if contiguous:
        first = times.iloc[0] if last < 0 else last + HOUR_MS
        broken = broken | (times.diff().fillna(times.iloc[0] - first + HOUR_MS) != HOUR_MS)
    run = broken.cumsum()
    # Within a run the count restarts; a run that starts with a true flag counts that flag.
    return flags.groupby(run).cumsum() + (run == 0) * length


def _advance(contiguous: bool) -> Callable:
    def step(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterable[pd.DataFrame]:
        last, length, waiting_ms, waiting_flag = state.get if state.exists else (-1, 0, [], [])
        kept = pd.DataFrame({"check_ms": pd.Series(list(waiting_ms), dtype="int64"), "flag": pd.Series(list(waiting_flag), dtype=bool)})
        fresh = [] if state.hasTimedOut else [b[["check_ms", "flag"]] for b in batches]
        rows = pd.concat([kept, *fresh], ignore_index=True)
        rows["flag"] = rows["flag"].fillna(False).astype(bool)
        # Of repeated checks a false flag stands; one at or before the newest counted check is a replay.
        rows = rows.sort_values(["check_ms", "flag"], kind="stable").drop_duplicates("check_ms")
        rows = rows[rows["check_ms"] > last]
        closed = rows["check_ms"] < state.getCurrentWatermarkMs()
        ready, rest = rows[closed].reset_index(drop=True), rows[~closed]
        if len(ready):
            counted = _counted(ready["check_ms"], ready["flag"], last, length, contiguous)
            last, length = int(ready["check_ms"].iloc[-1]), int(counted.iloc[-1])
        state.update((last, length, rest["check_ms"].tolist(), rest["flag"].tolist()))
        if len(rest):
            state.setTimeoutTimestamp(int(rest["check_ms"].iloc[0]))
        if len(ready):
            yield pd.DataFrame({
                "series_id": key[0], "check_timestamp": pd.to_datetime(ready["check_ms"].to_numpy(), unit="ms"),
                "consecutive": counted.astype("int32").to_numpy(),
            })

    return step


def consecutive_stream(
    checks: DataFrame, flag: str = "any_drift_detected", contiguous: bool = False, lateness: str = "1 day"
) -> DataFrame:
    """For every check, the length of the run of true flags it ends, in whatever order checks arrive.

    A check waits in state until the watermark, `lateness` behind the newest check of all series, has passed it; then no
    earlier one can come, and it is counted in time order. State per series: the run so far and the waiting checks, those
    of one lateness span. A replayed check counts once. Checks later than the watermark are not counted; the
    query's progress has their number (`late_rows`).
    """
    rows = checks.withWatermark("check_timestamp", lateness).select(
        "series_id", "check_timestamp", F.unix_millis("check_timestamp").alias("check_ms"), F.col(flag).alias("flag"))
    return rows.groupBy("series_id").applyInPandasWithState(
        _advance(contiguous), RUN_OUTPUT, RUN_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def upsert_sink(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    checkpoint: str,
    update: str | Sequence[str] | None = "all",
    when: Column | str | None = None,
    order: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Upserts every micro-batch. Its staging folder is named by the batch: a batch that is run again
    after a failure publishes the merged rows it had staged, or merges them if it had not got so far. The
    folder of the batch before is no longer needed then, and removed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = dedup_latest(batch, [*partition_by, *keys], order) if order else batch
        merge_into(path, rows, keys, partition_by, update, when, staged=f"{checkpoint}/staged/{batch_id}")
        remove(batch.sparkSession, f"{checkpoint}/staged/{batch_id - 1}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/offsets")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def versioned_sink(
    stream: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    checkpoint: str,
    update: str | Sequence[str] | None = "all",
    when: Column | str | None = None,
    order: str | None = None,
    available_now: bool = True,
    keep: int = 10,
) -> StreamingQuery:
    """Upserts every micro-batch as a version of a versioned table: readers see whole batches alone, and a batch that is run
    again after its commit writes nothing. Versions before the newest `keep` go, with rows of failed batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = dedup_latest(batch, [*partition_by, *keys], order) if order else batch
        merge_version(path, rows, keys, partition_by, update, when, writer=(checkpoint, batch_id))
        expire(batch.sparkSession, path, keep)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/offsets")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> tuple[DataFrame, StreamingQuery]:
    """Runs the stream over everything there is now into a table in the shared folder."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/rows"), query
