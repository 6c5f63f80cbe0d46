"""The streaming operators over the event files."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline import schemas
from hourline.session import scratch_path
from hourline.sources import tables, versions
from hourline.streaming import streams
from hourline.workload.base import CHECKS, LOAD, checks, query, sql, table
from hourline.workload.storage import landed


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withColumnRenamed("event_type", "series_id")


@query(
    "st3_hourly_load_stream",
    """SELECT event_type AS series_id, date_trunc('hour', ts) AS "timestamp", CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS value, count(*) AS events
       FROM events GROUP BY 1, 2
       HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
)
def hourly_stream(spark, sf):
    """Hours the watermark has closed: those that end ten minutes before the newest event."""
    rows, _ = streams.run_to_table(streams.hourly_load(event_stream(spark, sf), "10 minutes"), "hourly")
    return rows


@query(
    "st2_dedup_stream",
    """SELECT DISTINCT event_type AS series_id, user_id FROM events""",
)
def dedup_stream(spark, sf):
    """One row per series and user: the whole month is within the lateness bound."""
    unique = streams.dedup_within(event_stream(spark, sf), "40 days", ["series_id", "user_id"], ts="ts")
    rows, _ = streams.run_to_table(unique.select("series_id", "user_id"), "unique")
    return rows


@query(
    "st1_st5_landing_to_table",
    sql(LOAD, """SELECT "timestamp", series_id, value, 'feed' AS source, "timestamp" AS fetched_at, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day FROM load"""),
)
def landing_to_table(spark, sf):
    """Landing files to a merged table through a stream, in several micro-batches."""
    base = scratch_path(spark, "landing-stream")
    landed(spark, sf, f"{base}/landing")
    stream = streams.landing_stream(spark, f"{base}/landing/*/*", schemas.LANDING_LOAD, max_files=100)
    query = streams.upsert_sink(
        tables.with_day(stream), f"{base}/table", ["series_id", "timestamp"], ["day"], f"{base}/checkpoint",
        when="value IS NOT NULL", order="fetched_at",
    )
    query.awaitTermination()
    schema = tables.with_day(spark.createDataFrame([], schemas.LANDING_LOAD)).schema
    return tables.read_table(spark, f"{base}/table", schema)


@query(
    "st5_versioned_sink",
    sql(LOAD, """SELECT "timestamp", series_id, value, 'feed' AS source, "timestamp" AS fetched_at, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day FROM load"""),
)
def landing_to_versions(spark, sf):
    """Landing files to a versioned table, a version for each micro-batch."""
    base = scratch_path(spark, "landing-versions")
    landed(spark, sf, f"{base}/landing")
    stream = streams.landing_stream(spark, f"{base}/landing/*/*", schemas.LANDING_LOAD, max_files=100)
    streams.versioned_sink(
        tables.with_day(stream), f"{base}/table", ["series_id", "timestamp"], ["day"], f"{base}/checkpoint",
        when="value IS NOT NULL", order="fetched_at",
    ).awaitTermination()
    schema = tables.with_day(spark.createDataFrame([], schemas.LANDING_LOAD)).schema
    return versions.read_version(spark, f"{base}/table", schema, ["day"])


@query(
    "st4_consecutive_stream",
    sql(CHECKS, """SELECT series_id, check_timestamp, CAST(count(*) FILTER (any_drift_detected) OVER (PARTITION BY series_id, breaks ORDER BY check_timestamp) AS INTEGER) AS consecutive
      FROM (SELECT *, count(*) FILTER (NOT any_drift_detected) OVER (PARTITION BY series_id ORDER BY check_timestamp) AS breaks FROM checks)
      WHERE check_timestamp < (SELECT max(check_timestamp) FROM checks) - INTERVAL 2 DAY"""),
)
def consecutive(spark, sf):
    """The run of drift flags at every check that the watermark has passed, two days behind the newest one; the files hold
    the checks in no order."""
    path = scratch_path(spark, "checks")
    checks(spark, sf).select("series_id", "check_timestamp", "any_drift_detected").repartition(4).write.parquet(path)
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).parquet(path)
    rows, _ = streams.run_to_table(streams.consecutive_stream(stream, lateness="2 days"), "runs")
    return rows
