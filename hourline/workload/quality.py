"""Scans, filters, data quality and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.operators import project, quality, windows
from hourline.operators.joins import join_weather
from hourline.sources import ranges
from hourline.workload.base import LOAD, NOW, NOW_SQL, WEATHER, events, load, query, sql, table, weather

QUALITY = "rows, nulls, CASE WHEN rows > 0 THEN nulls / rows ELSE 0.0 END AS null_rate, rows > 0 AND nulls / rows > 0.1 AS high_gap_rate"


@query(
    "s05_p01_scan_window",
    """SELECT event_id, event_type, value FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-17 00:00:00'""",
)
def scan(spark, sf):
    raw = table(spark, sf, "events")
    bounds = [F.lit(d).cast("timestamp_ntz") for d in ("2024-01-10", "2024-01-17")]
    return project.between_ts(raw, *bounds, ts="ts").select("event_id", "event_type", "value")


@query(
    "p02_p05_filters",
    sql(LOAD, """SELECT *, value IS NULL AS is_gap FROM load
      WHERE series_id LIKE '%ck%' AND value IS NOT NULL AND NOT (hour("timestamp") = 3) OR series_id = 'view'"""),
)
def filters(spark, sf):
    at_three = F.hour("timestamp") == 3
    return (
        load(spark, sf)
        .filter((F.col("series_id").like("%ck%") & F.col("value").isNotNull() & ~at_three) | (F.col("series_id") == "view"))
        .withColumn("is_gap", F.col("value").isNull())
    )


@query(
    "p06_stamped_load",
    sql(LOAD, "SELECT *, 'run-1' AS run_id, value IS NULL AS is_gap FROM load"),
)
def stamped(spark, sf):
    return project.stamp_load(load(spark, sf), "run-1")


@query(
    "p06_stamped_weather",
    sql(WEATHER, "SELECT *, 'run-1' AS run_id FROM weather"),
)
def stamped_weather(spark, sf):
    flag = F.when(F.col("temperature").isNotNull(), F.lit(False))
    return project.stamp_weather(weather(spark, sf).withColumn("is_weather_imputed", flag), "run-1")


@query(
    "p07_p10_column_contracts",
    sql(LOAD, 'SELECT "timestamp", series_id, CAST(value AS FLOAT) AS value FROM load'),
)
def contracts(spark, sf):
    rows = load(spark, sf).withColumn("surplus", F.lit(1))
    aligned, _, _ = project.align_features(rows, ["value", "absent"])
    schema = T.StructType().add("timestamp", "timestamp").add("series_id", "string").add("value", "float")
    return project.conform(aligned, schema)


@query(
    "p09_rows_with_known_inputs",
    sql(f"{LOAD}, {WEATHER}", """SELECT series_id, "timestamp", value, temperature FROM load LEFT JOIN weather USING ("timestamp")
      WHERE value IS NOT NULL AND temperature IS NOT NULL"""),
)
def known(spark, sf):
    joined = join_weather(load(spark, sf), weather(spark, sf))
    return project.with_known(joined, ("value", "temperature")).select("series_id", "timestamp", "value", "temperature")


@query(
    "p11_run_guard",
    sql(LOAD, f"""SELECT series_id, "timestamp" FROM load
      ANTI JOIN (SELECT series_id, "timestamp" FROM load WHERE value IS NOT NULL) done USING (series_id, "timestamp")"""),
)
def guard(spark, sf):
    rows = load(spark, sf)
    return project.not_yet_run(rows.select("series_id", "timestamp"), rows.filter("value IS NOT NULL"), ["series_id", "timestamp"])


@query(
    "p14_data_sufficiency",
    sql(LOAD, """SELECT *, CASE WHEN status = 'ok' THEN rows ELSE 0 END AS rows_written FROM (
      SELECT series_id, count(*) AS rows, count(value) AS known,
        CASE WHEN count(value) = 0 THEN 'skipped' WHEN count(*) < 680 THEN 'insufficient_data' ELSE 'ok' END AS status
      FROM load GROUP BY 1)"""),
)
def sufficiency(spark, sf):
    return quality.require_rows(load(spark, sf), 680)


@query(
    "a01_load_quality",
    sql(LOAD, f"SELECT series_id, {QUALITY} FROM (SELECT series_id, count(*) AS rows, count(*) - count(value) AS nulls FROM load GROUP BY 1)"),
)
def load_quality(spark, sf):
    return quality.load_quality(load(spark, sf), ["series_id"])


@query(
    "a02_duplicate_keys",
    "SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS copies FROM events GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicates(spark, sf):
    rows = events(spark, sf).withColumn("hour", F.date_trunc("hour", "ts"))
    return quality.duplicate_keys(rows, ["event_type", "hour"])


@query(
    "a03_dedup_latest",
    """SELECT event_type AS series_id, date_trunc('hour', ts) AS "timestamp", value, ts AS fetched_at FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id) = 1""",
)
def dedup(spark, sf):
    rows = events(spark, sf).select(
        F.col("event_type").alias("series_id"), F.col("ts").alias("timestamp"), "value", F.col("ts").alias("fetched_at"), "event_id"
    )
    return quality.hourly(rows, "fetched_at", F.col("event_id")).drop("event_id")


@query(
    "a04_series_range",
    sql(LOAD, 'SELECT series_id, min("timestamp") AS first, max("timestamp") AS last, count(*) AS rows FROM load GROUP BY 1'),
)
def series_range(spark, sf):
    return quality.series_range(load(spark, sf))


@query(
    "a05_null_rates",
    sql(f"{LOAD}, {WEATHER}, j AS (SELECT * FROM load LEFT JOIN weather USING (\"timestamp\"))", """
      SELECT column_name, null_rate, null_rate > 0.5 AS mostly_null FROM (
        SELECT unnest(['value', 'temperature', 'humidity', 'cloud_cover']) AS column_name,
               unnest([1 - count(value) / count(*), (count(*) - count(temperature)) / count(*),
                       (count(*) - count(humidity)) / count(*), (count(*) - count(cloud_cover)) / count(*)]) AS null_rate FROM j)"""
        .replace("1 - count(value) / count(*)", "(count(*) - count(value)) / count(*)")),
)
def null_rates(spark, sf):
    joined = join_weather(load(spark, sf), weather(spark, sf))
    return quality.null_rates(joined, ["value", "temperature", "humidity", "cloud_cover"])


GAPS = f"""{LOAD},
recent AS (SELECT * FROM load WHERE "timestamp" BETWEEN {NOW_SQL} - INTERVAL 30 DAY AND {NOW_SQL} - INTERVAL 3 HOUR),
grid AS (SELECT series_id, unnest(generate_series(min("timestamp"), {NOW_SQL} - INTERVAL 3 HOUR, INTERVAL 1 HOUR)) AS "timestamp" FROM recent GROUP BY 1),
gaps AS (SELECT series_id, "timestamp" FROM recent WHERE value IS NULL
         UNION ALL SELECT * FROM grid ANTI JOIN recent USING (series_id, "timestamp"))"""


@query(
    "a14_gap_report",
    sql(GAPS, 'SELECT series_id, count(*) AS gaps, min("timestamp") AS first_gap FROM gaps GROUP BY 1'),
)
def gaps(spark, sf):
    return quality.gap_report(load(spark, sf), NOW)


@query(
    "a15_run_summary",
    sql(GAPS, f"""SELECT 'run-1' AS run_id, {NOW_SQL} AS run_date, 'success' AS status, 24 AS files_found, 0 AS files_missing,
      (SELECT count(*) FROM load) AS rows_ingested, (SELECT count(*) - count(value) FROM load) AS null_count,
      (SELECT count(*) FROM gaps) AS gaps_detected, (SELECT min("timestamp") FROM gaps) AS first_gap,
      (SELECT min("timestamp") FROM load) AS window_start, (SELECT max("timestamp") FROM load) AS window_end, FALSE AS dry_run"""),
)
def summary(spark, sf):
    return quality.run_summary(load(spark, sf), NOW, "run-1", 24, 0)


@query(
    "w10_latest_per_key",
    "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def latest(spark, sf):
    return windows.latest_per(table(spark, sf, "orders"), ["o_custkey"], F.col("o_orderdate").desc(), F.col("o_orderkey").desc())


@query(
    "t03_newest_history_per_series",
    sql(LOAD, 'SELECT * FROM load QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY "timestamp" DESC) <= 336'),
)
def newest_history(spark, sf):
    return windows.latest_per(load(spark, sf), ["series_id"], F.col("timestamp").desc(), n=336)


@query(
    "t01_t04_ordered_top_rows",
    sql(LOAD, 'SELECT * FROM load WHERE value IS NOT NULL ORDER BY value DESC, series_id, "timestamp" LIMIT 72'),
)
def top_rows(spark, sf):
    ranked = load(spark, sf).filter("value IS NOT NULL").orderBy(F.col("value").desc(), "series_id", "timestamp")
    return ranked.limit(72)


@query(
    "s19_chunk_ranges",
    """WITH b AS (SELECT o_orderpriority AS series_id, min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders GROUP BY 1)
       SELECT series_id, chunk_start, least(chunk_start + INTERVAL 7 DAY, e) AS chunk_end
       FROM (SELECT series_id, e, unnest(range(s, e, INTERVAL 7 DAY)) AS chunk_start FROM b)""",
)
def chunks(spark, sf):
    spans = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("series_id")).agg(
        F.min(F.col("o_orderdate").cast("timestamp")).alias("start"), F.max(F.col("o_orderdate").cast("timestamp")).alias("end")
    )
    return ranges.chunk_ranges(spans, 7).select("series_id", "chunk_start", "chunk_end")


@query(
    "s19_hourly_targets",
    sql(LOAD, """SELECT series_id, h AS "timestamp", strftime(h, '%Y-%m-%dT%H-00-00Z') || '.json' AS file_name
      FROM (SELECT series_id, unnest(range(max("timestamp") - INTERVAL 24 HOUR, max("timestamp"), INTERVAL 1 HOUR)) AS h FROM load GROUP BY 1)"""),
)
def hourly_targets(spark, sf):
    newest = load(spark, sf).groupBy("series_id").agg(F.max("timestamp").alias("end"))
    spans = newest.withColumn("start", F.timestamp_add("HOUR", F.lit(-24), F.col("end")))
    return ranges.hourly_targets(spans).select("series_id", "timestamp", "file_name")
