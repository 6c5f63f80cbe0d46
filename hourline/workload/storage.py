"""Upserts, change feeds, logs, landing files and payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline import schemas
from hourline.operators import quality
from hourline.operators.joins import only_missing
from hourline.plans.rebuild import build_window, rebuild, rebuild_changed
from hourline.config import FeatureOptions
from hourline.functions.scalar import as_time, file_hour
from hourline.session import scratch_path, written
from hourline.sources import flags, landing, payloads, tables, upsert
from hourline.sources import versions as stored
from hourline.workload.base import (
    CHECKS, LOAD, NOW, NOW_SQL, WEATHER, checks, forecasts, FORECASTS, load, MODEL_RUNS, query, sql, stored_runs, weather,
)
from hourline.workload.features import MATRIX, matrix

KEY = ["series_id", "timestamp"]


def versions(spark, sf):
    """An older table and a newer batch that overlap by ten days."""
    rows = load(spark, sf)
    old = rows.filter(F.col("timestamp") < "2024-01-20").withColumns({"source": F.lit("old"), "is_gap": F.col("value").isNull()})
    new = rows.filter(F.col("timestamp") >= "2024-01-10").select(
        "series_id", "timestamp", (F.col("value") + 1).alias("value"), F.lit("new").alias("source"),
        F.col("value").isNull().alias("is_gap"),
    )
    return old, new


VERSIONS = f"""{LOAD},
old AS (SELECT *, 'old' AS source, value IS NULL AS is_gap FROM load WHERE "timestamp" < TIMESTAMP '2024-01-20'),
new AS (SELECT series_id, "timestamp", value + 1 AS value, 'new' AS source, value IS NULL AS is_gap
        FROM load WHERE "timestamp" >= TIMESTAMP '2024-01-10'),
pair AS (SELECT coalesce(o.series_id, n.series_id) AS series_id, coalesce(o."timestamp", n."timestamp") AS "timestamp",
  o.series_id IS NULL AS ins, n.series_id IS NOT NULL AS has_new, o.value AS ov, n.value AS nv, o.source AS os, n.source AS ns,
  o.is_gap AS og, n.is_gap AS ng
  FROM old o FULL JOIN new n ON n.series_id = o.series_id AND n."timestamp" = o."timestamp")"""


def merged_sql(cond: str, gap: str = "CASE WHEN take THEN ng ELSE og END") -> str:
    return f"""SELECT series_id, "timestamp", CASE WHEN take THEN nv ELSE ov END AS value,
      CASE WHEN take THEN ns ELSE os END AS source, {gap} AS is_gap,
      CASE WHEN ins THEN 'insert' WHEN take THEN 'update' ELSE 'keep' END AS _change
      FROM (SELECT *, ins OR (has_new AND ({cond})) AS take FROM pair)"""


@query("s09_j04_conditional_upsert", sql(VERSIONS, merged_sql("nv IS NOT NULL")))
def conditional(spark, sf):
    old, new = versions(spark, sf)
    return upsert.upsert(old, new, KEY, when="value IS NOT NULL")


@query(
    "s10_partial_column_upsert",
    sql(VERSIONS, merged_sql("NOT ng", "CASE WHEN ins THEN ng ELSE og END")),
)
def partial(spark, sf):
    old, new = versions(spark, sf)
    return upsert.upsert(old, new, KEY, update=["value", "source"], when=~F.col("is_gap"))


@query("s11_full_upsert", sql(VERSIONS, merged_sql("TRUE")))
def full(spark, sf):
    return upsert.upsert(*versions(spark, sf), KEY)


@query("s12_insert_only", sql(VERSIONS, merged_sql("FALSE")))
def insert_only(spark, sf):
    return upsert.upsert(*versions(spark, sf), KEY, update=None)


@query(
    "s15_write_counters",
    sql(VERSIONS, """SELECT count(*) FILTER (ins) AS rows_inserted, count(*) FILTER (NOT ins AND has_new AND nv IS NOT NULL) AS rows_updated,
      count(*) FILTER (NOT ins AND NOT (has_new AND nv IS NOT NULL)) AS rows_kept FROM pair"""),
)
def counters(spark, sf):
    old, new = versions(spark, sf)
    return upsert.change_counts(upsert.upsert(old, new, KEY, when="value IS NOT NULL"))


@query(
    "s06_s09_merged_table",
    sql(VERSIONS, f"""SELECT * EXCLUDE (_change), CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day FROM ({merged_sql("nv IS NOT NULL")})"""),
)
def merged_table(spark, sf):
    """The same upsert through files: create, merge by day, merge the batch again, read back."""
    old, new = (tables.with_day(d) for d in versions(spark, sf))
    path = scratch_path(spark, "load")
    upsert.merge_into(path, old, KEY, ["day"])
    for _ in range(2):
        upsert.merge_into(path, new, KEY, ["day"], when="value IS NOT NULL")
    return tables.read_table(spark, path, old.schema)


def versioned(spark, sf, name):
    """A versioned table that holds the older rows as version 1, its path, and the newer batch."""
    old, new = (tables.with_day(d) for d in versions(spark, sf))
    path = scratch_path(spark, name)
    stored.merge_version(path, old, KEY, ["day"])
    return path, old.schema, new


@query(
    "s09_versioned_merge",
    sql(VERSIONS, f"""SELECT * EXCLUDE (_change), CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day FROM ({merged_sql("nv IS NOT NULL")})"""),
)
def versioned_merge(spark, sf):
    """The upsert as a new version of a table; the batch that is merged again by its number changes nothing."""
    path, schema, new = versioned(spark, sf, "versioned-load")
    for _ in range(2):
        stored.merge_version(path, new, KEY, ["day"], when="value IS NOT NULL", writer=("batch", 1))
    return stored.read_version(spark, path, schema, ["day"])


@query(
    "s18_version_changes",
    sql(VERSIONS, """SELECT series_id, "timestamp", CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day, unnest(CASE
        WHEN ins THEN [{'value': nv, 'source': ns, 'is_gap': ng, 'change': 'insert'}]
        ELSE [{'value': ov, 'source': os, 'is_gap': og, 'change': 'update_pre'}, {'value': nv, 'source': ns, 'is_gap': ng, 'change': 'update_post'}]
      END, recursive := true) FROM pair WHERE ins OR (has_new AND nv IS NOT NULL)"""),
)
def version_feed(spark, sf):
    """What the second version changed, read from the partitions it wrote."""
    path, schema, new = versioned(spark, sf, "feed")
    stored.merge_version(path, new, KEY, ["day"], when="value IS NOT NULL")
    return stored.version_changes(spark, path, schema, KEY, ["day"], 1)


@query(
    "s12_forecast_refresh",
    sql(VERSIONS, """SELECT series_id, "timestamp", CASE WHEN take THEN nv ELSE ov END AS value,
      CASE WHEN take THEN 'new' ELSE 'old' END AS source, CASE WHEN NOT take AND "timestamp" < TIMESTAMP '2024-01-15' THEN ov END AS actual,
      CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day
      FROM (SELECT *, ins OR (has_new AND NOT coalesce("timestamp" < TIMESTAMP '2024-01-15' AND ov IS NOT NULL, FALSE)) AS take FROM pair)"""),
)
def forecast_refresh(spark, sf):
    """Newer forecasts replace the older ones of the hours that have no actual yet."""
    actual = F.when((F.col("timestamp") < "2024-01-15") & (F.col("source") == "old"), F.col("value"))
    old, new = (tables.with_day(d.drop("is_gap").withColumn("actual", actual)) for d in versions(spark, sf))
    path = scratch_path(spark, "refreshed")
    stored.merge_version(path, old, KEY, ["day"])
    stored.refresh_version(path, new, KEY, ["day"], "actual")
    return stored.read_version(spark, path, old.schema, ["day"])


@query(
    "p13_dry_run_counts",
    sql(VERSIONS, """SELECT count(*) FILTER (ins) AS rows_inserted, count(*) FILTER (NOT ins AND has_new AND nv IS NOT NULL) AS rows_updated,
      count(*) FILTER (NOT ins AND NOT (has_new AND nv IS NOT NULL)) AS rows_kept
      FROM pair WHERE CAST("timestamp" AS DATE) IN (SELECT CAST("timestamp" AS DATE) FROM new)"""),
)
def dry_run(spark, sf):
    """What a merge would do to the partitions it touches; nothing is written."""
    path, _, new = versioned(spark, sf, "dry-run")
    counts = stored.merge_version(path, new, KEY, ["day"], when="value IS NOT NULL", dry_run=True)
    if stored.current(spark, path) != 1:
        raise AssertionError("a dry run has written a version")
    return counts


@query(
    "s18_changes",
    sql(VERSIONS, """SELECT series_id, "timestamp", value, source, is_gap, change FROM (
      SELECT o.*, CASE WHEN n.series_id IS NULL THEN 'delete' ELSE 'update_pre' END AS change FROM old o
        LEFT JOIN new n ON n.series_id = o.series_id AND n."timestamp" = o."timestamp"
      UNION ALL SELECT n.*, CASE WHEN o.series_id IS NULL THEN 'insert' ELSE 'update_post' END AS change FROM new n
        LEFT JOIN old o ON o.series_id = n.series_id AND o."timestamp" = n."timestamp")"""),
)
def change_feed(spark, sf):
    return upsert.changes(*versions(spark, sf), KEY)


@query(
    "s13_backfilled_actuals",
    sql(FORECASTS, """SELECT f.series_id, f."timestamp", f.forecast_run_at, f.model_name, f.horizon_hours, f.predicted,
      coalesce(half, l.value) AS actual, (half IS NULL AND l.value IS NOT NULL) AS is_backfilled,
      CASE WHEN half IS NULL AND l.value IS NOT NULL THEN 'update' ELSE 'keep' END AS _change
      FROM (SELECT *, CASE WHEN "timestamp" < TIMESTAMP '2024-01-15' THEN actual END AS half FROM forecasts WHERE horizon_hours = 24) f
      LEFT JOIN load l ON l.series_id = f.series_id AND l."timestamp" = f."timestamp" """),
)
def backfilled(spark, sf):
    early = F.when(F.col("timestamp") < "2024-01-15", F.col("actual"))
    facts = forecasts(spark, sf).filter("horizon_hours = 24").withColumns({"actual": early, "is_backfilled": F.lit(False)})
    return upsert.fill_from(
        facts.drop("model_version"), load(spark, sf), KEY, "actual", "value", flag="is_backfilled"
    )


@query(
    "s14_update_by_decisions",
    sql(MODEL_RUNS, """SELECT run_id, model_name, started_at,
      CASE WHEN run_id IN (SELECT run_id FROM model_runs WHERE mape > naive_mape) THEN FALSE ELSE production END AS production FROM model_runs"""),
)
def update_by_decisions(spark, sf):
    runs = stored_runs(spark, sf)
    worse = runs.filter(F.col("mape") > F.col("naive_mape")).select(F.col("run_id").alias("bad_run"))
    return upsert.update_where(
        runs.select("run_id", "model_name", "started_at", "production"), worse, {"run_id": "bad_run"}, {"production": F.lit(False)}
    )


@query(
    "s07_ingestion_log",
    sql(LOAD, f"""SELECT 'run-1' AS run_id, {NOW_SQL} AS run_date, 24 AS files_found, 1 AS files_missing, count(*) AS rows_ingested,
      count(*) - count(value) AS null_count, CAST(0 AS BIGINT) AS schema_errors, FALSE AS dry_run, {NOW_SQL} AS written_at, '2024-01-31' AS date FROM load"""),
)
def ingestion_log(spark, sf):
    now = as_time(NOW)
    record = tables.ingestion_record(quality.load_quality(load(spark, sf)), "run-1", now, 24, 1, now)
    path = scratch_path(spark, "ingestion_log")
    tables.append_log(record, path, "run_date")
    return tables.read_table(spark, path, schemas.INGESTION_LOG)


EVOLVED = f"""{VERSIONS}
SELECT * FROM (SELECT series_id, "timestamp", value FROM old UNION ALL BY NAME SELECT series_id, "timestamp", value, source FROM new)"""


@query("s08_append_evolving", f"WITH {EVOLVED}")
def evolving(spark, sf):
    old, new = versions(spark, sf)
    path = scratch_path(spark, "evolving")
    tables.append_evolving(old.select(*KEY, "value"), path)
    tables.append_evolving(new.select(*KEY, "value", "source"), path)
    return tables.read_evolving(spark, path)


@query("s08_union_evolving", f"WITH {EVOLVED}")
def union_by_name(spark, sf):
    old, new = versions(spark, sf)
    return tables.union_evolving(old.select(*KEY, "value"), new.select(*KEY, "value", "source"))


def landed(spark, sf, directory):
    """Writes the load as JSON files the way the feed would, one array per file: a file per series and day."""
    row = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), "series_id", "value",
        F.lit("feed").alias("source"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("fetched_at"),
    )
    day = F.date_format("timestamp", "yyyy-MM-dd").alias("day")
    by_day = load(spark, sf).groupBy(F.col("series_id").alias("series"), day).agg(F.to_json(F.collect_list(row)).alias("value"))
    by_day.write.partitionBy("series", "day").text(directory)


@query(
    "s01_landing_files",
    sql(LOAD, """SELECT *, 'feed' AS source, "timestamp" AS fetched_at FROM load"""),
)
def landing_files(spark, sf):
    directory = scratch_path(spark, "landing")
    landed(spark, sf, directory)
    return landing.read_landing(spark, directory, schemas.LANDING_LOAD).select(
        "series_id", "timestamp", "value", "source", "fetched_at"
    )


@query(
    "s02_missing_landing_files",
    sql(LOAD, f"""SELECT series_id, h AS "timestamp", strftime(h, '%Y-%m-%dT%H-00-00Z') || '.json' AS file_name
      FROM (SELECT series_id, unnest(generate_series({NOW_SQL} - INTERVAL 719 HOUR, {NOW_SQL}, INTERVAL 1 HOUR)) AS h
            FROM (SELECT DISTINCT series_id FROM load)) e
      ANTI JOIN load ON load.series_id = e.series_id AND load."timestamp" = h"""),
)
def missing_files(spark, sf):
    """The expected files of 30 days of every series against the hours it has data for."""
    rows = load(spark, sf)
    expected = landing.expected_hours_of(rows.select("series_id").distinct(), NOW, 720)
    return only_missing(expected, rows.select("series_id", file_hour("timestamp").alias("file_name")), ["series_id", "file_name"])


@query(
    "s02_s16_landing_ledger",
    sql(LOAD, f"""SELECT series_id, "timestamp", strftime("timestamp", '%Y-%m-%dT%H-00-00Z') || '.json' AS file_name, value, attempt
      FROM load, (SELECT unnest([1, 2]) AS attempt) WHERE series_id = 'click'
        AND "timestamp" > {NOW_SQL} - attempt * INTERVAL 24 HOUR AND "timestamp" <= {NOW_SQL} - (attempt - 1) * INTERVAL 24 HOUR"""),
)
def landing_ledger(spark, sf):
    """Hourly files found by their names, read, and marked as processed: the second run looks back twice as far and
    reads only what the first has not. One series' feed has a folder of its own."""
    base = scratch_path(spark, "hourly-feed")
    feed = load(spark, sf).filter(F.col("series_id") == "click").withColumn("file_name", file_hour("timestamp"))
    last_days = feed.filter(F.col("timestamp") > F.timestamp_add("HOUR", F.lit(-48), as_time(NOW)))
    landing.write_hourly(last_days.select("series_id", "timestamp", "value", "file_name"), f"{base}/feed")
    out = []
    for attempt in (1, 2):
        expected = landing.expected_files(spark, NOW, 24 * attempt, f"{base}/feed")
        done = spark.read.parquet(f"{base}/ledger") if attempt > 1 else None
        paths = landing.found_paths(expected, done)
        rows = spark.createDataFrame([], "series_id string, timestamp timestamp, value double, file_name string")
        if paths:
            rows = landing.read_hourly(spark, paths)
        out.append(rows.withColumn("attempt", F.lit(attempt)))
        landing.mark_processed(expected if done is None else only_missing(expected, done, ["file_name"]), f"{base}/ledger", NOW)
    return out[0].unionByName(out[1])


XML_DOCS = f"""{LOAD},
placed AS (SELECT series_id, date_trunc('day', "timestamp") AS day, CAST(hour("timestamp") AS INTEGER) + 1 AS p, value FROM load),
spans AS (SELECT series_id, day, max(p) AS highest FROM placed WHERE value IS NOT NULL GROUP BY 1, 2)"""


@query(
    "s03_xml_load_points",
    sql(XML_DOCS, """SELECT g.series_id, g.day + to_hours(g.p - 1) AS "timestamp", d.value, 'PT60M' AS resolution
      FROM (SELECT series_id, day, CAST(unnest(range(1, highest + 1)) AS INTEGER) AS p FROM spans) g
      LEFT JOIN placed d ON d.series_id = g.series_id AND d.day = g.day AND d.p = g.p"""),
)
def xml_points(spark, sf):
    """Load as one XML document per series and day, and back: positions without a value return as gaps."""
    placed = load(spark, sf).filter("value IS NOT NULL").select(
        "series_id", F.date_trunc("day", "timestamp").alias("day"), (F.hour("timestamp") + 1).alias("p"), "value"
    )
    point = F.format_string("<Point><position>%d</position><quantity>%s</quantity></Point>", "p", F.col("value").cast("string"))
    documents = placed.groupBy("series_id", "day").agg(F.concat_ws("", F.collect_list(point)).alias("points")).select(
        "series_id",
        F.format_string(
            '<?xml version="1.0"?><Load_Document xmlns="urn:load:3.0"><TimeSeries><Period><timeInterval><start>%s</start></timeInterval>'
            "<resolution>PT60M</resolution>%s</Period></TimeSeries></Load_Document>",
            F.date_format("day", "yyyy-MM-dd'T'HH:mm'Z'"), "points",
        ).alias("xml"),
    )
    return payloads.xml_load_points(documents, "xml")


@query(
    "s04_weather_json_rows",
    sql(WEATHER, """SELECT timezone('UTC', timezone('Europe/Budapest', "timestamp")) AS "timestamp", temperature, humidity,
      CAST(NULL AS DOUBLE) AS cloud_cover, FALSE AS is_weather_imputed FROM weather"""),
)
def json_rows(spark, sf):
    """Weather as one document of parallel arrays per day, without the cloud array, and back."""
    hour = F.struct(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm").alias("t"), "temperature", "humidity")
    days = weather(spark, sf).groupBy(F.date_trunc("day", "timestamp").alias("day")).agg(F.array_sort(F.collect_list(hour)).alias("h"))
    documents = days.select(
        F.to_json(
            F.struct(
                F.struct(
                    F.col("h.t").alias("time"), F.col("h.temperature").alias("temperature_2m"),
                    F.col("h.humidity").alias("relative_humidity_2m"),
                ).alias("hourly")
            ),
            {"ignoreNullFields": "false"},
        ).alias("json")
    )
    return payloads.weather_json_rows(documents, "json")


@query(
    "s17_retrain_flags",
    sql(CHECKS, f"""SELECT flag_id, series_id, check_timestamp AS triggered_at FROM (
      SELECT *, md5(series_id || '_' || strftime(check_timestamp, '%Y-%m-%dT%H:%M:%S') || '+00:00') AS flag_id FROM checks WHERE retrain_triggered)
      WHERE check_timestamp >= TIMESTAMP '2024-01-15' AND series_id NOT IN
        (SELECT series_id FROM checks WHERE retrain_triggered AND check_timestamp < TIMESTAMP '2024-01-10')"""),
)
def retrain_flags(spark, sf):
    """Early flags are pending for some series and consumed for others; late checks raise the rest."""
    decisions = checks(spark, sf).withColumns({"reason": F.lit("drift"), "consecutive_drift_hours": F.lit(3)})
    nothing = decisions.filter("false")
    early = flags.raise_flags(decisions.filter(F.col("check_timestamp") < "2024-01-15"), nothing)
    consumed = flags.consume_flags(early.filter(F.col("triggered_at") >= "2024-01-10"), NOW)
    pending = flags.pending_flags(early, consumed)
    raised = flags.raise_flags(decisions.filter(F.col("check_timestamp") >= "2024-01-15"), pending)
    return raised.select("flag_id", "series_id", "triggered_at")


@query(
    "s20_rebuilt_features",
    sql(MATRIX, """SELECT *, (SELECT date_trunc('day', min("timestamp")) FROM load) + to_days(CAST(10 * (datediff('day',
      (SELECT min("timestamp") FROM load), "timestamp") // 10) AS INTEGER)) AS chunk_start FROM matrix"""),
)
def rebuilt(spark, sf):
    options = FeatureOptions(min_rows=0, rows_per_slice=200)
    return rebuild(load(spark, sf), weather(spark, sf), 10, options)


@query(
    "s20_incremental_window",
    sql(MATRIX, """SELECT * FROM matrix WHERE "timestamp" BETWEEN TIMESTAMP '2024-01-29' AND TIMESTAMP '2024-01-30'"""),
)
def incremental(spark, sf):
    """The last day only, from an overlap long enough that every row-counting frame is complete."""
    options = FeatureOptions(min_rows=0)
    return build_window(load(spark, sf), weather(spark, sf), "2024-01-29", "2024-01-30", 400, options=options)


EDITED = MATRIX.replace(LOAD, LOAD.replace("load AS", "unedited AS", 1) + """,
load AS (SELECT series_id, "timestamp", CASE WHEN CAST("timestamp" AS DATE) = DATE '2024-01-20' THEN value + 1 ELSE value END AS value
  FROM unedited WHERE "timestamp" <> TIMESTAMP '2024-01-08 05:00:00')""", 1)


@query("s18_s20_rebuilt_changes", sql(EDITED, "SELECT * FROM matrix"))
def rebuilt_changes(spark, sf):
    """The matrix after a day of values was corrected and an hour removed, from the change feed: the blocks that these
    reach are built again, the others are those of the matrix before."""
    before = load(spark, sf)
    value = F.when(F.to_date("timestamp") == F.lit("2024-01-20").cast("date"), F.col("value") + 1).otherwise(F.col("value"))
    after = before.withColumn("value", value).filter(F.col("timestamp") != "2024-01-08 05:00:00")
    stored_after = written(after, "edited-load")
    changed = upsert.changes(before, stored_after, KEY).select(*KEY).distinct()
    return rebuild_changed(written(matrix(spark, sf), "matrix"), stored_after, weather(spark, sf), written(changed, "changed"), block_hours=24)
