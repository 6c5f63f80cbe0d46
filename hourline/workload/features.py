"""Windows, calendar, joins and the feature matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline.config import FeatureOptions
from hourline.functions import calendar, scalar
from hourline.operators import joins, slices, windows
from hourline.plans import features as plan
from hourline.workload.base import (
    LOAD, NOW, NOW_SQL, WEATHER, events, load, query, sql, table, weather,
)

W = 'PARTITION BY series_id ORDER BY "timestamp"'
EPOCH = 'PARTITION BY series_id ORDER BY epoch("timestamp")'


def at_sql(column: str, hours: int, cast: str = "BIGINT") -> str:
    """Value exactly `hours` away, as a RANGE frame over seconds."""
    where = f"{abs(hours) * 3600} {'PRECEDING' if hours < 0 else 'FOLLOWING'}"
    return (
        f'first({column}) OVER (PARTITION BY series_id ORDER BY CAST(epoch("timestamp") AS {cast}) '
        f"RANGE BETWEEN {where} AND {where})"
    )


LAGS = ",\n".join(f"{at_sql('value', -h)} AS lag_{h}h" for h in (24, 48, 168))


def known_sql(columns) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


GAP = "(lag_24h IS NULL OR lag_48h IS NULL OR lag_168h IS NULL) AS has_lag_gap"


@query("w01_w02_lags", sql(LOAD, f"SELECT *, {GAP} FROM (SELECT *, {LAGS} FROM load)"))
def lags(spark, sf):
    return windows.add_lags(load(spark, sf))


# Sums of the given tables have four decimals; as whole numbers nothing is lost in them, nor in their squares.
WHOLE = "CAST(round(value * 10000) AS HUGEINT)"


def std_sql(n: str, s: str, ss: str) -> str:
    """Sample deviation from a count and the sums of whole numbers of 1e-4 and of their squares."""
    return f"sqrt(CAST((CAST({n} * {ss} - {s} * {s} AS VARCHAR) || 'e-8') AS DOUBLE) / nullif({n} * ({n} - 1), 0))"


def _rolling_sql(rows: int, minimum: int, stat: str) -> str:
    over = f"OVER ({W} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    d = "CAST(value AS DECIMAL(18,4))"
    n, s = f"count(value) {over}", f"CAST(sum({d}) {over} AS DOUBLE)"
    value = f"{s} / {n}" if stat == "mean" else std_sql(n, f"sum({WHOLE}) {over}", f"sum({WHOLE} * {WHOLE}) {over}")
    return f"CASE WHEN {n} >= {minimum} THEN {value} END"


ROLLING_SQL = ",\n".join(
    f"{_rolling_sql(rows, least, stat)} AS {name}"
    for name, rows, least, stat in (
        ("rolling_7d_mean", 168, 72, "mean"), ("rolling_7d_std", 168, 72, "std"),
        ("rolling_24h_mean", 24, 12, "mean"),
    )
)


@query("w06_rolling", sql(LOAD, f"SELECT *, {ROLLING_SQL} FROM load"))
def rolling(spark, sf):
    return windows.add_rolling(load(spark, sf))


@query("w06_rolling_short_slices", sql(LOAD, f"SELECT *, {ROLLING_SQL} FROM load"))
def rolling_short_slices(spark, sf):
    """The same statistics with series cut into slices of 64 rows: the cut must not show."""
    return windows.add_rolling(load(spark, sf), rows_per_slice=64)


@query(
    "w05_target_time_and_row",
    sql(LOAD, f"""SELECT series_id, "timestamp", {at_sql('value', 24)} AS target_time,
      lead(value, 24) OVER ({W}) AS target_row FROM load"""),
)
def targets(spark, sf):
    timed = windows.add_target(load(spark, sf), 24).withColumnRenamed("target", "target_time")
    both = windows.add_target(timed, 24, mode="row").withColumnRenamed("target", "target_row")
    return both.drop("value")


JOINED = f"{LOAD},\n{WEATHER},\njoined AS (SELECT l.*, w.* EXCLUDE (\"timestamp\") FROM load l LEFT JOIN weather w USING (\"timestamp\"))"
COLS = ("temperature", "humidity", "cloud_cover")


@query("j01_load_weather", sql(JOINED, "SELECT * FROM joined"))
def load_weather(spark, sf):
    return joins.join_weather(load(spark, sf), weather(spark, sf))


def _each(template: str) -> str:
    return ",\n".join(template.format(c=c) for c in COLS)


FILLS = f"""{JOINED},
fwd AS (SELECT series_id, "timestamp", value, is_weather_imputed, temperature AS raw_temperature,
  humidity AS raw_humidity, cloud_cover AS raw_cloud_cover,
  {_each("last_value({c} IGNORE NULLS) OVER (" + W + " ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS {c}")}
  FROM joined),
bwd AS (SELECT * EXCLUDE (temperature, humidity, cloud_cover),
  {_each("first_value({c} IGNORE NULLS) OVER (" + W + " ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS {c}")}
  FROM fwd),
ctr AS (SELECT * EXCLUDE (temperature, humidity, cloud_cover),
  {_each("coalesce({c}, CAST(sum(CAST({c} AS DECIMAL(18,6))) OVER (" + W + " ROWS BETWEEN 36 PRECEDING AND 35 FOLLOWING) AS DOUBLE) / nullif(count({c}) OVER (" + W + " ROWS BETWEEN 36 PRECEDING AND 35 FOLLOWING), 0)) AS {c}")}
  FROM bwd),
imputed AS (SELECT series_id, "timestamp", value, temperature, humidity, cloud_cover,
  raw_temperature IS NULL AS temp_missing,
  coalesce(is_weather_imputed, FALSE)
    OR (raw_temperature IS NULL AND temperature IS NOT NULL)
    OR (raw_humidity IS NULL AND humidity IS NOT NULL)
    OR (raw_cloud_cover IS NULL AND cloud_cover IS NOT NULL) AS is_weather_imputed
  FROM ctr)"""


@query(
    "w07_bounded_fill",
    sql(FILLS, 'SELECT series_id, "timestamp", temperature, humidity, cloud_cover FROM bwd'),
)
def bounded_fill(spark, sf):
    joined = joins.join_weather(load(spark, sf), weather(spark, sf))
    return windows.fill_bounded(joined, COLS).select("series_id", "timestamp", *COLS)


@query(
    "w08_centered_fill",
    sql(JOINED, f"""SELECT series_id, "timestamp",
      {_each("coalesce({c}, CAST(sum(CAST({c} AS DECIMAL(18,6))) OVER (" + W + " ROWS BETWEEN 36 PRECEDING AND 35 FOLLOWING) AS DOUBLE) / nullif(count({c}) OVER (" + W + " ROWS BETWEEN 36 PRECEDING AND 35 FOLLOWING), 0)) AS {c}")}
      FROM joined"""),
)
def centered_fill(spark, sf):
    joined = joins.join_weather(load(spark, sf), weather(spark, sf))
    return windows.fill_centered(joined, COLS).select("series_id", "timestamp", *COLS)


@query("w09_imputed_weather", sql(FILLS, "SELECT * FROM imputed"))
def imputed(spark, sf):
    joined = joins.join_weather(load(spark, sf), weather(spark, sf))
    return windows.impute_weather(joined, rows_per_slice=128)


@query(
    "w03_temperature_lag",
    sql(FILLS, f"""SELECT series_id, "timestamp", temperature,
      lag(temperature, 24) OVER ({W}) AS temperature_lag_24h FROM imputed"""),
)
def temperature_lag(spark, sf):
    joined = joins.join_weather(load(spark, sf), weather(spark, sf))
    lagged = windows.add_temperature_lag(windows.impute_weather(joined))
    return lagged.select("series_id", "timestamp", "temperature", "temperature_lag_24h")


# The computus in the SQL is the century form by Gauss, an independent check of the one in the library.
HOLIDAYS = """years AS (SELECT CAST(unnest(range(1970, 2101)) AS INTEGER) AS y),
gauss AS (
  SELECT y, y % 19 AS a, y % 4 AS b, y % 7 AS c, y // 100 AS k,
         (13 + 8 * (y // 100)) // 25 AS p, (y // 100) // 4 AS q FROM years),
gauss_d AS (
  SELECT *, (19 * a + (15 - p + k - q) % 30) % 30 AS d, (4 + k - q) % 7 AS n FROM gauss),
gauss_e AS (SELECT *, (2 * b + 4 * c + 6 * d + n) % 7 AS e FROM gauss_d),
easter AS (
  SELECT y, CAST(make_date(y, 3, 22) + CAST(
    CASE WHEN d = 29 AND e = 6 THEN 28 WHEN d = 28 AND e = 6 AND a > 10 THEN 27 ELSE d + e END AS INTEGER) AS DATE) AS easter
  FROM gauss_e),
holidays AS (
  SELECT make_date(y, m, d) AS holiday_date FROM years,
    (VALUES (1,1), (3,15), (5,1), (8,20), (10,23), (11,1), (12,25), (12,26)) f(m, d)
  UNION SELECT CAST(easter + o AS DATE) FROM easter, (VALUES (-2, 2017), (0, 1), (1, 1), (49, 1), (50, 1)) r(o, since)
  WHERE y >= since)"""

CALENDAR = f"""{HOLIDAYS},
local AS (SELECT *, timezone('Europe/Budapest', timezone('UTC', "timestamp")) AS lt FROM @rows),
calendar AS (
  SELECT local.* EXCLUDE (lt), CAST(hour(lt) AS INTEGER) AS hour_of_day, CAST(isodow(lt) - 1 AS INTEGER) AS day_of_week,
         CAST(month(lt) AS INTEGER) AS month, CAST(quarter(lt) AS INTEGER) AS quarter,
         CAST(datediff('day', DATE '2015-01-01', CAST("timestamp" AS DATE)) AS INTEGER) AS days_since_epoch,
         isodow(lt) >= 6 AS is_weekend, h.holiday_date IS NOT NULL AS is_holiday,
         CAST(lt AS DATE) AS local_date
  FROM local LEFT JOIN holidays h ON h.holiday_date = CAST(lt AS DATE))"""


def calendar_of(rows: str) -> str:
    return CALENDAR.replace("@rows", rows)


EVE_ROW = f"""(coalesce(lead(is_holiday) OVER ({W}), FALSE)
  OR coalesce(lead(day_of_week) OVER ({W}) >= 5, FALSE)) AS is_holiday_eve"""


@query("f01_f04_calendar", sql(f"{LOAD},\n{calendar_of('load')}", "SELECT * EXCLUDE (local_date) FROM calendar"))
def calendar_columns(spark, sf):
    return calendar.add_calendar(load(spark, sf))


@query(
    "w04_holiday_eve_row",
    sql(f"{LOAD},\n{calendar_of('load')}", f'SELECT series_id, "timestamp", {EVE_ROW} FROM calendar'),
)
def eve_row(spark, sf):
    marked = windows.add_holiday_eve(calendar.add_calendar(load(spark, sf)))
    return marked.select("series_id", "timestamp", "is_holiday_eve")


ORDER_DAYS = """days AS (SELECT o_orderpriority AS series_id, o_orderdate AS "timestamp",
  CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2)"""


def order_days(spark, sf):
    return table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("timestamp").alias("timestamp")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))


@query(
    "w04_holiday_eve_day",
    sql(f"{ORDER_DAYS},\n{calendar_of('days')}", """SELECT c.* EXCLUDE (local_date),
      (n.holiday_date IS NOT NULL OR isodow(local_date + 1) >= 6) AS is_holiday_eve
      FROM calendar c LEFT JOIN holidays n ON n.holiday_date = local_date + 1"""),
)
def eve_day(spark, sf):
    """Calendar over the order days, 1995 to 2001: summer time, Easter and eves by calendar day."""
    return calendar.add_calendar(order_days(spark, sf), eve_mode="day")


@query(
    "m12_holiday_orders",
    sql(HOLIDAYS, """SELECT CAST(holiday_date AS VARCHAR) AS holiday_date, count(*) AS orders
      FROM orders JOIN holidays ON holiday_date = CAST(o_orderdate AS DATE) GROUP BY 1"""),
)
def holiday_orders(spark, sf):
    days = calendar.holiday_dim(spark)
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("holiday_date"))
    return orders.join(F.broadcast(days), "holiday_date").groupBy("holiday_date").agg(
        F.count(F.lit(1)).alias("orders")
    )


MATRIX = f"""{FILLS},
{calendar_of('imputed')},
matrix AS (
  SELECT *, {GAP} FROM (
    SELECT * EXCLUDE (local_date), {EVE_ROW},
    {LAGS},
    {ROLLING_SQL},
    lag(temperature, 24) OVER ({W}) AS temperature_lag_24h FROM calendar))"""


def matrix(spark, sf, **kw):
    options = FeatureOptions(min_rows=0, **kw)
    return plan.build_features(load(spark, sf), weather(spark, sf), options)


@query("m01_feature_matrix", sql(MATRIX, "SELECT * FROM matrix"))
def feature_matrix(spark, sf):
    return matrix(spark, sf)


@query(
    "m01_feature_matrix_min_rows",
    sql(MATRIX, "SELECT * FROM matrix WHERE series_id IN (SELECT series_id FROM load GROUP BY 1 HAVING count(*) >= 680)"),
)
def feature_matrix_min_rows(spark, sf):
    """Series below the minimum are left out, and the series are cut into short slices."""
    options = FeatureOptions(min_rows=680, rows_per_slice=256)
    return plan.build_features(load(spark, sf), weather(spark, sf), options)


@query(
    "j05_lookup_with_fallback",
    sql(LOAD, """SELECT l.series_id, l."timestamp",
      CASE WHEN a.series_id IS NOT NULL THEN a.value ELSE z.last END AS lag_24h,
      CASE WHEN b.series_id IS NOT NULL THEN b.value ELSE z.last END AS lag_168h
      FROM load l
      LEFT JOIN load a ON a.series_id = l.series_id AND a."timestamp" = l."timestamp" - to_hours(24)
      LEFT JOIN load b ON b.series_id = l.series_id AND b."timestamp" = l."timestamp" - to_hours(168)
      LEFT JOIN (SELECT series_id, arg_max(value, "timestamp") AS last FROM load WHERE value IS NOT NULL GROUP BY 1) z
        ON z.series_id = l.series_id"""),
)
def lookup(spark, sf):
    rows = load(spark, sf)
    return joins.lookup_at(rows.drop("value"), rows, (24, 168))


@query(
    "j06_weather_proxy",
    sql(JOINED, """SELECT l.series_id, l."timestamp",
      CASE WHEN p.series_id IS NOT NULL THEN p.temperature ELSE z.r.temperature END AS temperature,
      CASE WHEN p.series_id IS NOT NULL THEN p.humidity ELSE z.r.humidity END AS humidity,
      CASE WHEN p.series_id IS NOT NULL THEN p.cloud_cover ELSE z.r.cloud_cover END AS cloud_cover
      FROM load l
      LEFT JOIN joined p ON p.series_id = l.series_id AND p."timestamp" = l."timestamp" - to_hours(168)
      LEFT JOIN (SELECT series_id, arg_max({temperature: temperature, humidity: humidity, cloud_cover: cloud_cover}, "timestamp") AS r
                 FROM joined GROUP BY 1) z ON z.series_id = l.series_id"""),
)
def proxy(spark, sf):
    history = joins.join_weather(load(spark, sf), weather(spark, sf))
    return joins.weather_proxy(load(spark, sf).drop("value"), history)


@query(
    "j08_missing_hours",
    sql(LOAD, """SELECT series_id, "timestamp" FROM (
        SELECT series_id, unnest(generate_series(min("timestamp"), max("timestamp"), INTERVAL 1 HOUR)) AS "timestamp"
        FROM load GROUP BY series_id)
      ANTI JOIN load USING (series_id, "timestamp")"""),
)
def missing(spark, sf):
    return joins.missing_hours(load(spark, sf))


@query(
    "j07_semi_join_known_hours",
    sql(f"{LOAD},\n{WEATHER}", 'SELECT * FROM load SEMI JOIN weather USING ("timestamp")'),
)
def known_hours(spark, sf):
    return load(spark, sf).join(weather(spark, sf).select("timestamp"), "timestamp", "left_semi")


@query(
    "w13_tail_stats",
    sql(LOAD, f"""SELECT series_id,
      CAST(sum(v) AS DOUBLE) / count(v) AS tail_mean,
      coalesce({std_sql("count(v)", f"sum({WHOLE})", f"sum({WHOLE} * {WHOLE})")}, 0.0) AS tail_std,
      CAST(sum(v) FILTER (rn <= 24) AS DOUBLE) / nullif(count(v) FILTER (rn <= 24), 0) AS tail_short_mean,
      arg_max(value, "timestamp") FILTER (value IS NOT NULL) AS last_value
      FROM (SELECT *, CAST(value AS DECIMAL(18,4)) AS v,
              row_number() OVER (PARTITION BY series_id ORDER BY "timestamp" DESC) AS rn FROM load)
      WHERE rn <= 168 GROUP BY 1"""),
)
def tail(spark, sf):
    return windows.tail_stats(load(spark, sf))


@query(
    "f12_f07_identifiers",
    """SELECT event_id, md5(event_type || '_24_' || strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S') || '+00:00') AS forecast_id,
      strftime(ts, '%Y-%m-%dT%H-00-00Z') || '.json' AS landing_file, date_trunc('hour', ts) AS parsed FROM events""",
)
def identifiers(spark, sf):
    hour = calendar.floor_hour("ts")
    return events(spark, sf).select(
        "event_id",
        scalar.forecast_id(F.col("event_type"), F.lit(24).cast("string"), hour).alias("forecast_id"),
        scalar.file_hour(hour).alias("landing_file"),
        scalar.parse_utc(F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("parsed"),
    )


@query(
    "f05_f08_times_and_guards",
    f"""SELECT event_id, date_trunc('week', ts) AS week, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
      CAST(epoch({NOW_SQL}) - floor(epoch(ts)) AS BIGINT) // 3600 AS hours_ago,
      CAST(datediff('day', CAST(ts AS DATE), DATE '2024-01-31') AS INTEGER) AS days_ago,
      greatest(value - 100, 0.0) AS clipped, abs(value - 100) AS distance,
      100 / nullif(value - value, 0) AS guarded, CAST(value > 100 AS INTEGER) AS is_large FROM events""",
)
def times_and_guards(spark, sf):
    now = scalar.as_time(NOW)
    second = F.date_trunc("second", "ts")
    return events(spark, sf).select(
        "event_id", F.date_trunc("week", "ts").alias("week"), F.to_date("ts").alias("day"),
        scalar.hours_between(second, now).alias("hours_ago"), F.datediff(now, "ts").alias("days_ago"),
        scalar.clip_at_zero(F.col("value") - 100).alias("clipped"), F.abs(F.col("value") - 100).alias("distance"),
        (scalar.ratio_pct(F.lit(1.0), F.col("value") - F.col("value"))).alias("guarded"),
        (F.col("value") > 100).cast("int").alias("is_large"),
    )


@query(
    "series_positions",
    sql(LOAD, f'SELECT series_id, "timestamp", row_number() OVER ({W}) AS position FROM load'),
)
def positions(spark, sf):
    numbered = slices.with_position(load(spark, sf), "position", block_hours=100)
    return numbered.select("series_id", "timestamp", "position")
