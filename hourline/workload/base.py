"""Series derived from the given tables, as DataFrames and as the same thing in SQL.

load      `events` per type and hour: the sum of `value`; NULL where the hour has one event only
weather   hours with clicks: mean of `props.k` (NULL below three clicks), mean `value`, clicks
forecasts daily runs of 24 and 168 hours: the last known same hour of day, and a 24-row mean
model_run accuracy per model, horizon and week of run
checks    per series and day: how its values moved, as a history of drift checks
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourline.functions.exact import dec, exact_mean, exact_sum
from hourline.operators.metrics import mae_of, mape_of, rmse_of
from hourline.session import use_utc, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW = "2024-01-31 00:00:00"
NOW_SQL = f"TIMESTAMP '{NOW}'"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(use_utc(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: zone-free timestamps, dates as text."""
    def cast(f: T.StructField):
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.col(f.name).cast("string").alias(f.name)
        return F.col(f.name)

    return df.select(*[cast(f) for f in df.schema.fields])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").alias("timestamp"))
        .agg(F.when(F.count(F.lit(1)) > 1, exact_sum("value")).alias("value"))
    )


LOAD = """load AS (
  SELECT event_type AS series_id, date_trunc('hour', ts) AS "timestamp",
         CASE WHEN count(*) > 1 THEN CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) END AS value
  FROM events GROUP BY 1, 2)"""


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    n = F.count(F.lit(1))
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "click")
        .groupBy(F.date_trunc("hour", "ts").alias("timestamp"))
        .agg(
            F.when(n > 2, F.sum(k).cast("double") / n).alias("temperature"),
            exact_mean("value").alias("humidity"),
            n.cast("double").alias("cloud_cover"),
        )
        .withColumn("is_weather_imputed", F.lit(False))
    )


WEATHER = r"""weather AS (
  SELECT date_trunc('hour', ts) AS "timestamp",
         CASE WHEN count(*) > 2 THEN
           CAST(sum(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)) AS DOUBLE) / count(*)
         END AS temperature,
         CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS humidity,
         CAST(count(*) AS DOUBLE) AS cloud_cover, FALSE AS is_weather_imputed
  FROM events WHERE event_type = 'click' GROUP BY 1)"""


def seasonal_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily runs of 24 and 168 hours. An hour is forecast by the newest same hour of day the run knew."""
    known = load(spark, sf_dir).filter(F.col("value").isNotNull())
    reach = F.explode(F.sequence(F.lit(1), F.lit(7))).alias("days_back")
    sent = known.select("series_id", "timestamp", "value", reach)
    # Hours 1 to 24 of a run look one day back, 25 to 48 two days, and so on.
    target = F.timestamp_add("HOUR", 24 * F.col("days_back"), F.col("timestamp"))
    midnight = F.date_trunc("day", F.timestamp_add("HOUR", F.lit(-1), target))
    run_at = F.timestamp_add("HOUR", -24 * (F.col("days_back") - 1), midnight)
    per_horizon = F.explode(
        F.when(F.col("days_back") == 1, F.array(F.lit(24), F.lit(168))).otherwise(F.array(F.lit(168)))
    )
    return sent.select(
        "series_id", target.alias("timestamp"), run_at.alias("forecast_run_at"), "value", per_horizon.alias("horizon_hours")
    ).select(
        "series_id", "timestamp", "forecast_run_at",
        F.format_string("seasonal_%dh", "horizon_hours").alias("model_name"),
        F.lit("v1").alias("model_version"), "horizon_hours", F.col("value").alias("predicted"),
    )


def mean_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second model: every hour of a run is the mean of the day before the run."""
    daily = (
        load(spark, sf_dir)
        .groupBy("series_id", F.date_trunc("day", "timestamp").alias("day"))
        .agg(exact_mean("value").alias("predicted"))
        .filter(F.col("predicted").isNotNull())
    )
    run_at = F.timestamp_add("HOUR", F.lit(24), F.col("day"))
    horizons = F.explode(F.array(F.lit(24), F.lit(168)))
    runs = daily.select("series_id", run_at.alias("forecast_run_at"), "predicted", horizons.alias("horizon_hours"))
    ahead = F.explode(F.sequence(F.lit(1), F.col("horizon_hours"))).alias("i")
    return runs.select("*", ahead).select(
        "series_id", F.timestamp_add("HOUR", F.col("i"), F.col("forecast_run_at")).alias("timestamp"),
        "forecast_run_at", F.format_string("mean_%dh", "horizon_hours").alias("model_name"),
        F.lit("v1").alias("model_version"), "horizon_hours", "predicted",
    )


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast facts with the actual where it is known."""
    actual = load(spark, sf_dir).select("series_id", "timestamp", F.col("value").alias("actual"))
    facts = seasonal_forecasts(spark, sf_dir).unionByName(mean_forecasts(spark, sf_dir))
    return facts.join(actual, ["series_id", "timestamp"], "left")


FORECASTS = f"""{LOAD},
seasonal AS (
  SELECT series_id, "timestamp" + to_hours(24 * d) AS "timestamp",
         date_trunc('day', "timestamp" + to_hours(24 * d - 1)) - to_hours(24 * (d - 1)) AS forecast_run_at,
         'seasonal_' || h || 'h' AS model_name, 'v1' AS model_version, h AS horizon_hours, value AS predicted
  FROM load, (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS d) days, (SELECT unnest([24, 168]) AS h) hs
  WHERE value IS NOT NULL AND (h = 168 OR d = 1)),
daily AS (
  SELECT series_id, date_trunc('day', "timestamp") + to_hours(24) AS forecast_run_at,
         CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) / count(value) AS predicted
  FROM load GROUP BY 1, 2 HAVING count(value) > 0),
means AS (
  SELECT series_id, forecast_run_at + to_hours(i) AS "timestamp", forecast_run_at,
         'mean_' || h || 'h' AS model_name, 'v1' AS model_version, h AS horizon_hours, predicted
  FROM daily, (SELECT unnest([24, 168]) AS h) hs, (SELECT CAST(unnest(range(1, 169)) AS INTEGER) AS i) leads
  WHERE i <= h),
forecasts AS (
  SELECT f.*, l.value AS actual
  FROM (SELECT * FROM seasonal UNION ALL SELECT * FROM means) f
  LEFT JOIN load l ON l.series_id = f.series_id AND l."timestamp" = f."timestamp")"""


def exact_mean_sql(x: str, kind: str = "DECIMAL(18,6)") -> str:
    return f"CAST(sum(CAST({x} AS {kind})) AS DOUBLE) / nullif(count({x}), 0)"


def rmse_sql(e: str) -> str:
    c = f"CAST({e} AS DECIMAL(18,6))"
    return f"sqrt(CAST(sum({c} * {c}) AS DOUBLE) / nullif(count({e}), 0))"


def mape_sql(e: str, a: str) -> str:
    share = f"abs(({e}) / nullif({a}, 0) * 100)"
    return f"CASE WHEN count({e}) > 0 THEN coalesce({exact_mean_sql(share)}, 0.0) END"


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of each model and horizon per week of run, standing in for training runs.

    The naive baseline of a run is the seasonal model of the same horizon and week. The first week's
    run of each model is in production.
    """
    facts = forecasts(spark, sf_dir).filter(F.col("actual").isNotNull())
    error = F.col("actual") - F.col("predicted")
    week = F.date_trunc("week", "forecast_run_at").alias("started_at")
    scored = facts.groupBy("model_name", "horizon_hours", week).agg(
        mae_of(error).alias("mae"), rmse_of(error).alias("rmse"), mape_of(error, F.col("actual")).alias("mape"),
        F.count(F.lit(1)).alias("n_test"), F.min("timestamp").alias("training_data_start"),
        F.max("timestamp").alias("training_data_end"),
    )
    # A row per model and week by now, so these windows are over a handful of rows.
    same_week = Window.partitionBy("horizon_hours", "started_at")
    is_naive = F.col("model_name").startswith("seasonal")
    naive = {f"naive_{m}": F.max(F.when(is_naive, F.col(m))).over(same_week) for m in ("mae", "rmse", "mape")}
    first = F.min("started_at").over(Window.partitionBy("model_name"))
    return scored.withColumns(naive).withColumns(
        {
            "run_id": F.md5(F.concat_ws("_", "model_name", F.date_format("started_at", "yyyyMMdd"))),
            "family": F.substring_index("model_name", "_", 1),
            "production": F.col("started_at") == first,
        }
    )


def stored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run records as the stored table that evaluation and promotion read several times."""
    return written(model_runs(spark, sf_dir), "runs")


MODEL_RUNS = f"""{FORECASTS},
scored AS (
  SELECT model_name, horizon_hours, date_trunc('week', forecast_run_at) AS started_at,
         {exact_mean_sql('abs(actual - predicted)')} AS mae, {rmse_sql('(actual - predicted)')} AS rmse,
         {mape_sql('actual - predicted', 'actual')} AS mape, count(*) AS n_test,
         min("timestamp") AS training_data_start, max("timestamp") AS training_data_end
  FROM forecasts WHERE actual IS NOT NULL GROUP BY 1, 2, 3),
model_runs AS (
  SELECT s.*, n.mae AS naive_mae, n.rmse AS naive_rmse, n.mape AS naive_mape,
         md5(s.model_name || '_' || strftime(s.started_at, '%Y%m%d')) AS run_id,
         split_part(s.model_name, '_', 1) AS family,
         s.started_at = min(s.started_at) OVER (PARTITION BY s.model_name) AS production
  FROM scored s LEFT JOIN scored n ON n.model_name LIKE 'seasonal%'
    AND n.horizon_hours = s.horizon_hours AND n.started_at = s.started_at)"""


def checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history of drift checks, one per series and day, from how the day compares with the series."""
    by_day = events(spark, sf_dir).groupBy(
        F.col("event_type").alias("series_id"), F.date_trunc("day", "ts").alias("check_timestamp")
    ).agg(F.sum(dec("value")).alias("s"), F.count(F.lit(1)).alias("n"))
    # One row per series and day by now.
    whole = Window.partitionBy("series_id")
    overall = {"ts": F.sum("s").over(whole), "tn": F.sum("n").over(whole), "days": F.count(F.lit(1)).over(whole)}
    day_mean = F.col("s").cast("double") / F.col("n")
    score = day_mean / (F.col("ts").cast("double") / F.col("tn")) - 1
    busy = F.col("n").cast("double") * F.col("days") / F.col("tn") - 1
    names = F.concat_ws(
        ",", F.when(F.abs("drift_score_value") > 0.05, "value"),
        F.when(F.abs("drift_score_temperature") > 0.05, "temperature"),
    )
    return (
        by_day.withColumns(overall)
        .withColumns({"drift_score_value": score, "drift_score_temperature": busy, "mae": day_mean})
        .withColumn("drifted_features", names)
        .withColumns(
            {
                "any_drift_detected": F.col("drifted_features") != "",
                "retrain_triggered": F.col("drifted_features") == "value,temperature",
                "n_drifted_features": F.when(F.col("drifted_features") == "", 0).otherwise(
                    F.size(F.split("drifted_features", ","))
                ),
            }
        )
        .drop("s", "n", "ts", "tn", "days")
    )


CHECKS = """by_day AS (
  SELECT event_type AS series_id, date_trunc('day', ts) AS check_timestamp,
         sum(CAST(value AS DECIMAL(18,4))) AS s, count(*) AS n FROM events GROUP BY 1, 2),
overall AS (SELECT series_id, sum(s) AS ts, sum(n) AS tn, count(*) AS days FROM by_day GROUP BY 1),
scores AS (
  SELECT series_id, check_timestamp,
         (CAST(s AS DOUBLE) / n) / (CAST(ts AS DOUBLE) / CAST(tn AS BIGINT)) - 1 AS drift_score_value,
         CAST(n AS DOUBLE) * days / CAST(tn AS BIGINT) - 1 AS drift_score_temperature,
         CAST(s AS DOUBLE) / n AS mae
  FROM by_day JOIN overall USING (series_id)),
named AS (
  SELECT *, concat_ws(',', CASE WHEN abs(drift_score_value) > 0.05 THEN 'value' END,
                           CASE WHEN abs(drift_score_temperature) > 0.05 THEN 'temperature' END) AS drifted_features
  FROM scores),
checks AS (
  SELECT *, drifted_features <> '' AS any_drift_detected,
         drifted_features = 'value,temperature' AS retrain_triggered,
         CASE WHEN drifted_features = '' THEN 0 ELSE len(string_split(drifted_features, ',')) END AS n_drifted_features
  FROM named)"""


def sql(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
