"""Metrics, splits and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline.operators import joins, metrics
from hourline.operators.windows import impute_weather
from hourline.plans import forecast, splits
from hourline.plans.panels import model_list
from hourline.workload.base import (
    FORECASTS, LOAD, MODEL_RUNS, exact_mean_sql, forecasts, load, mape_sql, model_runs, query,
    rmse_sql, sql, weather,
)
from hourline.workload.features import FILLS, WHOLE, calendar_of, std_sql

BY_MODEL = ["series_id", "model_name"]


def score_sql(e: str, a: str, prefix: str = "") -> str:
    return (
        f"{exact_mean_sql(f'abs({e})')} AS {prefix}mae, {rmse_sql(f'({e})')} AS {prefix}rmse, "
        f"{mape_sql(e, a)} AS {prefix}mape, count(*) AS {prefix}n"
    )


@query(
    "a07_regression_metrics",
    sql(FORECASTS, f"SELECT series_id, model_name, {score_sql('actual - predicted', 'actual')} FROM forecasts WHERE actual IS NOT NULL GROUP BY 1, 2"),
)
def regression(spark, sf):
    return metrics.regression_metrics(forecasts(spark, sf), by=BY_MODEL)


NAIVE = f"""{LOAD},
paired AS (SELECT l.series_id, l.value AS actual, b.value AS baseline FROM load l
  JOIN load b ON b.series_id = l.series_id AND b."timestamp" = l."timestamp" - to_hours(24)
  WHERE l.value IS NOT NULL AND b.value IS NOT NULL)"""


@query(
    "a08_naive_metrics",
    sql(NAIVE, f"SELECT {score_sql('actual - baseline', 'actual', 'naive_')} FROM paired"),
)
def naive(spark, sf):
    rows = forecast.naive_forecast(load(spark, sf), 24).withColumnRenamed("value", "actual")
    return metrics.naive_metrics(rows)


@query(
    "a09_r2",
    sql(FORECASTS, """SELECT series_id, model_name, count(*) AS n,
      CASE WHEN min(actual) = max(actual) THEN 0.0
        ELSE round(1 - sum((actual - predicted) ** 2) / (var_pop(actual) * count(*)), 9) END AS r2
      FROM forecasts WHERE actual IS NOT NULL GROUP BY 1, 2"""),
)
def r2(spark, sf):
    # Sums of doubles end in other bits with every order of the rows; nine decimals are the same in all.
    return metrics.r2(forecasts(spark, sf), by=BY_MODEL).withColumn("r2", F.round("r2", 9))


@query(
    "a06_prediction_mae",
    sql(FORECASTS, f"""SELECT series_id, count(actual) AS n_actuals,
      CASE WHEN count(actual) >= 24 THEN {exact_mean_sql('abs(predicted - actual)')} END AS mae
      FROM forecasts WHERE model_name = 'seasonal_24h' AND horizon_hours = 24
        AND forecast_run_at BETWEEN TIMESTAMP '2024-01-29' AND TIMESTAMP '2024-01-30' GROUP BY 1"""),
)
def prediction_mae(spark, sf):
    return metrics.prediction_mae(forecasts(spark, sf), "2024-01-29", "2024-01-30", model="seasonal_24h")


@query(
    "a10_weekly_mape",
    sql(FORECASTS, f"""SELECT date_trunc('week', "timestamp") AS week_start, horizon_hours,
      {exact_mean_sql('(abs(actual - predicted) / nullif(actual, 0) * 100)')} AS weekly_mape,
      count(*) AS n_observations, CAST(5.0 AS DOUBLE) AS target_mape
      FROM forecasts WHERE actual IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 24"""),
)
def weekly(spark, sf):
    return metrics.weekly_mape(forecasts(spark, sf))


@query(
    "a13_model_list",
    sql(FORECASTS, "SELECT model_name, bool_or(actual IS NOT NULL) AS has_actuals FROM forecasts WHERE horizon_hours = 168 GROUP BY 1"),
)
def models(spark, sf):
    return model_list(forecasts(spark, sf), 168)


@query(
    "m05_seasonal_naive",
    sql(LOAD, """SELECT l.*, a.value AS baseline FROM load l LEFT JOIN load a
      ON a.series_id = l.series_id AND a."timestamp" = l."timestamp" - to_hours(168)"""),
)
def seasonal(spark, sf):
    return forecast.naive_forecast(load(spark, sf), 168)


HOLDOUT = """SELECT l.*, CASE WHEN "timestamp" <= last - to_hours({both}) THEN 'train'
    WHEN "timestamp" <= last - to_hours(120) THEN 'val' ELSE 'test' END AS split
  FROM load l JOIN (SELECT series_id, max("timestamp") AS last FROM load GROUP BY 1) USING (series_id)"""


@query("m02_holdout_three_way", sql(LOAD, HOLDOUT.format(both=240)))
def holdout(spark, sf):
    return splits.holdout_split(load(spark, sf), 5, 5)


@query("m03_holdout_two_way", sql(LOAD, HOLDOUT.format(both=120)))
def holdout_two_way(spark, sf):
    return splits.holdout_split(load(spark, sf), 0, 5)


FOLDS = """folds AS (
  SELECT p.*, f.fold, CASE
      WHEN i < total - (2 - fold) * 170 - 72 - 98 THEN 'train'
      WHEN i >= total - (2 - fold) * 170 - 72 AND i < total - (2 - fold) * 170 THEN 'test' END AS role
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY "timestamp") - 1 AS i,
               count(*) OVER (PARTITION BY series_id) AS total FROM load) p,
       (SELECT CAST(unnest(range(3)) AS INTEGER) AS fold) f)"""


@query(
    "m04_expanding_folds",
    sql(f"{LOAD}, {FOLDS}", 'SELECT series_id, "timestamp", value, fold, role FROM folds WHERE role IS NOT NULL'),
)
def folds(spark, sf):
    return splits.ts_folds(load(spark, sf), 3, gap=98, test=72)


@query(
    "a16_cv_mae",
    sql(f"{LOAD}, {FOLDS},\n" + f"""scored AS (
      SELECT f.series_id, f.fold, {exact_mean_sql('abs(f.value - b.value)')} AS fold_mae
      FROM folds f LEFT JOIN load b ON b.series_id = f.series_id AND b."timestamp" = f."timestamp" - to_hours(168)
      WHERE f.role = 'test' GROUP BY 1, 2)""",
        f"SELECT series_id, {exact_mean_sql('fold_mae')} AS cv_mae, count(fold_mae) AS folds FROM scored GROUP BY 1"),
)
def cv(spark, sf):
    rows = forecast.naive_forecast(load(spark, sf), 168)
    tested = splits.ts_folds(rows, 3, gap=98, test=72).filter("role = 'test'")
    return metrics.cv_mae(tested, actual="value", predicted="baseline", by=["series_id"])


@query(
    "j02_forecasts_with_actuals",
    sql(FORECASTS, """SELECT series_id, "timestamp", forecast_run_at, model_name, horizon_hours, predicted, actual
      FROM forecasts WHERE horizon_hours = 24"""),
)
def with_actuals(spark, sf):
    facts = forecasts(spark, sf).filter("horizon_hours = 24").drop("actual", "model_version")
    return joins.attach_actuals(facts, load(spark, sf))


FUTURE_CALENDAR = calendar_of("ahead")
FUTURE = f"""{FILLS},
ranked AS (SELECT *, CAST(value AS DECIMAL(18,4)) AS v,
  row_number() OVER (PARTITION BY series_id ORDER BY "timestamp" DESC) AS rn FROM imputed
  WHERE "timestamp" <= TIMESTAMP '2024-01-30 12:00:00'),
hist AS (SELECT * FROM ranked WHERE rn <= 336),
stats AS (SELECT series_id, arg_max(value, "timestamp") FILTER (value IS NOT NULL) AS last,
  arg_max({{t: temperature, h: humidity, c: cloud_cover}}, "timestamp") AS lw,
  CAST(sum(v) FILTER (rn <= 168) AS DOUBLE) / nullif(count(v) FILTER (rn <= 168), 0) AS rolling_7d_mean,
  coalesce({std_sql("count(v) FILTER (rn <= 168)", f"sum({WHOLE}) FILTER (rn <= 168)", f"sum({WHOLE} * {WHOLE}) FILTER (rn <= 168)")}, 0.0) AS rolling_7d_std,
  CAST(sum(v) FILTER (rn <= 24) AS DOUBLE) / nullif(count(v) FILTER (rn <= 24), 0) AS rolling_24h_mean
  FROM hist GROUP BY 1 HAVING count(*) >= 168),
ahead AS (
  SELECT s.series_id, TIMESTAMP '2024-01-30 12:00:00' + to_hours(i) AS "timestamp", s.rolling_7d_mean, s.rolling_7d_std,
    s.rolling_24h_mean, s.last, s.lw
  FROM stats s, (SELECT CAST(unnest(range(1, 169)) AS INTEGER) AS i) r),
{FUTURE_CALENDAR}"""


@query(
    "m11_future_frame",
    sql(FUTURE, """SELECT c.* EXCLUDE (local_date, last, lw),
      CASE WHEN a.series_id IS NOT NULL THEN a.value ELSE c.last END AS lag_24h,
      CASE WHEN b.series_id IS NOT NULL THEN b.value ELSE c.last END AS lag_48h,
      CASE WHEN d.series_id IS NOT NULL THEN d.value ELSE c.last END AS lag_168h,
      CASE WHEN d.series_id IS NOT NULL THEN d.temperature ELSE c.lw.t END AS temperature,
      CASE WHEN d.series_id IS NOT NULL THEN d.humidity ELSE c.lw.h END AS humidity,
      CASE WHEN d.series_id IS NOT NULL THEN d.cloud_cover ELSE c.lw.c END AS cloud_cover,
      (n.holiday_date IS NOT NULL OR isodow(c.local_date + 1) >= 6) AS is_holiday_eve
      FROM calendar c
      LEFT JOIN hist a ON a.series_id = c.series_id AND a."timestamp" = c."timestamp" - to_hours(24)
      LEFT JOIN hist b ON b.series_id = c.series_id AND b."timestamp" = c."timestamp" - to_hours(48)
      LEFT JOIN hist d ON d.series_id = c.series_id AND d."timestamp" = c."timestamp" - to_hours(168)
      LEFT JOIN holidays n ON n.holiday_date = c.local_date + 1"""),
)
def future(spark, sf):
    history = impute_weather(joins.join_weather(load(spark, sf), weather(spark, sf)))
    return forecast.future_features(history, "2024-01-30 12:00:00", 168)


@query(
    "m13_naive_forecast_rows",
    sql(FUTURE, """SELECT md5('naive_168h_168_' || strftime(a."timestamp", '%Y-%m-%dT%H:%M:%S') || '+00:00') AS forecast_id,
      a.series_id, a."timestamp", a."timestamp" AS feature_timestamp, TIMESTAMP '2024-01-30 12:00:00' AS forecast_run_at,
      'naive_168h' AS model_name, 'v1' AS model_version, 168 AS horizon_hours,
      greatest(CASE WHEN d.series_id IS NOT NULL THEN d.value ELSE a.last END, 0.0) AS predicted,
      CAST(NULL AS DOUBLE) AS actual, FALSE AS is_backfilled, 'run-1' AS run_id, TIMESTAMP '2024-01-30 12:00:00' AS created_at
      FROM ahead a LEFT JOIN hist d ON d.series_id = a.series_id AND d."timestamp" = a."timestamp" - to_hours(168)"""),
)
def naive_rows(spark, sf):
    history = load(spark, sf).withColumns({c: F.lit(None).cast("double") for c in ("temperature", "humidity", "cloud_cover")})
    ahead = forecast.future_features(history, "2024-01-30 12:00:00", 168)
    return forecast.shape_forecasts(ahead, "naive_168h", "v1", 168, "2024-01-30 12:00:00", "run-1", predicted="lag_168h")


@query(
    "m10_serving_run",
    sql(MODEL_RUNS, """SELECT horizon_hours, run_id, model_name, mape FROM model_runs WHERE family IN ('mean', 'seasonal')
      QUALIFY row_number() OVER (PARTITION BY horizon_hours
        ORDER BY family = 'mean' DESC, production DESC, mape, started_at DESC, run_id) = 1"""),
)
def serving(spark, sf):
    return forecast.serving_run(model_runs(spark, sf), "mean", "seasonal").select("horizon_hours", "run_id", "model_name", "mape")
