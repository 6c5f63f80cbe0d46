"""The reports over forecasts, checks and promotions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline.plans import panels
from hourline.workload.base import (
    CHECKS, FORECASTS, NOW, NOW_SQL, checks, events, forecasts, load, query, sql,
)


@query(
    "a12_ingest_health",
    f"""SELECT h AS hours_since_last_ingest, CASE WHEN h < 2 THEN 'HEALTHY' WHEN h < 6 THEN 'WARNING' ELSE 'CRITICAL' END AS status
        FROM (SELECT CAST(floor((epoch({NOW_SQL}) - epoch(max(ts))) / 3600) AS BIGINT) AS h FROM events)""",
)
def health(spark, sf):
    return panels.ingest_health(events(spark, sf).select(F.col("ts").alias("fetched_at")), NOW)


@query(
    "m14_actual_vs_forecast",
    sql(FORECASTS, f"""SELECT f.series_id, f."timestamp", l.value AS actual, predicted, model_version, abs(l.value - predicted) AS abs_error
      FROM (SELECT * FROM forecasts WHERE horizon_hours = 24 AND model_name LIKE '%seasonal%' AND "timestamp" >= {NOW_SQL} - INTERVAL 7 DAY
            QUALIFY row_number() OVER (PARTITION BY series_id, "timestamp" ORDER BY forecast_run_at DESC, model_name) = 1) f
      LEFT JOIN load l ON l.series_id = f.series_id AND l."timestamp" = f."timestamp" """),
)
def actual_vs_forecast(spark, sf):
    return panels.actual_vs_forecast(forecasts(spark, sf), load(spark, sf), NOW, "%seasonal%")


@query(
    "m15_j03_forward_view",
    sql(FORECASTS, f"""SELECT f.series_id, f."timestamp", model_name, predicted, f."timestamp" > {NOW_SQL} AS is_future, l.value AS actual
      FROM forecasts f LEFT JOIN load l ON l.series_id = f.series_id AND l."timestamp" = f."timestamp"
      WHERE horizon_hours = 168 AND forecast_run_at = (SELECT max(forecast_run_at) FROM forecasts WHERE horizon_hours = 168)"""),
)
def forward(spark, sf):
    return panels.forward_view(forecasts(spark, sf), load(spark, sf), NOW)


@query(
    "a11_f11_drift_heatmap",
    sql(CHECKS, f"""SELECT CAST(CAST(check_timestamp AS DATE) AS VARCHAR) AS drift_date, feature_name, count(*) AS hours_drifted,
      max(drift_score_value) AS max_drift_score_target, max(drift_score_temperature) AS max_drift_score_temperature,
      max(CAST(retrain_triggered AS INTEGER)) AS any_retrain_triggered
      FROM (SELECT *, unnest(CASE WHEN drifted_features = '' THEN ['none'] ELSE string_split(drifted_features, ',') END) AS feature_name
            FROM checks WHERE check_timestamp >= {NOW_SQL} - INTERVAL 30 DAY) GROUP BY 1, 2"""),
)
def heatmap(spark, sf):
    return panels.drift_heatmap(checks(spark, sf), NOW)


@query(
    "s21_forecasts_since",
    sql(FORECASTS, f"""SELECT series_id, "timestamp", predicted, actual, model_name, horizon_hours, model_version
      FROM forecasts WHERE "timestamp" >= {NOW_SQL} - INTERVAL 240 HOUR"""),
)
def since(spark, sf):
    return panels.load_forecasts(forecasts(spark, sf), NOW, 240)


def charted(spark, sf):
    blank = {c: F.lit(None).cast("double") for c in ("prediction_mae_reference",)}
    return checks(spark, sf).withColumn("prediction_mae_current", F.col("mae")).withColumns(blank)


@query(
    "s21_drift_since",
    sql(CHECKS, f"""SELECT series_id, check_timestamp, check_timestamp - INTERVAL 7 DAY AS window_start, check_timestamp AS window_end,
      any_drift_detected AS data_drift_detected, FALSE AS prediction_drift_detected, any_drift_detected, n_drifted_features,
      drifted_features, drift_score_value, drift_score_temperature, mae AS prediction_mae_current,
      CAST(NULL AS DOUBLE) AS prediction_mae_reference, 0 AS consecutive_drift_hours, retrain_triggered
      FROM checks WHERE check_timestamp >= {NOW_SQL} - INTERVAL 240 HOUR"""),
)
def drift_since(spark, sf):
    rows = charted(spark, sf).withColumns(
        {
            "window_start": F.timestamp_add("DAY", F.lit(-7), F.col("check_timestamp")),
            "window_end": F.col("check_timestamp"), "data_drift_detected": F.col("any_drift_detected"),
            "prediction_drift_detected": F.lit(False), "consecutive_drift_hours": F.lit(0),
        }
    )
    return panels.load_drift(rows, NOW, 240)


@query(
    "d07_mae_trend",
    sql(CHECKS, """SELECT series_id, check_timestamp, mae AS prediction_mae_current, CAST(NULL AS DOUBLE) AS prediction_mae_reference,
      drift_score_value, drift_score_temperature, n_drifted_features FROM checks"""),
)
def trend(spark, sf):
    return panels.mae_trend(charted(spark, sf))


@query(
    "t05_newest_check",
    sql(CHECKS, "SELECT * FROM checks QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY check_timestamp DESC) = 1"),
)
def newest(spark, sf):
    return panels.newest_check(checks(spark, sf))
