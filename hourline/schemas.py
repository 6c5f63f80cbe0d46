"""Declared schemas; readers apply them, nothing is inferred.

`series_id` is the series key on every table, so one plan serves any number of series.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_TS, _STR, _DBL = T.TimestampType(), T.StringType(), T.DoubleType()
_INT, _BOOL, _DATE = T.IntegerType(), T.BooleanType(), T.DateType()

LANDING_LOAD = _schema(
    ("timestamp", _TS, False), ("series_id", _STR, False), ("value", _DBL, True),
    ("source", _STR, False), ("fetched_at", _TS, False),
)
BRONZE_LOAD = T.StructType(
    LANDING_LOAD.fields + _schema(("run_id", _STR, False), ("is_gap", _BOOL, False)).fields
)
LANDING_WEATHER = _schema(
    ("timestamp", _TS, False), ("series_id", _STR, False),
    ("temperature", _DBL, True), ("humidity", _DBL, True), ("cloud_cover", _DBL, True),
    ("is_weather_imputed", _BOOL, False), ("source", _STR, False), ("fetched_at", _TS, False),
)
BRONZE_WEATHER = T.StructType(LANDING_WEATHER.fields + _schema(("run_id", _STR, False)).fields)

SILVER_FEATURES = _schema(
    ("timestamp", _TS, False), ("series_id", _STR, False), ("value", _DBL, True),
    ("is_gap", _BOOL, False),
    ("hour_of_day", _INT, False), ("day_of_week", _INT, False), ("month", _INT, False),
    ("quarter", _INT, False), ("is_weekend", _BOOL, False), ("is_holiday", _BOOL, False),
    ("is_holiday_eve", _BOOL, False), ("days_since_epoch", _INT, False),
    ("lag_24h", _DBL, True), ("lag_48h", _DBL, True), ("lag_168h", _DBL, True),
    ("has_lag_gap", _BOOL, False),
    ("rolling_7d_mean", _DBL, True), ("rolling_7d_std", _DBL, True),
    ("rolling_24h_mean", _DBL, True),
    ("temperature", _DBL, True), ("humidity", _DBL, True), ("cloud_cover", _DBL, True),
    ("temperature_lag_24h", _DBL, True), ("is_weather_imputed", _BOOL, False),
    ("temp_missing", _BOOL, False), ("source", _STR, True), ("fetched_at", _TS, True),
    ("feature_built_at", _TS, False), ("run_id", _STR, False),
)
FORECASTS = _schema(
    ("forecast_id", _STR, False), ("series_id", _STR, False), ("timestamp", _TS, False),
    ("feature_timestamp", _TS, True), ("forecast_run_at", _TS, False),
    ("model_name", _STR, False), ("model_version", _STR, False), ("horizon_hours", _INT, False),
    ("predicted", _DBL, False), ("actual", _DBL, True), ("is_backfilled", _BOOL, False),
    ("run_id", _STR, False), ("created_at", _TS, False),
)
DRIFT_CONTROL = _schema(
    ("series_id", _STR, False), ("check_timestamp", _TS, False), ("window_start", _TS, False),
    ("window_end", _TS, False), ("data_drift_detected", _BOOL, False),
    ("prediction_drift_detected", _BOOL, False), ("any_drift_detected", _BOOL, False),
    ("n_drifted_features", _INT, False), ("drifted_features", _STR, True),
    ("drift_score_value", _DBL, True), ("drift_score_temperature", _DBL, True),
    ("prediction_mae_current", _DBL, True), ("prediction_mae_reference", _DBL, True),
    ("consecutive_drift_hours", _INT, False), ("retrain_triggered", _BOOL, False),
    ("report_path", _STR, True), ("created_at", _TS, False),
)
MODEL_RUNS = _schema(
    ("run_id", _STR, False), ("model_name", _STR, False), ("family", _STR, False),
    ("horizon_hours", _INT, False), ("started_at", _TS, False),
    ("mae", _DBL, True), ("rmse", _DBL, True), ("mape", _DBL, True),
    ("naive_mae", _DBL, True), ("naive_rmse", _DBL, True), ("naive_mape", _DBL, True),
    ("n_train", T.LongType(), True), ("n_test", T.LongType(), True),
    ("training_data_start", _TS, True), ("training_data_end", _TS, True),
    ("params", T.MapType(_STR, _STR), True), ("model_path", _STR, True),
    ("production", _BOOL, False), ("promoted_at", _TS, True),
)
MODEL_EVALUATION = _schema(
    ("model_name", _STR, False), ("horizon_hours", _INT, False),
    ("challenger_run_id", _STR, False), ("challenger_mae", _DBL, True),
    ("challenger_rmse", _DBL, True), ("challenger_mape", _DBL, True),
    ("baseline_mae", _DBL, True), ("baseline_rmse", _DBL, True), ("baseline_mape", _DBL, True),
    ("beats_baseline", _BOOL, True), ("champion_run_id", _STR, True),
    ("champion_mae", _DBL, True), ("champion_rmse", _DBL, True), ("champion_mape", _DBL, True),
    ("challenger_wins", _BOOL, False), ("first_run", _BOOL, False),
    ("evaluated_at", _TS, False), ("promoted", _BOOL, False),
)
PROMOTION_LOG = _schema(
    ("promotion_id", _STR, False), ("promoted_at", _TS, False), ("model_name", _STR, False),
    ("challenger_run_id", _STR, False), ("challenger_version", _STR, True),
    ("challenger_mape", _DBL, True), ("champion_run_id", _STR, True),
    ("champion_version", _STR, True), ("champion_mape", _DBL, True),
    ("should_promote", _BOOL, False), ("promotion_reason", _STR, True),
    ("first_run", _BOOL, False), ("drift_triggered", _BOOL, False),
    ("drifted_features", _STR, True), ("promoted_by", _STR, False), ("created_at", _TS, False),
)
INGESTION_LOG = _schema(
    ("run_id", _STR, False), ("run_date", _TS, False), ("files_found", _INT, False),
    ("files_missing", _INT, False), ("rows_ingested", T.LongType(), False),
    ("null_count", T.LongType(), False), ("schema_errors", T.LongType(), False),
    ("dry_run", _BOOL, False), ("written_at", _TS, False), ("date", _DATE, True),
)
RETRAINING_FLAGS = _schema(
    ("flag_id", _STR, False), ("series_id", _STR, False), ("triggered_at", _TS, False),
    ("reason", _STR, True), ("consecutive_drift_hours", _INT, True),
    ("drifted_features", T.ArrayType(_STR), True), ("version", _STR, True),
)
FLAG_CONSUMPTION = _schema(("flag_id", _STR, False), ("consumed_at", _TS, False))

TABLES = {
    "bronze_load": BRONZE_LOAD, "bronze_weather": BRONZE_WEATHER,
    "silver_features": SILVER_FEATURES, "forecasts": FORECASTS,
    "drift_control": DRIFT_CONTROL, "model_runs": MODEL_RUNS,
    "model_evaluation": MODEL_EVALUATION, "promotion_log": PROMOTION_LOG,
    "ingestion_log": INGESTION_LOG, "retraining_flags": RETRAINING_FLAGS,
    "flag_consumption": FLAG_CONSUMPTION,
}
