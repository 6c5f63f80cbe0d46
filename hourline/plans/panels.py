"""The reports over the tables. Each is a function of its tables and of `now`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourline.functions import scalar
from hourline.operators.joins import attach_actuals, newest_run_rows
from hourline.operators.project import since_ts
from hourline.operators.windows import latest_per


def ingest_health(bronze: DataFrame, now) -> DataFrame:
    """Whole hours since the last fetch, and its status."""
    hours = scalar.hours_between(F.max("fetched_at"), scalar.as_time(now))
    return bronze.agg(hours.alias("hours_since_last_ingest")).withColumn(
        "status", scalar.health_status(F.col("hours_since_last_ingest"))
    )


def actual_vs_forecast(
    forecasts: DataFrame, actuals: DataFrame, now, pattern: str = "%gbt%", horizon: int = 24, days: int = 7
) -> DataFrame:
    """Newest forecast of each hour in the last days with the actual and the absolute error."""
    now = scalar.as_time(now)
    recent = since_ts(forecasts, scalar.days_before(now, days)).filter(
        (F.col("horizon_hours") == horizon) & F.col("model_name").like(pattern)
    )
    newest = latest_per(recent, ["series_id", "timestamp"], F.col("forecast_run_at").desc(), F.col("model_name"))
    return (
        attach_actuals(newest, actuals)
        .select(
            "series_id", "timestamp", "actual", "predicted", "model_version",
            F.abs(F.col("actual") - F.col("predicted")).alias("abs_error"),
        )
        .orderBy("timestamp", "series_id")
    )


def forward_view(forecasts: DataFrame, actuals: DataFrame, now, horizon: int = 168) -> DataFrame:
    """The newest run of the long horizon, marked where it lies in the future."""
    rows = newest_run_rows(forecasts.filter(F.col("horizon_hours") == horizon))
    future = F.col("timestamp") > scalar.as_time(now)
    return (
        attach_actuals(rows.withColumn("is_future", future), actuals)
        .select("series_id", "timestamp", "model_name", "predicted", "is_future", "actual")
        .orderBy("timestamp", "series_id", "model_name")
    )


def drift_heatmap(checks: DataFrame, now, days: int = 30) -> DataFrame:
    """Per day and drifted feature: checks, highest scores, whether a retrain was triggered."""
    recent = checks.filter(F.col("check_timestamp") >= scalar.days_before(scalar.as_time(now), days))
    exploded = recent.select(
        F.to_date("check_timestamp").alias("drift_date"),
        F.explode(scalar.split_names("drifted_features")).alias("feature_name"),
        "drift_score_value", "drift_score_temperature",
        F.col("retrain_triggered").cast("int").alias("retrain"),
    )
    return (
        exploded.groupBy("drift_date", "feature_name")
        .agg(
            F.count(F.lit(1)).alias("hours_drifted"),
            F.max("drift_score_value").alias("max_drift_score_target"),
            F.max("drift_score_temperature").alias("max_drift_score_temperature"),
            F.max("retrain").alias("any_retrain_triggered"),
        )
        .orderBy(F.col("drift_date").desc(), F.col("hours_drifted").desc(), "feature_name")
    )


def registry_status(log: DataFrame, now) -> DataFrame:
    """The newest real promotion of each model and how old it is."""
    newest = latest_per(log.filter("should_promote"), ["model_name"], F.col("promoted_at").desc())
    days = F.datediff(scalar.as_time(now), F.col("promoted_at"))
    return newest.select(
        "model_name",
        F.col("challenger_version").alias("current_production_version"),
        F.col("challenger_mape").alias("current_mape"),
        F.col("promoted_at").alias("last_promoted"),
        "promotion_reason",
        F.col("drift_triggered").alias("was_drift_triggered"),
        days.alias("days_in_production"),
        scalar.model_age(days).alias("model_age_status"),
    ).orderBy("model_name")


def promotion_history(log: DataFrame, now, days: int = 90) -> DataFrame:
    """Every decision of the last days with its outcome and the change in MAPE."""
    first, promoted = F.col("first_run"), F.col("should_promote")
    gain = scalar.ratio_pct(F.col("champion_mape") - F.col("challenger_mape"), F.col("champion_mape"))
    return (
        log.filter(F.col("promoted_at") >= scalar.days_before(scalar.as_time(now), days))
        .select(
            "promoted_at", scalar.decision_icon(first, promoted).alias("outcome"), "model_name",
            scalar.decision_label(first, promoted).alias("decision"),
            "challenger_version", "challenger_mape", "champion_version", "champion_mape",
            F.round(gain, 2).alias("mape_change_pct"),
            "promotion_reason", "drift_triggered", "drifted_features", "promoted_by",
        )
        .orderBy(F.col("promoted_at").desc(), "model_name")
    )


def _since(df: DataFrame, now, hours: int, ts: str, columns: Sequence[str]) -> DataFrame:
    start = scalar.hours_before(scalar.as_time(now), hours)
    return since_ts(df, start, ts).select(*columns).orderBy(ts)


def load_forecasts(forecasts: DataFrame, now, hours: int = 720) -> DataFrame:
    columns = ("series_id", "timestamp", "predicted", "actual", "model_name", "horizon_hours", "model_version")
    return _since(forecasts, now, hours, "timestamp", columns)


def load_drift(checks: DataFrame, now, hours: int = 720) -> DataFrame:
    columns = (
        "series_id", "check_timestamp", "window_start", "window_end", "data_drift_detected",
        "prediction_drift_detected", "any_drift_detected", "n_drifted_features", "drifted_features",
        "drift_score_value", "drift_score_temperature", "prediction_mae_current",
        "prediction_mae_reference", "consecutive_drift_hours", "retrain_triggered",
    )
    return _since(checks, now, hours, "check_timestamp", columns)


def model_list(forecasts: DataFrame, horizon: int) -> DataFrame:
    """The models with forecasts of a horizon, and whether any of their hours is measured yet."""
    return (
        forecasts.filter(F.col("horizon_hours") == horizon)
        .groupBy("model_name")
        .agg(F.bool_or(F.col("actual").isNotNull()).alias("has_actuals"))
        .orderBy("model_name")
    )


def mae_trend(checks: DataFrame) -> DataFrame:
    """MAE and drift scores over time, for charts."""
    return checks.select(
        "series_id", "check_timestamp", "prediction_mae_current", "prediction_mae_reference",
        "drift_score_value", "drift_score_temperature", "n_drifted_features",
    ).orderBy("check_timestamp", "series_id")


def newest_check(checks: DataFrame) -> DataFrame:
    """The newest row per series, for the figures on top of a page."""
    return latest_per(checks, ["series_id"], F.col("check_timestamp").desc())
