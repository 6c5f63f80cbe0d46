"""Drift scores, prediction drift and retrain decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hourline.config import MODEL_FEATURES
from hourline.operators import windows
from hourline.plans import drift
from hourline.session import written
from hourline.workload.base import CHECKS, FORECASTS, LOAD, NOW, NOW_SQL, checks, forecasts, load, query, sql
from hourline.workload.features import MATRIX, matrix

COLUMNS = ("value", *MODEL_FEATURES)


def silver(spark, sf):
    """The feature matrix as the stored table drift checks read: they pass over it more than once."""
    return written(matrix(spark, sf), "silver")


def _wins(source: str, columns) -> str:
    cast = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"""wins AS (
  SELECT series_id, 'reference' AS w, {cast} FROM {source} WHERE "timestamp" BETWEEN {NOW_SQL} - INTERVAL 37 DAY AND {NOW_SQL} - INTERVAL 7 DAY
  UNION ALL
  SELECT series_id, 'current' AS w, {cast} FROM {source} WHERE "timestamp" BETWEEN {NOW_SQL} - INTERVAL 7 DAY AND {NOW_SQL})"""


def _long(columns) -> str:
    return f"""long AS (SELECT series_id, w, column_name, v FROM wins UNPIVOT (v FOR column_name IN ({', '.join(columns)})))"""


@query("d01_drift_windows", sql(f"{LOAD}, {_wins('load', ['value'])}", "SELECT series_id, w AS \"window\", value FROM wins"))
def drift_windows(spark, sf):
    return drift.drift_windows(load(spark, sf), NOW, ["value"]).drop("timestamp")


@query(
    "d01_enough_current_rows",
    sql(f"{LOAD}, {_wins('load', ['value'])}", """SELECT series_id, count(*) FILTER (w = 'current') AS current_rows,
      count(*) FILTER (w = 'current') >= 100 AS enough FROM wins GROUP BY 1"""),
)
def enough(spark, sf):
    return drift.enough_current(drift.drift_windows(load(spark, sf), NOW, ["value"]))


def js_sql(columns) -> str:
    return f"""{MATRIX}, {_wins('matrix', columns)}, {_long(columns)},
ends AS (SELECT series_id, column_name, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1, 2),
counted AS (
  SELECT series_id, column_name, coalesce(least(CAST(floor((v - lo) / nullif(hi - lo, 0) * 10) AS INTEGER), 9), 0) AS b,
         count(*) FILTER (w = 'reference') AS r, count(*) FILTER (w = 'current') AS c
  FROM long JOIN ends USING (series_id, column_name) GROUP BY 1, 2, 3),
shares AS (
  SELECT series_id, column_name, r / sum(r) OVER (PARTITION BY series_id, column_name) AS p,
         c / sum(c) OVER (PARTITION BY series_id, column_name) AS q FROM counted),
scores AS (
  SELECT series_id, column_name,
    CASE WHEN count(p) > 0 AND count(q) > 0 THEN
      sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 END AS score
  FROM shares GROUP BY 1, 2)"""


def rounded(df, *columns):
    """Sums of logarithms differ in the last bits between engines; compare them to six digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "d02_column_drift_js",
    sql(js_sql(COLUMNS), "SELECT series_id, column_name, round(score, 6) AS score, coalesce(score >= 0.15, FALSE) AS drifted FROM scores"),
)
def column_drift(spark, sf):
    seen = drift.drift_windows(silver(spark, sf), NOW)
    return rounded(drift.column_drift(seen, COLUMNS), "score")


CURVES = f"""{MATRIX}, {_wins('matrix', COLUMNS)}, {_long(COLUMNS)},
counted AS (SELECT series_id, column_name, v, count(*) FILTER (w = 'reference') AS r, count(*) FILTER (w = 'current') AS c FROM long GROUP BY 1, 2, 3),
curves AS (
  SELECT series_id, column_name, v, lead(v) OVER o AS next_v,
         CAST(sum(r) OVER o AS BIGINT) / CAST(sum(r) OVER p AS BIGINT) AS fr, CAST(sum(c) OVER o AS BIGINT) / CAST(sum(c) OVER p AS BIGINT) AS fc
  FROM counted WINDOW o AS (PARTITION BY series_id, column_name ORDER BY v), p AS (PARTITION BY series_id, column_name))"""


@query("d02_column_drift_ks", sql(CURVES, "SELECT series_id, column_name, max(abs(fr - fc)) AS score FROM curves GROUP BY 1, 2"))
def column_ks(spark, sf):
    return drift.column_scores(drift.drift_windows(silver(spark, sf), NOW, COLUMNS), COLUMNS, "ks")


@query(
    "d02_column_drift_wasserstein",
    sql(CURVES, """SELECT series_id, column_name, round(area / greatest(spread, 0.001), 6) AS score
      FROM (SELECT series_id, column_name, coalesce(sum(abs(fr - fc) * (next_v - v)), 0) AS area FROM curves GROUP BY 1, 2)
      JOIN (SELECT series_id, column_name, stddev_pop(v) AS spread FROM long WHERE w = 'reference' GROUP BY 1, 2) USING (series_id, column_name)"""),
)
def column_wasserstein(spark, sf):
    seen = drift.drift_windows(silver(spark, sf), NOW, COLUMNS)
    return rounded(drift.column_scores(seen, COLUMNS, "wasserstein"), "score")


DATASET = """flags AS (
  SELECT series_id, avg(CASE WHEN score >= 0.15 THEN 1.0 ELSE 0.0 END) >= 0.15 AS data_drift_detected,
    CAST(count(*) FILTER (score >= 0.15) AS INTEGER) AS n_drifted_features,
    coalesce(string_agg(column_name, ',' ORDER BY column_name) FILTER (score >= 0.15), '') AS drifted_features,
    max(score) FILTER (column_name = 'value') AS drift_score_value,
    max(score) FILTER (column_name = 'temperature') AS drift_score_temperature
  FROM scores GROUP BY 1)"""


@query(
    "d03_dataset_drift",
    sql(f"{js_sql(COLUMNS)}, {DATASET}", """SELECT * REPLACE (round(drift_score_value, 6) AS drift_score_value,
      round(drift_score_temperature, 6) AS drift_score_temperature) FROM flags"""),
)
def dataset(spark, sf):
    scores = drift.column_drift(drift.drift_windows(silver(spark, sf), NOW), COLUMNS)
    return rounded(drift.dataset_drift(scores), "drift_score_value", "drift_score_temperature")


PREDICTION = f"""predicted AS (
  SELECT *, coalesce(prediction_mae_current > prediction_mae_reference * 1.2, FALSE) AS prediction_drift_detected FROM (
    SELECT series_id,
      CASE WHEN count(actual) FILTER (cur) >= 24 THEN CAST(sum(CAST(abs(predicted - actual) AS DECIMAL(18,6))) FILTER (cur) AS DOUBLE) / count(actual) FILTER (cur) END AS prediction_mae_current,
      CASE WHEN count(actual) FILTER (ref) >= 24 THEN CAST(sum(CAST(abs(predicted - actual) AS DECIMAL(18,6))) FILTER (ref) AS DOUBLE) / count(actual) FILTER (ref) END AS prediction_mae_reference
    FROM (SELECT *, forecast_run_at BETWEEN {NOW_SQL} - INTERVAL 7 DAY AND {NOW_SQL} AS cur,
            forecast_run_at BETWEEN {NOW_SQL} - INTERVAL 37 DAY AND {NOW_SQL} - INTERVAL 7 DAY AS ref
          FROM forecasts WHERE horizon_hours = 24 AND model_name = 'seasonal_24h') WHERE cur OR ref GROUP BY 1))"""


@query("d04_prediction_drift", sql(f"{FORECASTS}, {PREDICTION}", "SELECT * FROM predicted"))
def prediction(spark, sf):
    return drift.prediction_drift(forecasts(spark, sf), NOW, model="seasonal_24h")


RUN_LENGTH = """recent AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY check_timestamp DESC) AS rn FROM history),
run_length AS (
  SELECT series_id, CAST(coalesce(min(rn) FILTER (NOT any_drift_detected) - 1, count(*)) AS INTEGER) AS consecutive
  FROM recent GROUP BY 1)"""


@query(
    "w11_consecutive_drift",
    sql(f"{CHECKS}, history AS (SELECT * FROM checks), {RUN_LENGTH}", "SELECT * FROM run_length"),
)
def consecutive(spark, sf):
    return windows.consecutive_true(checks(spark, sf), "any_drift_detected")


@query(
    "w12_cooldown",
    sql(CHECKS, f"""SELECT series_id, max(check_timestamp) FILTER (retrain_triggered) AS last_trigger,
      (epoch({NOW_SQL}) - epoch(max(check_timestamp) FILTER (retrain_triggered))) / 3600 AS hours_since_trigger FROM checks GROUP BY 1"""),
)
def cooldown(spark, sf):
    return windows.cooldown(checks(spark, sf), F.lit(NOW).cast("timestamp"))


DECISION = f"""decided AS (
  SELECT c.*, CASE WHEN any_drift_detected THEN coalesce(consecutive, 0) + 1 ELSE 0 END AS consecutive_drift_hours,
    since, p.series_id IS NOT NULL AS pending
  FROM found c LEFT JOIN run_length USING (series_id)
  LEFT JOIN (SELECT series_id, (epoch({{now}}) - epoch(max(check_timestamp) FILTER (retrain_triggered))) / 3600 AS since FROM history GROUP BY 1) USING (series_id)
  LEFT JOIN pending p ON p.series_id = c.series_id),
reasons AS (
  SELECT * EXCLUDE (since, pending), CAST(consecutive_drift_hours AS INTEGER) AS n,
    any_drift_detected AND consecutive_drift_hours >= 3 AND coalesce(since >= 24, TRUE) AND NOT pending AS retrain_triggered,
    CASE WHEN NOT any_drift_detected THEN 'No drift detected.'
      WHEN consecutive_drift_hours < 3 THEN 'Drift detected for ' || consecutive_drift_hours || 'h (threshold: 3h).'
      WHEN since < 24 THEN printf('Cooldown active: last retrain %.1fh ago.', since)
      WHEN pending THEN 'Retrain already pending (flag exists).'
      ELSE 'Drift detected for ' || consecutive_drift_hours || ' consecutive hours in features: ' || replace(drifted_features, ',', ', ') || '.' END AS reason
  FROM decided)"""


@query(
    "d05_f13_retrain_decision",
    sql(f"""{CHECKS},
      history AS (SELECT * FROM checks WHERE check_timestamp < TIMESTAMP '2024-01-20'), {RUN_LENGTH},
      found AS (SELECT series_id, drifted_features, any_drift_detected FROM checks WHERE check_timestamp = TIMESTAMP '2024-01-20'),
      pending AS (SELECT DISTINCT series_id FROM history WHERE drifted_features = 'value'),
      {DECISION.format(now="TIMESTAMP '2024-01-20'")}""",
        "SELECT series_id, drifted_features, any_drift_detected, n AS consecutive_drift_hours, retrain_triggered, reason FROM reasons"),
)
def decision(spark, sf):
    rows = checks(spark, sf)
    history = rows.filter(F.col("check_timestamp") < "2024-01-20")
    current = rows.filter(F.col("check_timestamp") == "2024-01-20").select("series_id", "drifted_features", "any_drift_detected")
    pending = history.filter("drifted_features = 'value'")
    return drift.retrain_decision(current, history, pending, "2024-01-20")


@query(
    "d06_drift_record",
    sql(f"""{js_sql(COLUMNS).replace(LOAD, FORECASTS)}, {DATASET}, {PREDICTION}, {CHECKS.replace("scores AS", "day_scores AS").replace("FROM scores", "FROM day_scores")},
      history AS (SELECT * FROM checks), {RUN_LENGTH}, pending AS (SELECT series_id FROM checks WHERE FALSE),
      found AS (
        SELECT f.*, prediction_mae_current, prediction_mae_reference, coalesce(prediction_drift_detected, FALSE) AS prediction_drift_detected,
          data_drift_detected OR coalesce(prediction_drift_detected, FALSE) AS any_drift_detected
        FROM flags f LEFT JOIN predicted USING (series_id)
        WHERE series_id IN (SELECT series_id FROM wins WHERE w = 'current' GROUP BY 1 HAVING count(*) >= 100)),
      {DECISION.format(now=NOW_SQL)}""",
        f"""SELECT series_id, {NOW_SQL} AS check_timestamp, {NOW_SQL} - INTERVAL 7 DAY AS window_start, {NOW_SQL} AS window_end,
          data_drift_detected, prediction_drift_detected, any_drift_detected, n_drifted_features, drifted_features,
          round(drift_score_value, 6) AS drift_score_value, round(drift_score_temperature, 6) AS drift_score_temperature,
          prediction_mae_current, prediction_mae_reference, n AS consecutive_drift_hours, retrain_triggered, reason FROM reasons"""),
)
def record(spark, sf):
    history = checks(spark, sf)
    found = drift.drift_check(
        silver(spark, sf), forecasts(spark, sf), history, history.filter("false"), NOW, model="seasonal_24h"
    )
    return rounded(found, "drift_score_value", "drift_score_temperature").drop("report_path", "created_at")
