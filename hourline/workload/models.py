"""Training, tuning, attribution, and the life of a model run."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from hourline.plans import forecast, ml, panels, runs, splits
from hourline.session import scratch_path, written
from hourline.workload.base import MODEL_RUNS, NOW, NOW_SQL, checks, model_runs, query, sql, stored_runs
from hourline.workload.accuracy import score_sql
from hourline.workload.features import MATRIX, at_sql, known_sql, matrix

EVALUATED = f"""{MODEL_RUNS},
challengers AS (SELECT * FROM model_runs QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY started_at DESC, run_id) = 1),
champions AS (
  SELECT c.run_id AS challenger_run_id, r.run_id, r.mae, r.rmse, r.mape FROM challengers c
  JOIN model_runs r ON r.model_name = c.model_name AND r.run_id <> c.run_id
  QUALIFY row_number() OVER (PARTITION BY c.run_id ORDER BY r.mape NULLS LAST, r.started_at DESC, r.run_id) = 1),
evaluation AS (
  SELECT c.model_name, c.horizon_hours, c.run_id AS challenger_run_id, c.mae AS challenger_mae, c.rmse AS challenger_rmse,
    c.mape AS challenger_mape, c.naive_mae AS baseline_mae, c.naive_rmse AS baseline_rmse, c.naive_mape AS baseline_mape,
    c.mape < c.naive_mape AS beats_baseline, h.run_id AS champion_run_id, h.mae AS champion_mae, h.rmse AS champion_rmse,
    h.mape AS champion_mape, h.run_id IS NULL OR coalesce((h.mape - c.mape) / nullif(h.mape, 0) > 0.01, FALSE) AS challenger_wins,
    h.run_id IS NULL AS first_run, {NOW_SQL} AS evaluated_at, FALSE AS promoted
  FROM challengers c LEFT JOIN champions h ON h.challenger_run_id = c.run_id)"""


def evaluated(spark, sf):
    return runs.champion_challenger(stored_runs(spark, sf), NOW)


@query("m16_m17_j09_champion_challenger", sql(EVALUATED, "SELECT * FROM evaluation"))
def champion_challenger(spark, sf):
    return evaluated(spark, sf)


@query(
    "m18_recommendations",
    sql(EVALUATED, """SELECT model_name, printf('%s: %s (MAPE: %.2f%% vs %s)', CASE WHEN challenger_wins THEN 'PROMOTE' ELSE 'SKIP' END, model_name,
        challenger_mape, CASE WHEN coalesce(champion_mape, 0) = 0 THEN 'N/A' ELSE printf('%.2f', champion_mape) END) AS recommendation,
      CASE WHEN NOT beats_baseline THEN printf('WARNING: %s does NOT beat the naive baseline (model %.2f%% vs baseline %.2f%%).',
        model_name, challenger_mape, baseline_mape) END AS warning FROM evaluation"""),
)
def recommendations(spark, sf):
    return runs.recommend(evaluated(spark, sf))


DECIDED = f"""{EVALUATED},
serving AS (SELECT * FROM model_runs WHERE production QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY mape NULLS LAST, run_id) = 1),
gains AS (
  SELECT e.model_name, e.challenger_run_id, e.challenger_mape, s.run_id AS champion_run_id, s.mape AS champion_mape,
    coalesce(s.mape, 0) = 0 AS first_run, (s.mape - e.challenger_mape) / nullif(s.mape, 0) AS gain
  FROM evaluation e LEFT JOIN serving s ON s.model_name = e.model_name),
decisions AS (
  SELECT * EXCLUDE (gain), first_run OR coalesce(gain > 0.01, FALSE) AS should_promote,
    CASE WHEN first_run THEN 'No Production version exists — promoting unconditionally'
      WHEN challenger_mape IS NULL THEN 'Invalid challenger metrics — promotion skipped'
      WHEN gain > 0.01 THEN printf('MAPE improved by %.2f%% (%.3f%% -> %.3f%%)', gain * 100, champion_mape, challenger_mape)
      ELSE printf('Insufficient improvement (%.2f%% < 1.00%%). Keeping champion.', gain * 100) END AS promotion_reason
  FROM gains)"""


def decided(spark, sf):
    stored = stored_runs(spark, sf)
    return runs.decide_promotions(runs.champion_challenger(stored, NOW), stored)


@query("m19_f13_promotion_decisions", sql(DECIDED, "SELECT * FROM decisions"))
def decisions(spark, sf):
    return decided(spark, sf)


@query(
    "m20_promoted_runs",
    sql(DECIDED, f"""SELECT run_id, model_name, started_at,
      CASE WHEN run_id IN (SELECT challenger_run_id FROM decisions WHERE should_promote) THEN TRUE
           WHEN run_id IN (SELECT champion_run_id FROM decisions WHERE should_promote) THEN FALSE ELSE production END AS production,
      CASE WHEN run_id IN (SELECT challenger_run_id FROM decisions WHERE should_promote) THEN {NOW_SQL} END AS promoted_at FROM model_runs"""),
)
def promoted_runs(spark, sf):
    all_runs = stored_runs(spark, sf).withColumn("promoted_at", F.lit(None).cast("timestamp"))
    evaluation = runs.champion_challenger(all_runs, NOW)
    chosen = runs.decide_promotions(evaluation, all_runs)
    tagged, _ = runs.apply_promotions(chosen, all_runs, evaluation, NOW)
    return tagged.select("run_id", "model_name", "started_at", "production", "promoted_at")


LOGGED = f"""{DECIDED},
log AS (
  SELECT md5(model_name || '_' || challenger_run_id || '_2024-01-31T00:00:00+00:00') AS promotion_id, {NOW_SQL} AS promoted_at, model_name,
    challenger_run_id, 'v2' AS challenger_version, challenger_mape, champion_run_id, CAST(NULL AS VARCHAR) AS champion_version, champion_mape,
    should_promote, promotion_reason, first_run, TRUE AS drift_triggered, 'temperature,value' AS drifted_features,
    'automated_pipeline' AS promoted_by, {NOW_SQL} AS created_at FROM decisions)"""


def logged(spark, sf):
    pending = checks(spark, sf).filter("retrain_triggered").select(
        F.split("drifted_features", ",").alias("drifted_features")
    )
    return runs.promotion_log(decided(spark, sf), NOW, pending, "v2")


@query("m21_promotion_log", sql(LOGGED, "SELECT * FROM log"))
def promotion_log(spark, sf):
    return logged(spark, sf)


AGE = """CASE WHEN days_in_production > 30 THEN 'STALE — consider retraining' WHEN days_in_production > 14 THEN 'AGING' ELSE 'FRESH' END"""


def history(spark, sf):
    """Every run as if it had been decided on in its week: promoted when it beat the naive forecast."""
    beats = F.col("mape") < F.col("naive_mape")
    return model_runs(spark, sf).select(
        "model_name", F.col("started_at").alias("promoted_at"), F.lit("v1").alias("challenger_version"),
        F.col("mape").alias("challenger_mape"), F.lit("v0").alias("champion_version"), F.col("naive_mape").alias("champion_mape"),
        (beats | F.col("production")).alias("should_promote"), F.col("production").alias("first_run"),
        F.lit("weekly").alias("promotion_reason"), F.lit(False).alias("drift_triggered"), F.lit("").alias("drifted_features"),
        F.lit(runs.PROMOTED_BY).alias("promoted_by"),
    )


HISTORY = f"""{MODEL_RUNS},
log AS (
  SELECT model_name, started_at AS promoted_at, 'v1' AS challenger_version, mape AS challenger_mape, 'v0' AS champion_version,
    naive_mape AS champion_mape, mape < naive_mape OR production AS should_promote, production AS first_run, 'weekly' AS promotion_reason,
    FALSE AS drift_triggered, '' AS drifted_features, 'automated_pipeline' AS promoted_by FROM model_runs)"""


@query(
    "m22_registry_status",
    sql(HISTORY, f"""SELECT *, {AGE} AS model_age_status FROM (
      SELECT model_name, challenger_version AS current_production_version, challenger_mape AS current_mape, promoted_at AS last_promoted,
        promotion_reason, drift_triggered AS was_drift_triggered,
        CAST(datediff('day', CAST(promoted_at AS DATE), CAST({NOW_SQL} AS DATE)) AS INTEGER) AS days_in_production
      FROM log WHERE should_promote QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY promoted_at DESC) = 1)"""),
)
def registry_status(spark, sf):
    return panels.registry_status(history(spark, sf), NOW)


@query(
    "m23_p08_promotion_history",
    sql(HISTORY, f"""SELECT promoted_at, CASE WHEN first_run THEN '🆕' WHEN should_promote THEN '✅' ELSE '⏭️' END AS outcome, model_name,
      CASE WHEN first_run THEN 'FIRST RUN' WHEN should_promote THEN 'PROMOTED' ELSE 'SKIPPED' END AS decision,
      challenger_version, challenger_mape, champion_version, champion_mape,
      round((champion_mape - challenger_mape) / nullif(champion_mape, 0) * 100, 2) AS mape_change_pct,
      promotion_reason, drift_triggered, drifted_features, promoted_by FROM log WHERE promoted_at >= {NOW_SQL} - INTERVAL 90 DAY"""),
)
def promotion_history(spark, sf):
    return panels.promotion_history(history(spark, sf), NOW)


# --- training -------------------------------------------------------------------------------------
# What trees and curves predict is beyond SQL: those columns are checked by rows here and by behaviour in the tests. The
# facts beside them (rows, bounds, naive metrics, sums of products) have SQL.

TREES_SQL = f"""{MATRIX},
framed AS (SELECT * FROM (SELECT *, {at_sql('value', 24)} AS target FROM matrix) WHERE target IS NOT NULL AND {known_sql(ml.MODEL_FEATURES)}),
parts AS (SELECT f.*, CASE WHEN "timestamp" <= last - INTERVAL 10 DAY THEN 'train' WHEN "timestamp" <= last - INTERVAL 5 DAY THEN 'val' ELSE 'test' END AS split
  FROM framed f JOIN (SELECT series_id, max("timestamp") AS last FROM framed GROUP BY 1) USING (series_id))"""
CURVES_SQL = f"""{MATRIX},
usable AS (SELECT * FROM matrix WHERE value > -1 AND temperature IS NOT NULL),
parts AS (SELECT u.*, CASE WHEN "timestamp" <= last - INTERVAL 5 DAY THEN 'train' ELSE 'test' END AS split
  FROM usable u JOIN (SELECT series_id, max("timestamp") AS last FROM usable GROUP BY 1) USING (series_id))"""
_fitted: dict[tuple[str, str, int], ml.Trained] = {}


def trained_trees(spark, sf, horizon: int = 24) -> ml.Trained:
    """Boosted trees with the library's defaults on every series and input, fitted once for the queries that use them."""
    key = (spark.sparkContext.applicationId, sf, horizon)
    if key not in _fitted:
        baseline = "value" if horizon else "lag_24h"
        _fitted[key] = ml.train_gbt(matrix(spark, sf), horizon, min_rows=200, baseline=baseline)
    return _fitted[key]


@query("m06_m09_gbt_scores")
def gbt_scores(spark, sf):
    """Boosted trees for 24 hours ahead on the whole matrix, as a row of the run table."""
    trained = trained_trees(spark, sf)
    return runs.run_record(spark, trained.record("run-1", "gbt_24h", "gbt", 24, trained.training_end)).drop("params")


@query(
    "m09_gbt_run_facts",
    sql(TREES_SQL, f"""SELECT * FROM
      (SELECT count(*) AS n_train, min("timestamp") AS training_data_start, max("timestamp") AS training_data_end FROM parts WHERE split = 'train'),
      (SELECT count(*) AS n_test FROM parts WHERE split = 'test'),
      (SELECT {score_sql('target - value', 'target', 'naive_')} FROM parts WHERE split = 'test' AND value IS NOT NULL)""").replace(", count(*) AS naive_n", ""),
)
def gbt_run_facts(spark, sf):
    """What the run table records beside the model's own scores."""
    trained = trained_trees(spark, sf)
    record = runs.run_record(spark, trained.record("run-1", "gbt_24h", "gbt", 24, trained.training_end))
    return record.select("n_train", "n_test", "training_data_start", "training_data_end", "naive_mae", "naive_rmse", "naive_mape")


@query("m07_seasonal_scores")
def seasonal_scores(spark, sf):
    """A curve per series, scored on the series' own test days."""
    return ml.train_seasonal(matrix(spark, sf), 24).scores


@query(
    "m07_seasonal_facts",
    sql(CURVES_SQL, f"""SELECT * FROM
      (SELECT series_id, count(*) AS n_train, min("timestamp") AS training_data_start, max("timestamp") AS training_data_end
        FROM parts WHERE split = 'train' GROUP BY 1 HAVING count(*) >= 200)
      LEFT JOIN (SELECT series_id, count(*) AS n_test FROM parts WHERE split = 'test' GROUP BY 1) USING (series_id)
      LEFT JOIN (SELECT series_id, {score_sql('value - lag_24h', 'value', 'naive_')} FROM parts
        WHERE split = 'test' AND lag_24h IS NOT NULL GROUP BY 1) USING (series_id)""").replace(", count(*) AS naive_n", ""),
)
def seasonal_facts(spark, sf):
    return ml.train_seasonal(matrix(spark, sf), 24).scores.drop("mae", "rmse", "mape")


def _terms_sql() -> str:
    days = "floor(epoch(\"timestamp\")) / 86400.0::DOUBLE"
    terms = {"trend": f"{days} / 365.25::DOUBLE - 45.0"}
    for name, (period, order) in ml.SEASONS.items():
        for k in range(1, order + 1):
            angle = f"{days} * {2 * math.pi * k / period!r}::DOUBLE"
            terms |= {f"{name}_sin_{k}": f"sin({angle})", f"{name}_cos_{k}": f"cos({angle})"}
    return ", ".join(f"{{'term': '{n}', 'x': {x}}}" for n, x in (terms | {"temperature": "temperature"}).items())


@query(
    "m07_seasonal_sums",
    sql(CURVES_SQL, f"""SELECT series_id, term, count(*) AS n, round(sum(x), 6) AS sum_x, round(sum(x * x), 6) AS sum_xx, round(sum(x * y), 6) AS sum_xy
      FROM (SELECT series_id, ln(1 + value) AS y, unnest([{_terms_sql()}], recursive := true) FROM parts WHERE split = 'train') GROUP BY 1, 2"""),
)
def seasonal_sums(spark, sf):
    """The sums that the curves are solved from: per series and term with 1, itself and the logarithm of the value."""
    usable = matrix(spark, sf).na.drop(subset=["value", "temperature"]).filter("value > -1")
    train = splits.holdout_split(usable, 0, 5).filter("split = 'train'")
    names = [*ml.seasonal_terms(), "temperature"]
    size = len(names) + 2
    sums = ml.gram_sums(train, [*ml.seasonal_terms().values(), F.col("temperature")], F.log1p("value"))
    cells = sums.select("series_id", F.posexplode("gram").alias("at", "v")).groupBy("series_id", "at").agg(F.sum("v").alias("v"))
    row, column = F.floor(F.col("at") / size), F.col("at") % size
    places = cells.withColumn("i", F.when(row == 0, column).when((column == size - 1) | (column == row), row))
    wanted = places.filter((F.col("i") >= 1) & (F.col("i") < size - 1))
    one = lambda at: F.round(F.max(F.when(F.col("at") == at, F.col("v"))), 6)
    whole = cells.filter("at = 0").select("series_id", F.col("v").cast("long").alias("n"))
    return wanted.groupBy("series_id", "i").agg(
        one(F.col("i")).alias("sum_x"), one(F.col("i") * size + F.col("i")).alias("sum_xx"), one(F.col("i") * size + size - 1).alias("sum_xy"),
    ).join(whole, "series_id").select(
        "series_id", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i").cast("int")).alias("term"), "n", "sum_x", "sum_xx", "sum_xy")


@query("m08_tuned_params")
def tuned(spark, sf):
    """All inputs, the whole search space and all folds; fewer trials and rounds than the library's 25 and 100 (see README)."""
    best = ml.tune(ml.model_frame(matrix(spark, sf), 24), 24, trials=3, gap=12, test=24, rounds=9)
    return spark.createDataFrame([(k, str(v)) for k, v in best.items()], "parameter string, value string")


@query("m13_gbt_forecast_rows")
def gbt_forecasts(spark, sf):
    """Forecasts of the day after the newest hour from measured features, with a stored model loaded again."""
    path = ml.save_model(trained_trees(spark, sf), scratch_path(spark, "gbt_24h"))
    predicted = ml.direct_forecast(ml.load_model(path), written(matrix(spark, sf), "features"), "2024-01-30 23:00:00", 24)
    return forecast.shape_forecasts(
        predicted, "gbt_24h", "run-1", 24, "2024-01-30 23:00:00", "run-1", target_hours_ahead=24
    )


@query("m11_m13_gbt_future_rows")
def gbt_future(spark, sf):
    """Forecasts of the 24 hours after the run from the future frame, by trees trained on the features' own hour."""
    features = written(matrix(spark, sf), "features")
    trained = trained_trees(spark, sf, 0)
    ahead = forecast.future_features(features, "2024-01-30 12:00:00", 24)
    ready = ml.filled_inputs(ahead, features.filter(F.col("timestamp") <= "2024-01-30 12:00:00"), trained.features)
    return forecast.shape_forecasts(trained.model.transform(ready), "gbt_24h", "run-1", 24, "2024-01-30 12:00:00", "run-1")


@query("m24_feature_importance")
def importance(spark, sf):
    trained = trained_trees(spark, sf)
    test = splits.holdout_split(ml.model_frame(matrix(spark, sf), 24)).filter("split = 'test'")
    permuted = ml.permutation_importance(trained, written(test, "test-rows")).select("feature", F.col("importance").alias("mae_increase"))
    return ml.gain_importance(trained, spark).join(permuted, "feature")
