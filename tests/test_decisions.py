from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from series import hour

from hourline import schemas
from hourline.plans import drift, panels, runs


def two_windows(spark, reference, current, name="value"):
    rows = [("A", "reference", v) for v in reference] + [("A", "current", v) for v in current]
    return spark.createDataFrame(rows, f"series_id string, window string, {name} double")


def score(spark, reference, current, method):
    return drift.column_scores(two_windows(spark, reference, current), ["value"], method).first().score


@pytest.mark.parametrize("method", drift.METHODS)
def test_equal_windows_have_no_distance(spark, method):
    values = [float(i % 17) for i in range(200)]
    assert score(spark, values, values, method) == 0.0


def test_separate_windows_are_one_bit_apart(spark):
    assert score(spark, [0.0] * 50, [10.0] * 70, "js") == pytest.approx(1.0)
    assert score(spark, [0.0] * 50, [10.0] * 70, "ks") == 1.0


def test_a_constant_column_does_not_drift(spark):
    assert score(spark, [3.0] * 50, [3.0] * 20, "js") == 0.0


def test_a_window_without_values_has_no_score(spark):
    out = drift.column_drift(two_windows(spark, [1.0, 2.0], [None]), ["value"]).first()
    assert out.score is None and out.drifted is False


def test_distances_equal_brute_force(spark):
    import random

    rnd = random.Random(5)
    ref, cur = [rnd.expovariate(1) for _ in range(700)], [rnd.expovariate(0.7) for _ in range(300)]
    points = sorted(set(ref + cur))

    def cdf(values, x):
        return sum(v <= x for v in values) / len(values)

    gaps = [abs(cdf(ref, x) - cdf(cur, x)) for x in points]
    assert score(spark, ref, cur, "ks") == pytest.approx(max(gaps))
    area = sum(g * (b - a) for g, a, b in zip(gaps, points, points[1:]))
    mean = sum(ref) / len(ref)
    spread = math.sqrt(sum((v - mean) ** 2 for v in ref) / len(ref))
    assert score(spark, ref, cur, "wasserstein") == pytest.approx(area / spread)
    with pytest.raises(ValueError):
        score(spark, ref, cur, "chi")


@pytest.mark.parametrize("method", drift.METHODS)
def test_all_series_as_one_population(spark, method):
    one = two_windows(spark, [float(i % 13) for i in range(90)], [float(i % 7) for i in range(50)])
    split = one.withColumn("series_id", F.when(F.col("value") > 3, "B").otherwise("A"))
    whole = drift.column_scores(split, ["value"], method, keys=(), cuts=5).first().score
    assert whole == pytest.approx(drift.column_scores(one, ["value"], method).first().score)


def test_dataset_drift_lists_the_columns(spark):
    scores = spark.createDataFrame(
        [("A", "value", 0.12, True), ("A", "temperature", 0.25, True), ("A", "humidity", 0.0, False)],
        "series_id string, column_name string, score double, drifted boolean",
    )
    row = drift.dataset_drift(scores).first()
    assert (row.data_drift_detected, row.n_drifted_features, row.drifted_features) == (True, 2, "temperature,value")
    assert (row.drift_score_value, row.drift_score_temperature) == (0.12, 0.25)


def test_windows_share_their_bound(spark):
    now = hour(24 * 40)
    rows = [("A", hour(24 * 33), 1.0), ("A", hour(24 * 33 + 1), 2.0), ("A", hour(24 * 2), 3.0), ("A", hour(1), 4.0)]
    data = spark.createDataFrame(rows, "series_id string, timestamp timestamp, value double")
    got = sorted((r.value, r.window) for r in drift.drift_windows(data, now, ["value"]).collect())
    assert got == [(1.0, "current"), (1.0, "reference"), (2.0, "current")]
    logged = drift.drift_windows(data, now, ["value"], (hour(0), hour(24 * 2)))
    assert sorted((r.value, r.window) for r in logged.collect()) == [
        (1.0, "current"), (2.0, "current"), (3.0, "reference"), (4.0, "reference"),
    ]
    assert not drift.enough_current(logged).first().enough
    assert drift.require_current(logged).count() == 0


def test_retrain_rules_in_order(spark):
    def history(series, flags, triggered_hours_ago=None):
        now = 100
        rows = [(series, hour(now - len(flags) + i), f, False) for i, f in enumerate(flags)]
        if triggered_hours_ago:
            rows.append((series, hour(now - triggered_hours_ago), True, True))
        return rows

    past = (
        history("calm", [True, True]) + history("short", [False, True]) + history("cooling", [True, True], 5)
        + history("flagged", [True, True]) + history("due", [True, True], 30) + history("zero", [True, True])
    )
    checks = spark.createDataFrame(past, "series_id string, check_timestamp timestamp, any_drift_detected boolean, retrain_triggered boolean")
    now = spark.createDataFrame(
        [(s, s != "calm", "lag_24h,value") for s in ("calm", "short", "cooling", "flagged", "due", "zero")],
        "series_id string, any_drift_detected boolean, drifted_features string",
    )
    pending = spark.createDataFrame([("flagged",)], "series_id string")
    got = {r.series_id: r for r in drift.retrain_decision(now, checks, pending, hour(100)).collect()}
    assert sorted(s for s, r in got.items() if r.retrain_triggered) == ["due", "zero"]
    assert got["calm"].reason == "No drift detected." and got["calm"].consecutive_drift_hours == 0
    assert got["short"].reason == "Drift detected for 2h (threshold: 3h)."
    assert got["cooling"].reason == "Cooldown active: last retrain 5.0h ago."
    assert got["flagged"].reason == "Retrain already pending (flag exists)."
    assert got["zero"].reason == "Drift detected for 3 consecutive hours in features: lag_24h, value."


def test_prediction_drift_compares_even_a_zero_mae(spark):
    rows = [("A", hour(h), "m", 24, 100.0 + error, 100.0) for base, error in ((0, 0.0), (24 * 35, 5.0)) for h in range(base, base + 30)]
    data = spark.createDataFrame(rows, "series_id string, forecast_run_at timestamp, model_name string, horizon_hours int, predicted double, actual double")
    row = drift.prediction_drift(data, hour(24 * 37), model="m").first()
    assert (row.prediction_mae_reference, row.prediction_mae_current, row.prediction_drift_detected) == (0.0, 5.0, True)
    few = drift.prediction_drift(data.filter(F.col("forecast_run_at") >= hour(24 * 35 + 10)), hour(24 * 37)).first()
    assert few.prediction_mae_current is None and few.prediction_drift_detected is False


def run(run_id, model, started, mape, production=False, naive=10.0):
    return {"run_id": run_id, "model_name": model, "family": "gbt", "horizon_hours": 24, "started_at": started,
            "mae": mape, "rmse": mape, "mape": mape, "naive_mape": naive, "production": production}


def run_table(spark, *records):
    out = runs.run_record(spark, records[0])
    for r in records[1:]:
        out = out.unionByName(runs.run_record(spark, r))
    return out


def test_champion_is_the_best_other_run(spark):
    table = run_table(
        spark, run("a1", "a", hour(1), 5.0), run("a2", "a", hour(2), 7.0), run("a3", "a", hour(3), 4.0),
        run("b1", "b", hour(1), 6.0, naive=None), run("c1", "c", hour(1), 3.0), run("c2", "c", hour(2), 2.99, naive=1.0),
    )
    got = {r.model_name: r for r in runs.champion_challenger(table, hour(9)).collect()}
    assert (got["a"].challenger_run_id, got["a"].champion_run_id, got["a"].challenger_wins) == ("a3", "a1", True)
    assert got["b"].first_run and got["b"].challenger_wins and got["b"].beats_baseline is None
    assert got["c"].challenger_wins is False and got["c"].beats_baseline is False
    advice = {r.model_name: r for r in runs.recommend(runs.champion_challenger(table, hour(9))).collect()}
    assert advice["b"].recommendation == "PROMOTE: b (MAPE: 6.00% vs N/A)" and advice["b"].warning is None
    assert advice["c"].warning.startswith("WARNING: c does NOT beat the naive baseline")


def test_unknown_run_field(spark):
    with pytest.raises(ValueError, match="unknown run fields"):
        runs.run_record(spark, {"nope": 1})


def test_promotion_cycle(spark):
    table = run_table(
        spark, run("a1", "a", hour(1), 5.0, True), run("a2", "a", hour(2), 4.0),
        run("b1", "b", hour(1), 5.0, True), run("b2", "b", hour(2), 4.99), run("c1", "c", hour(1), 5.0),
        run("d1", "d", hour(1), 5.0, True), run("d2", "d", hour(2), None),
    )
    evaluation = runs.champion_challenger(table, hour(9))
    decisions = runs.decide_promotions(evaluation, table)
    got = {r.model_name: r for r in decisions.collect()}
    assert got["a"].should_promote and got["a"].promotion_reason == "MAPE improved by 20.00% (5.000% -> 4.000%)"
    assert not got["b"].should_promote and got["b"].promotion_reason == "Insufficient improvement (0.20% < 1.00%). Keeping champion."
    assert got["c"].first_run and got["c"].promotion_reason == runs.FIRST
    assert not got["d"].should_promote and got["d"].promotion_reason == runs.INVALID
    tagged, closed = runs.apply_promotions(decisions, table, evaluation, hour(10))
    serving = {r.run_id for r in tagged.filter("production").collect()}
    assert serving == {"a2", "b1", "c1", "d1"}
    assert closed.filter("promoted").count() == 4
    assert runs.decide_promotions(closed, tagged).count() == 0
    same, _ = runs.apply_promotions(decisions, table, evaluation, hour(10), dry_run=True)
    assert same is table
    forced = runs.decide_promotions(evaluation, table, force=True)
    assert forced.filter("should_promote").count() == 4 and forced.first().promotion_reason == runs.FORCED
    log = runs.promotion_log(decisions, hour(10))
    assert log.schema.fieldNames() == schemas.PROMOTION_LOG.fieldNames() and not log.first().drift_triggered
    status = panels.registry_status(log, hour(10 + 24 * 20)).collect()
    assert [r.model_name for r in status] == ["a", "c"] and status[0].model_age_status == "AGING"
    outcomes = {r.model_name: r.decision for r in panels.promotion_history(log, hour(24)).collect()}
    assert outcomes == {"a": "PROMOTED", "b": "SKIPPED", "c": "FIRST RUN", "d": "SKIPPED"}


@pytest.mark.parametrize(("hours", "status"), [(1, "HEALTHY"), (3, "WARNING"), (8, "CRITICAL")])
def test_health(spark, hours, status):
    bronze = spark.createDataFrame([(hour(0),)], "fetched_at timestamp")
    assert panels.ingest_health(bronze, hour(hours)).first().status == status
