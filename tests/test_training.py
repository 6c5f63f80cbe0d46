from __future__ import annotations

from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F
from series import hour, load_frame, weather_frame

from hourline.config import FeatureOptions
from hourline.plans import forecast, ml, runs, splits
from hourline.plans.features import build_features

SMALL = {"maxIter": 12, "maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
INPUTS = ("lag_24h", "hour_of_day", "temperature", "is_weekend")


@pytest.fixture(scope="module")
def features(spark):
    built = build_features(load_frame(spark, 900), weather_frame(spark, 900), FeatureOptions(min_rows=0))
    from hourline.session import written

    return written(built, "test-features")


@pytest.fixture(scope="module")
def trained(features):
    return ml.train_gbt(features, 24, SMALL, INPUTS, min_rows=100, patience=4)


def test_best_round_waits_for_patience():
    assert ml.best_round([5, 4, 3, 3.5, 2.9, 4, 4, 4, 1], 3) == 5
    assert ml.best_round([5, 4, 3, 3.5, 2.9, 4, 4, 4, 1], 9) == 9
    assert ml.best_round([1, 2, 3], 2) == 1


def test_early_stopping_keeps_a_prefix_of_the_trees(features):
    rows = splits.holdout_split(ml.model_frame(features, 24, INPUTS))
    train, val = (rows.filter(F.col("split") == s) for s in ("train", "val"))
    params = {**ml.DEFAULT_PARAMS, **SMALL}
    full = ml._gbt(params, INPUTS).fit(train).stages[-1]
    short = ml._gbt({**params, "maxIter": 5}, INPUTS).fit(train).stages[-1]
    # The first line of a tree's text is its own identifier.
    shape = lambda t: t.toDebugString.split("\n", 1)[1]
    assert [shape(t) for t in full.trees[:5]] == [shape(t) for t in short.trees]
    curve = full.evaluateEachIteration(ml._gbt(params, INPUTS).getStages()[0].transform(val), "squared")
    _, rounds = ml.fit_early_stopped(train, val, params, INPUTS, 4)
    assert rounds == ml.best_round(curve, 4)


def test_a_fit_that_still_improves_is_made_anew_once(features, monkeypatch):
    rows = splits.holdout_split(ml.model_frame(features, 24, INPUTS))
    train, val = (rows.filter(F.col("split") == s) for s in ("train", "val"))
    params = {**ml.DEFAULT_PARAMS, **SMALL, "stepSize": 0.02, "maxDepth": 2, "maxIter": 20}
    full = ml._gbt(params, INPUTS).fit(train)
    curve = full.stages[-1].evaluateEachIteration(full.stages[0].transform(val), "squared")
    fitted, fit = [], ml._gbt
    monkeypatch.setattr(ml, "_gbt", lambda p, c: fitted.append(p["maxIter"]) or fit(p, c))
    model, rounds = ml.fit_early_stopped(train, val, params, INPUTS, 2)
    assert rounds == ml.best_round(curve, 2) > 12 and fitted == [3, 20]  # doubled: 3, 6, 12, 20
    assert model.stages[-1].getNumTrees == rounds


def test_trained_trees_are_scored_on_the_test_days(trained):
    assert trained.n_test == 120 and 1 <= trained.best_round <= 12
    # The series repeats every day, so the naive forecast is exact and the trees come close.
    assert trained.metrics["naive_mape"] == pytest.approx(0, abs=1e-6)
    assert trained.metrics["mape"] < 5


def test_run_record_and_saved_model(spark, trained, features, tmp_path):
    path = ml.save_model(trained, str(tmp_path / "model"))
    record = runs.run_record(spark, trained.record("r1", "gbt_24h", "gbt", 24, hour(0), path)).first()
    assert record.params["best_round"] == str(trained.best_round) and not record.production
    predicted = ml.direct_forecast(ml.load_model(path), features, hour(899), 24)
    rows = forecast.shape_forecasts(predicted, "gbt_24h", "r1", 24, hour(899), "r1", target_hours_ahead=24).collect()
    assert {r.timestamp for r in rows} == {hour(900 + i) for i in range(24)}
    assert all((r.timestamp - r.feature_timestamp).total_seconds() == 24 * 3600 for r in rows)


def test_every_hour_is_forecast(trained, features):
    """Rows with a missing input and hours without a row have a forecast too."""
    holed = features.withColumn("temperature", F.when(F.col("timestamp") == F.lit(hour(890)), None).otherwise(F.col("temperature")))
    holed = holed.filter(F.col("timestamp") != F.lit(hour(895)))
    out = ml.direct_forecast(trained.model, holed, hour(899), 24).collect()
    series = features.select("series_id").distinct().count()
    assert len(out) == 24 * series == len({(r.series_id, r.timestamp) for r in out})
    assert {r.timestamp for r in out if r.inputs_imputed} == {hour(890), hour(895)}
    hours = {r.timestamp: r.hour_of_day for r in ml.direct_forecast(trained.model, features, hour(899), 24).collect()}
    assert all(r.prediction is not None and r.hour_of_day == hours[r.timestamp] for r in out)


def test_too_few_rows(features):
    with pytest.raises(ValueError, match="insufficient training data"):
        ml.train_gbt(features, 24, SMALL, INPUTS, min_rows=10_000)
    with pytest.raises(ValueError, match="insufficient training data"):
        ml.train_seasonal(features, 24, min_rows=10_000)


def seasons(spark, scales, hours=900):
    rng = np.random.default_rng(2)
    rows = []
    for key, scale in scales.items():
        for i in range(hours):
            t = 10 + 8 * np.sin(i / 37) + rng.normal()
            base = 300 * np.exp(0.4 * np.sin(2 * np.pi * i / 24) + 0.02 * t + 0.3 * np.cos(2 * np.pi * i / 168)) * np.exp(rng.normal() * 0.02)
            rows.append((key, hour(i), float(base * scale), float(t)))
    df = spark.createDataFrame(rows, "series_id string, timestamp timestamp, value double, temperature double")
    return forecast.naive_forecast(df, 24, name="lag_24h")


def test_every_series_has_its_own_curve(spark):
    features = seasons(spark, {"a": 1.0, "b": 100.0, "c": 0.01, "d'": 1.0})
    one = ml.train_seasonal(features, 24)
    scores = {r.series_id: r for r in one.scores.collect()}
    assert set(scores) == {"a", "b", "c", "d'"}
    for r in scores.values():
        assert r.mape < 0.6 * r.naive_mape and r.mape < 4 and r.n_test == 120 and r.n_train == 780
    assert scores["b"].mae == pytest.approx(100 * scores["a"].mae, rel=0.25)


def test_curves_solve_the_normal_equations(spark, monkeypatch):
    features = seasons(spark, {"a": 1.0, "b": 20.0}, 500).repartition(7)
    terms = [*ml.seasonal_terms().values(), F.col("temperature")]
    for in_memory, parts in ((1024, 64), (0, 2)):
        monkeypatch.setattr(ml, "SERIES_IN_MEMORY", in_memory)
        monkeypatch.setattr(ml, "GRAM_PARTS", parts)
        curves = {r.series_id: r for r in ml.seasonal_curves(features, ridge=0.01).collect()}
        for key, curve in curves.items():
            rows = features.filter(F.col("series_id") == key).select("timestamp", F.array(*terms).alias("x"), F.log1p("value").alias("y")).orderBy("timestamp").collect()
            x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
            z = (x - x.mean(axis=0)) / x.std(axis=0)
            w = np.linalg.solve(z.T @ z / len(z) + 0.01 * np.eye(z.shape[1]), z.T @ (y - y.mean()) / len(z)) / x.std(axis=0)
            assert curve.n == 500
            np.testing.assert_allclose(curve.weights, w, rtol=1e-6, atol=1e-9)
            assert curve.intercept == pytest.approx(y.mean() - w @ x.mean(axis=0), rel=1e-6)
            predicted = ml.seasonal_predict(spark.createDataFrame([curve]), features.filter(F.col("series_id") == key))
            ours = [r.prediction for r in predicted.orderBy("timestamp").collect()]
            np.testing.assert_allclose(ours, np.expm1(y.mean() + (x - x.mean(axis=0)) @ w), rtol=1e-8)


def test_short_and_flat_series(spark):
    features = seasons(spark, {"long": 1.0}).unionByName(seasons(spark, {"short": 1.0}, 150)).unionByName(
        seasons(spark, {"flat": 1.0}).withColumns({"value": F.lit(7.0), "lag_24h": F.lit(7.0)}))
    one = ml.train_seasonal(features, 24)
    assert {r.series_id for r in one.curves.collect()} == {"long", "flat"}
    flat = {r.series_id: r for r in one.scores.collect()}["flat"]
    assert flat.mae == pytest.approx(0, abs=1e-6)
    known = ml.seasonal_predict(one.curves, features.withColumn("temperature", F.when(F.hour("timestamp") > 0, F.col("temperature"))))
    assert known.filter("series_id = 'short' AND prediction IS NOT NULL").isEmpty()
    assert known.filter("series_id = 'long' AND temperature IS NULL AND prediction IS NOT NULL").isEmpty()


def test_draws_stay_in_the_space():
    random = Random(1)
    for _ in range(50):
        p = ml.draw(ml.SEARCH_SPACE, random)
        assert set(p) == set(ml.SEARCH_SPACE)
        assert 0.005 <= p["stepSize"] <= 0.1 and 5 <= p["minInstancesPerNode"] <= 30 and 0.6 <= float(p["featureSubsetStrategy"]) <= 1
    assert ml.draw(ml.SEARCH_SPACE, Random(3)) == ml.draw(ml.SEARCH_SPACE, Random(3))


def test_tuning_is_seeded_and_can_be_skipped(features):
    frame = ml.model_frame(features, 24, INPUTS)
    assert ml.tune(frame, 24, trials=0) == {}
    settings = dict(trials=1, columns=INPUTS, n_folds=2, gap=24, test=24, rounds=2, patience=1)
    first = ml.tune(frame, 24, **settings)
    assert set(first) == set(ml.SEARCH_SPACE) and first == ml.tune(frame, 24, **settings)


def test_halving_finds_the_best_and_runs_alike(features):
    frame = ml.model_frame(features, 24, INPUTS)
    space = {"maxDepth": [1, 5]}
    settings = dict(trials=5, space=space, columns=INPUTS, n_folds=2, gap=24, test=24, rounds=4, patience=1)
    best = ml.tune(frame, 24, keep=2, **settings)
    assert best["maxDepth"] == 5  # the hour of day is beyond trees of one split
    assert best == ml.tune(frame, 24, keep=2, parallel=1, **settings)


def test_first_trees_are_the_shorter_fit(features):
    frame = ml.model_frame(features, 24, INPUTS)
    params = {**ml.DEFAULT_PARAMS, **SMALL}
    short = ml.first_trees(ml._gbt({**params, "maxIter": 6}, INPUTS).fit(frame), 3)
    again = ml._gbt({**params, "maxIter": 3}, INPUTS).fit(frame)
    ours, theirs = ([r.prediction for r in m.transform(frame).orderBy("series_id", "timestamp").collect()] for m in (short, again))
    assert ours == theirs and short.stages[-1].getNumTrees == 3


def test_permuting_the_used_feature_hurts_most(spark, features, trained):
    test = splits.holdout_split(ml.model_frame(features, 24, INPUTS)).filter("split = 'test'")
    out = {r.feature: r.importance for r in ml.permutation_importance(trained, test).collect()}
    assert set(out) == set(INPUTS) and max(out.values()) > 0
    assert out["is_weekend"] < max(out.values())
    gains = {r.feature: r.importance for r in ml.gain_importance(trained, spark).collect()}
    assert sum(gains.values()) == pytest.approx(1.0)


@pytest.mark.parametrize("rows_per_slice", [16, 4096])
def test_permutation_scores_all_rows(spark, features, trained, rows_per_slice):
    """Every row takes part, with the feature of another row of its slice."""
    test = splits.holdout_split(ml.model_frame(features, 24, INPUTS)).filter("split = 'test'")
    n = test.count()
    out = {r.feature: r.mae for r in ml.permutation_importance(trained, test, rows_per_slice=rows_per_slice).collect()}
    order = F.xxhash64("series_id", "timestamp", F.lit(42))
    rows = test.withColumns({"o": order, "s": F.pmod(F.xxhash64(order), F.lit(max(1, n // rows_per_slice)))}).toPandas().sort_values(["s", "o"])
    for name in INPUTS:
        moved = rows.copy()
        moved[name] = rows.groupby("s")[name].transform(lambda v: np.roll(v.to_numpy(), -1))
        scored = trained.model.transform(spark.createDataFrame(moved.drop(columns=["s", "o"]))).toPandas()
        assert out[name] == pytest.approx((scored.target - scored.prediction).abs().mean(), abs=2e-6)
