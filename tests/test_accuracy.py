from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from series import by_hour, hour, load_frame

from hourline.operators import metrics
from hourline.plans import forecast, splits


def pairs(spark, actual, predicted):
    return spark.createDataFrame(list(zip(actual, predicted)), "actual double, baseline double")


def naive(spark, actual, predicted):
    return metrics.naive_metrics(pairs(spark, actual, predicted)).first()


def test_naive_metrics(spark):
    row = naive(spark, [100.0, 200.0], [90.0, 220.0])
    assert (row.naive_mae, row.naive_mape) == (15.0, 10.0)
    assert row.naive_rmse == pytest.approx(math.sqrt(250))


def test_naive_metrics_drop_incomplete_pairs(spark):
    row = naive(spark, [100.0, None, 300.0], [90.0, 500.0, None])
    assert (row.naive_mae, row.naive_rmse, row.naive_mape) == (10.0, 10.0, 10.0)


def test_zero_actuals_do_not_enter_mape(spark):
    row = naive(spark, [0.0, 0.0], [10.0, -10.0])
    assert (row.naive_mae, row.naive_rmse, row.naive_mape) == (10.0, 10.0, 0.0)


def test_no_pair_is_an_error(spark):
    with pytest.raises(Exception, match="no comparable"):
        metrics.naive_metrics(pairs(spark, [None], [1.0])).collect()


def forecasts(spark, n, predicted=110.0):
    rows = [("A", hour(i), hour(i), "m", 24, predicted, 100.0) for i in range(n)]
    return spark.createDataFrame(
        rows, "series_id string, timestamp timestamp, forecast_run_at timestamp, model_name string, horizon_hours int, predicted double, actual double"
    )


@pytest.mark.parametrize(("n", "mae"), [(30, 10.0), (10, None)])
def test_prediction_mae_needs_a_day(spark, n, mae):
    assert metrics.prediction_mae(forecasts(spark, n), hour(0), hour(100), model="m").first().mae == mae


@pytest.mark.parametrize(
    ("actual", "predicted", "check"),
    [
        ([1.0, 2.0, 3.0], [1.0, 2.0, 3.0], lambda r: r == 1.0),
        ([5.0, 5.0, 5.0], [4.0, 5.0, 6.0], lambda r: r == 0.0),
        ([1.0, 2.0, 3.0], [3.0, 2.0, 1.0], lambda r: r < 0),
    ],
)
def test_r2(spark, actual, predicted, check):
    df = pairs(spark, actual, predicted).withColumnRenamed("baseline", "predicted")
    assert check(metrics.r2(df).first().r2)


def test_metrics_do_not_depend_on_row_order(spark):
    df = forecasts(spark, 500).withColumn("predicted", F.col("actual") + F.rand(7))
    rows = [metrics.regression_metrics(df.repartition(n)).first() for n in (1, 3, 8)]
    assert rows[0] == rows[1] == rows[2]


def test_holdout_is_disjoint_and_exhaustive(spark):
    out = splits.holdout_split(load_frame(spark, 1000), 5, 5)
    counts = dict(out.groupBy("split").count().collect())
    assert counts == {"train": 760, "val": 120, "test": 120}
    bounds = {r.split: (r.a, r.b) for r in out.groupBy("split").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).collect()}
    assert bounds["train"][1] < bounds["val"][0] <= bounds["val"][1] < bounds["test"][0]
    two = dict(splits.holdout_split(load_frame(spark, 1000), 0, 5).groupBy("split").count().collect())
    assert two == {"train": 880, "test": 120}


def test_holdout_over_the_whole_table(spark):
    both = load_frame(spark, 300).union(load_frame(spark, 100, series="B"))
    out = splits.holdout_split(both, 0, 5, keys=())
    assert {r.series_id for r in out.filter("split = 'test'").select("series_id").distinct().collect()} == {"A"}


def test_folds_keep_the_gap(spark):
    data = load_frame(spark, 1000)
    position = {r.timestamp: i for i, r in enumerate(data.orderBy("timestamp").collect())}
    out = splits.ts_folds(data, 3, 168, 120).collect()
    last_test = 0
    for fold in range(3):
        train = sorted(position[r.timestamp] for r in out if r.fold == fold and r.role == "train")
        test = sorted(position[r.timestamp] for r in out if r.fold == fold and r.role == "test")
        assert len(test) == 120 and train[0] == 0 and train == list(range(len(train)))
        assert test[0] - train[-1] == 169 and test[0] >= last_test
        last_test = test[-1]
    assert last_test == 999


def test_too_few_rows_for_the_folds(spark):
    with pytest.raises(Exception, match="folds need 984 rows"):
        splits.ts_folds(load_frame(spark, 50)).collect()
    assert splits.ts_folds(load_frame(spark, 50), strict=False).count() == 0


def history(spark, n, **kw):
    return load_frame(spark, n, **kw).withColumns({c: F.col("value") / 100 for c in ("temperature", "humidity", "cloud_cover")})


def test_future_frame_looks_up_exact_hours(spark):
    data = history(spark, 400)
    values = dict(by_hour(data, "timestamp", "value"))
    ahead = {r.timestamp: r for r in forecast.future_features(data, hour(399), 168).collect()}
    assert len(ahead) == 168
    first, late = ahead[hour(400)], ahead[hour(399 + 100)]
    assert first.lag_24h == values[hour(376)] and first.lag_168h == values[hour(232)]
    # A day before hour 499 has not happened yet: the last value stands in.
    assert late.lag_24h == values[hour(399)] and late.lag_168h == values[hour(331)]
    assert first.temperature == values[hour(232)] / 100
    tail = [values[hour(i)] for i in range(376, 400)]
    assert first.rolling_24h_mean == pytest.approx(sum(tail) / 24)


def test_future_frame_needs_a_week(spark):
    assert forecast.future_features(history(spark, 100), hour(99), 24).count() == 0
    with pytest.raises(Exception, match="rows of history needed"):
        forecast.future_features(history(spark, 100), hour(99), 24, strict=True).collect()


def test_forecast_ids_are_stable_and_values_not_negative(spark):
    rows = load_frame(spark, 2).withColumn("prediction", F.lit(-5.0))
    one, two = (
        forecast.shape_forecasts(rows, "m", "v1", 24, run, "r").orderBy("timestamp").collect() for run in (hour(1), hour(5))
    )
    assert [r.forecast_id for r in one] == [r.forecast_id for r in two]
    assert {r.predicted for r in one} == {0.0}
    import hashlib

    assert one[0].forecast_id == hashlib.md5(b"m_24_2024-01-01T00:00:00+00:00").hexdigest()


def test_serving_run_prefers_production_then_mape(spark):
    rows = [
        ("r1", "gbt", 24, hour(1), 3.0, False), ("r2", "gbt", 24, hour(2), 4.0, True),
        ("r3", "seasonal", 24, hour(3), 1.0, True), ("r4", "seasonal", 168, hour(3), 9.0, False),
    ]
    runs = spark.createDataFrame(rows, "run_id string, family string, horizon_hours int, started_at timestamp, mape double, production boolean")
    assert {r.horizon_hours: r.run_id for r in forecast.serving_run(runs, "gbt", "seasonal").collect()} == {24: "r2", 168: "r4"}
