"""Means and deviations of series at any level, against exact fractions."""

from __future__ import annotations

import datetime as dt
import math
import statistics
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourline.functions import exact
from hourline.operators import metrics, windows
from hourline.plans import forecast

START = dt.datetime(2023, 1, 1)
LEVELS = {
    "high": [1e7 + 0.1 * (i % 2) for i in range(400)],
    "tiny": [1e-5 * (1 + (i * 7 % 11)) for i in range(400)],
    "huge": [3e20 * (1 + (i % 5)) for i in range(400)],
    "mixed": [float(i % 3) if i < 200 else 4e6 + i for i in range(400)],
    "flat": [123.4567] * 400,
    "signed": [(-1) ** i * 55.5 for i in range(400)],
}


def frame(spark, parts):
    rows = [(k, START + dt.timedelta(hours=i), v) for k, vs in parts.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series_id string, timestamp timestamp, value double")


def same(ours, values, level):
    """Within the digits that the largest value of the slice leaves."""
    mean, std = ours
    exact_values = [Fraction(v) for v in values]
    true = float(sum(exact_values) / len(values))
    spread = math.sqrt(float(sum((v - sum(exact_values) / len(values)) ** 2 for v in exact_values) / (len(values) - 1)))
    assert mean == pytest.approx(true, rel=1e-12, abs=level * 1e-12)
    assert std == pytest.approx(spread, rel=1e-6, abs=level * 2e-12)


@pytest.mark.parametrize("rows_per_slice", [50, 4096])
def test_rolling_statistics_at_any_level(spark, rows_per_slice):
    out = windows.add_rolling(frame(spark, LEVELS), rows_per_slice=rows_per_slice)
    got = {(r.series_id, r.timestamp): (r.rolling_7d_mean, r.rolling_7d_std) for r in out.collect()}
    for key, values in LEVELS.items():
        for i in (100, 168, 250, 399):
            same(got[key, START + dt.timedelta(hours=i)], values[max(0, i - 167) : i + 1], max(map(abs, values)))
    assert got["high", START + dt.timedelta(hours=399)][1] == pytest.approx(0.0501, abs=1e-4)
    assert got["flat", START + dt.timedelta(hours=399)][1] == 0.0


def test_newest_rows_at_any_level(spark):
    data = frame(spark, LEVELS)
    tail = {r.series_id: r for r in windows.tail_stats(data).collect()}
    weather = {c: F.lit(1.0) for c in ("temperature", "humidity", "cloud_cover")}
    ahead = {r.series_id: r for r in forecast.future_features(data.withColumns(weather), "2023-03-01 00:00:00", 1).collect()}
    for key, values in LEVELS.items():
        same((tail[key].tail_mean, tail[key].tail_std), values[-168:], max(map(abs, values)))
        assert (ahead[key].rolling_7d_mean, ahead[key].rolling_7d_std) == (tail[key].tail_mean, tail[key].tail_std)
        assert tail[key].tail_short_mean == pytest.approx(statistics.fmean(values[-24:]), rel=1e-11)


def test_values_that_are_no_numbers_are_unknown(spark):
    values = [float("nan"), float("inf"), None, -float("inf"), *[float(i) for i in range(80)]]
    out = windows.add_rolling(frame(spark, {"s": values})).orderBy("timestamp").collect()
    assert out[-1].rolling_7d_mean == 39.5 and out[-1].rolling_7d_std == pytest.approx(statistics.stdev(range(80)))
    assert [r.rolling_24h_mean for r in out[:15]] == [None] * 15 and out[15].rolling_24h_mean == 5.5
    assert windows.tail_stats(frame(spark, {"n": [float("nan"), None]})).first().tail_mean is None


def test_powers_of_ten_are_exact_and_rows_do_not_matter(spark):
    powers = spark.range(23).select("id", exact._power(F.col("id")).alias("p")).collect()
    assert all(r.p == float(10**r.id) for r in powers)
    rng = np.random.default_rng(4)
    values = np.round(rng.normal(900, 40, 700), 4).tolist()
    results = []
    for extra, rows in (([], 4096), ([], 60), ([5e8], 4096)):  # a larger value elsewhere in the slice changes the exponent
        out = windows.add_rolling(frame(spark, {"s": values + extra}), rows_per_slice=rows)
        results.append([(r.rolling_7d_mean, r.rolling_7d_std) for r in out.orderBy("timestamp").collect()[:700]])
    assert results[0] == results[1] == results[2]


def test_r2_at_any_level(spark):
    rows = [(g, base + (i % 7) * step, base + (i % 7) * step + (i % 3 - 1) * step / 10) for g, base, step in
            (("high", 1e9, 0.1), ("tiny", 0.0, 1e-6), ("flat", 5.0, 0.0)) for i in range(210)]
    out = {r.g: r.r2 for r in metrics.r2(spark.createDataFrame(rows, "g string, actual double, predicted double"), by=["g"]).collect()}
    expected = 1 - (140 * 0.01) / (30 * 28)
    assert out["high"] == pytest.approx(expected, rel=1e-6) and out["tiny"] == pytest.approx(expected, rel=1e-9) and out["flat"] == 0.0
