from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from series import START, by_hour, hour, load_frame, weather_frame

from hourline.config import FeatureOptions
from hourline.functions.calendar import add_calendar, holiday_dim
from hourline.operators import joins, quality, slices, windows
from hourline.plans.features import build_features, feature_columns


def gappy(seed: int, n: int, keep: float, null: float) -> pd.DataFrame:
    rnd = random.Random(seed)
    rows = [
        (hour(i), None if rnd.random() < null else round(rnd.uniform(0, 500), 2)) for i in range(n) if rnd.random() < keep
    ]
    return pd.DataFrame(rows, columns=["timestamp", "value"]).astype({"value": "float64"})


def frame(spark, parts: dict[str, pd.DataFrame]):
    rows = [
        (k, t.to_pydatetime(), None if pd.isna(v) else float(v))
        for k, p in parts.items() for t, v in zip(p["timestamp"], p["value"])
    ]
    return spark.createDataFrame(rows, "series_id string, timestamp timestamp, value double")


def close(ours, theirs):
    a = np.array([np.nan if x is None else x for x in ours], dtype=float)
    np.testing.assert_allclose(a, np.asarray(theirs, dtype=float), rtol=1e-9, atol=1e-9)


# One series far longer than the other, and slices much shorter than either.
PARTS = {"hot": gappy(1, 1500, 0.8, 0.15), "small": gappy(2, 120, 0.5, 0.3)}


@pytest.mark.parametrize("rows_per_slice", [50, 173, 4096])
def test_rolling_equals_pandas(spark, rows_per_slice):
    out = windows.add_rolling(frame(spark, PARTS), rows_per_slice=rows_per_slice)
    for key, part in PARTS.items():
        got = out.filter(F.col("series_id") == key)
        v = part["value"]
        close(by_hour(got, "rolling_7d_mean"), v.rolling(168, min_periods=72).mean())
        close(by_hour(got, "rolling_7d_std"), v.rolling(168, min_periods=72).std())
        close(by_hour(got, "rolling_24h_mean"), v.rolling(24, min_periods=12).mean())


@pytest.mark.parametrize("rows_per_slice", [50, 4096])
def test_imputation_equals_pandas(spark, rows_per_slice):
    parts = {k: gappy(s, n, 0.9, 0.7) for k, s, n in (("hot", 3, 900), ("small", 4, 60))}
    data = frame(spark, parts).withColumnRenamed("value", "temperature").withColumns(
        {"humidity": F.lit(1.0), "cloud_cover": F.lit(None).cast("double")}
    )
    out = windows.impute_weather(data, rows_per_slice=rows_per_slice)
    for key, part in parts.items():
        v = part["value"]
        filled = v.ffill(limit=3).bfill(limit=3)
        filled = filled.fillna(filled.rolling(72, min_periods=1, center=True).mean())
        got = out.filter(F.col("series_id") == key)
        a = np.array([np.nan if x is None else x for x in by_hour(got, "temperature")], dtype=float)
        np.testing.assert_allclose(a, filled.to_numpy(), atol=1e-6)
        assert by_hour(got, "temp_missing") == list(v.isna())
        assert by_hour(got, "is_weather_imputed") == list(v.isna() & filled.notna())


def test_lags_equal_a_shift_on_the_full_grid(spark):
    data = frame(spark, PARTS)
    out = slices.over_hours(
        data, lambda d, w: windows.lag_columns(d, w, "value", (24, 168)), 168, slice_hours=100
    )
    for key, part in PARTS.items():
        grid = part.set_index("timestamp")["value"].asfreq("h")
        got = out.filter(F.col("series_id") == key)
        for h in (24, 168):
            close(by_hour(got, f"lag_{h}h"), grid.shift(h)[part["timestamp"]])


@pytest.mark.parametrize("block_hours", [7, 500])
def test_positions_are_dense(spark, block_hours):
    out = slices.with_position(frame(spark, PARTS), "position", block_hours=block_hours)
    for key, part in PARTS.items():
        assert by_hour(out.filter(F.col("series_id") == key), "position") == list(range(1, len(part) + 1))


def test_lag_values(spark):
    data = load_frame(spark, 200)
    values = by_hour(data, "value")
    out = windows.add_lags(data)
    assert by_hour(out, "lag_24h")[100] == values[76]
    assert by_hour(out, "lag_168h")[168] == values[0]
    assert by_hour(out, "has_lag_gap")[167] and not by_hour(out, "has_lag_gap")[168]


def test_a_gap_gives_a_null_lag(spark):
    out = windows.add_lags(load_frame(spark, 200, drop={50}))
    hit = out.filter(F.col("timestamp") == hour(74)).first()
    assert hit["lag_24h"] is None and hit["has_lag_gap"]


def test_rolling_needs_a_minimum(spark):
    means = by_hour(windows.add_rolling(load_frame(spark, 80)), "rolling_7d_mean")
    assert means[70] is None and means[71] is not None


def test_target_by_time_and_by_row(spark):
    data = load_frame(spark, 60, drop={30})
    values = dict(by_hour(data, "timestamp", "value"))
    timed = dict(by_hour(windows.add_target(data, 24), "timestamp", "target"))
    assert timed[hour(0)] == values[hour(24)] and timed[hour(6)] is None
    by_row = dict(by_hour(windows.add_target(data, 24, mode="row"), "timestamp", "target"))
    assert by_row[hour(6)] == values[hour(31)]
    with pytest.raises(ValueError):
        windows.add_target(data, 24, mode="none")


def test_short_gaps_are_filled_and_flagged(spark):
    temperature = [10.0] * 5 + [None] * 3 + [10.0] * 12
    out = windows.impute_weather(weather_frame(spark, 20, temperature=temperature))
    assert None not in by_hour(out, "temperature")
    flags = by_hour(out, "is_weather_imputed")
    assert flags[6] and not flags[0]


def test_fallback_of_single_nulls(spark):
    temperature = [float(i) if i not in (2, 4) else None for i in range(10)]
    out = windows.impute_weather(weather_frame(spark, 10, temperature=temperature))
    assert None not in by_hour(out, "temperature")
    assert by_hour(out, "is_weather_imputed")[2] and not by_hour(out, "is_weather_imputed")[0]


def test_unmatched_weather_that_is_filled_is_flagged(spark):
    joined = joins.join_weather(load_frame(spark, 10), weather_frame(spark, 8))
    assert by_hour(windows.impute_weather(joined), "is_weather_imputed")[8:] == [True, True]


def test_local_hour_and_holidays(spark):
    out = add_calendar(load_frame(spark, 1))
    assert by_hour(out, "hour_of_day") == [1]
    import datetime as dt

    for day in (25, 26):
        christmas = load_frame(spark, 1, start=dt.datetime(2024, 12, day, 10))
        assert by_hour(add_calendar(christmas), "is_holiday") == [True]


def test_eve_looks_one_row_ahead(spark):
    # Friday 22:00 UTC is 23:00 local; the next row is Saturday.
    import datetime as dt

    out = windows.add_holiday_eve(add_calendar(load_frame(spark, 3, start=dt.datetime(2024, 1, 5, 21))))
    assert by_hour(out, "is_holiday_eve") == [False, True, False]
    with pytest.raises(ValueError):
        add_calendar(out, eve_mode="week")


def test_eve_by_day_and_extra_holidays(spark):
    import datetime as dt

    extra = spark.createDataFrame([(dt.date(2024, 1, 10),)], "holiday_date date")
    data = load_frame(spark, 48, start=dt.datetime(2024, 1, 8, 23))
    out = add_calendar(data, eve_mode="day", extra_holidays=extra)
    eves = by_hour(out, "is_holiday_eve")
    assert all(eves[:24]) and not any(eves[24:])
    assert by_hour(out, "is_holiday")[24:] == [True] * 24


def test_easter(spark):
    days = {r[0].isoformat() for r in holiday_dim(spark, 2023, 2024).collect()}
    assert {"2023-04-09", "2023-04-10", "2024-03-29", "2024-03-31", "2024-04-01", "2024-05-19", "2024-05-20"} <= days


def test_matrix_has_every_feature(spark):
    out = build_features(load_frame(spark, 300), weather_frame(spark, 300), FeatureOptions(min_rows=0), F.lit(START))
    assert set(feature_columns()) <= set(out.columns) and "feature_built_at" in out.columns
    assert out.count() == 300


def test_matrix_without_weather(spark):
    out = build_features(load_frame(spark, 10), None, FeatureOptions(min_rows=0))
    assert by_hour(out, "temp_missing") == [True] * 10
    assert by_hour(out, "temperature") == [None] * 10


def test_short_series_are_left_out(spark):
    assert build_features(load_frame(spark, 10)).count() == 0


def test_matrix_is_deterministic_and_needs_its_columns(spark):
    data, weather = load_frame(spark, 100), weather_frame(spark, 100)
    options = FeatureOptions(min_rows=0)
    first, second = (sorted(build_features(data.repartition(n), weather, options).collect()) for n in (1, 7))
    assert [str(r) for r in first] == [str(r) for r in second]
    with pytest.raises(ValueError, match="missing required columns"):
        build_features(data.drop("value"), weather)


def test_consecutive_flags(spark):
    flags = [True, False, True, True]
    rows = [("A", hour(i), f) for i, f in enumerate(flags)] + [("B", hour(0), False)]
    data = spark.createDataFrame(rows, "series_id string, check_timestamp timestamp, flag boolean")
    found = dict(windows.consecutive_true(data, "flag").collect())
    assert found == {"A": 2, "B": 0}
    gap = data.filter(F.col("check_timestamp") != hour(2))
    assert dict(windows.consecutive_true(gap.filter("flag or series_id = 'B'"), "flag").collect())["A"] == 2
    strict = windows.consecutive_true(gap.filter("flag or series_id = 'B'"), "flag", contiguous=True)
    assert dict(strict.collect())["A"] == 1
    assert dict(windows.consecutive_true(data.filter("flag"), "flag", cap=2).collect()) == {"A": 2}


def test_a_run_of_flags_has_no_cap(spark):
    rows = spark.range(130).selectExpr(
        "'A' AS series_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, cast(id AS int)) AS check_timestamp", "id > 9 AS flag")
    assert dict(windows.consecutive_true(rows, "flag").collect()) == {"A": 120}
    gappy = rows.filter("id <> 50")
    assert dict(windows.consecutive_true(gappy, "flag", contiguous=True).collect()) == {"A": 79}


def test_holidays_of_any_year(spark):
    days = spark.createDataFrame([("2101-12-25", True), ("1950-12-25", True), ("2101-04-17", True), ("2101-04-18", True), ("2101-04-19", False)], "d string, expected boolean")
    found = add_calendar(days.selectExpr("*", "timestamp(d || ' 12:00:00') AS timestamp"))
    assert all(r["is_holiday"] == r["expected"] for r in found.collect())


def test_gaps_between_rows_far_apart(spark):
    rows = [("A", h) for h in (0, 1, 4, 5000, 5001)] + [("B", 7)] + [("C", 0), ("C", 2_000_000)]
    df = spark.createDataFrame(rows, "series_id string, h long").select("series_id", F.timestamp_seconds(F.col("h") * 3600 + 1800).alias("timestamp"))
    df = df.unionByName(df)  # rows that repeat an hour
    spans = {(r.series_id, int(r.before.timestamp()) // 3600, int(r.after.timestamp()) // 3600) for r in joins.absent_spans(df, slice_hours=3).collect()}
    assert spans == {("A", 1, 4), ("A", 4, 5000), ("C", 0, 2_000_000)}
    missing = joins.missing_hours(df)
    counts = {r.series_id: (r.n, r.u, int(r.a.timestamp()) // 3600, int(r.b.timestamp()) // 3600) for r in missing.groupBy("series_id").agg(
        F.count("*").alias("n"), F.count_distinct("timestamp").alias("u"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).collect()}
    assert counts == {"A": (4997, 4997, 2, 4999), "C": (1_999_999, 1_999_999, 1, 1_999_999)}
    report = {r.series_id: r.gaps for r in quality.gap_report(df.withColumn("value", F.lit(1.0)), "2198-03-01 00:00:00", days=90_000, settle_hours=0).collect()}
    last = int(dt.datetime(2198, 3, 1, tzinfo=dt.timezone.utc).timestamp()) // 3600
    assert report == {"A": 4997 + last - 5001, "B": last - 7, "C": 1_999_999 + last - 2_000_000}
