"""The physical plans: what is shuffled, what is broadcast, what stays in the JVM."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from hourline.config import FeatureOptions
from hourline.functions.calendar import holiday_dim
from hourline.operators import windows
from hourline.plans.drift import drift_windows
from hourline.plans.features import build_features
from hourline.plans.forecast import future_features
from hourline.plans.panels import load_forecasts
from hourline.plans.rebuild import build_window
from hourline.sources.tables import with_day
from hourline.sources.upsert import upsert
from hourline.workload import QUERIES
from hourline.workload.base import table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Load and weather as stored tables, with statistics the planner can use."""
    base = tmp_path_factory.mktemp("stored")
    hours = spark.range(24 * 90).select(F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("timestamp"))
    series = spark.range(20).select(F.concat(F.lit("s"), "id").alias("series_id"))
    hours.join(series, F.lit(True)).withColumn("value", F.rand(1) * 100).write.parquet(f"{base}/load")
    hours.join(series, F.lit(True)).withColumns(
        {"temperature": F.rand(2), "humidity": F.rand(3), "cloud_cover": F.rand(4), "is_weather_imputed": F.lit(False)}
    ).write.parquet(f"{base}/weather")
    return spark.read.parquet(f"{base}/load"), spark.read.parquet(f"{base}/weather")


def test_matrix_sorts_once_per_slice(stored):
    plan = plan_of(build_features(*stored, FeatureOptions(min_rows=0)))
    assert len(re.findall(r"Exchange hashpartitioning\(series_id#\d+, __slice#", plan)) == 1
    assert len(re.findall(r"Sort \[series_id#\d+ ASC NULLS FIRST, __slice#", plan)) == 1
    # No window sees a whole series, except over the counts of its blocks.
    partitions = set(re.findall(r"windowspecdefinition\((\w+)#\d+L?, (\w+)#", plan))
    assert {b for _, b in partitions} <= {"__slice", "__block"}
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_lags_need_one_shuffle(stored):
    plan = plan_of(windows.add_lags(stored[0]))
    assert plan.count("Exchange hashpartitioning") == 1


def test_only_the_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(QUERIES["w01_w02_lags"](spark, sf_dir))
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)) == {"struct<ts:timestamp_ntz,event_type:string,value:double>"}


def test_time_bounds_reach_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["s05_p01_scan_window"](spark, sf_dir))
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan


def test_stored_days_are_pruned(spark, tmp_path):
    path = str(tmp_path / "load")
    hours = spark.range(24 * 50).select(F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("timestamp"))
    stored = with_day(hours.withColumns({"series_id": F.lit("A"), "value": F.lit(1.0)}))
    stored.write.partitionBy("day").parquet(path)
    read = spark.read.schema(stored.schema).parquet(path)
    cut = {
        "window": build_window(read, None, "2024-01-20", "2024-01-21", 24, 24, FeatureOptions(min_rows=0)),
        "drift": drift_windows(read, "2024-02-10", ["value"], ("2024-02-01", "2024-02-05")),
        "report": load_forecasts(read.withColumns({c: F.lit(1) for c in ("predicted", "actual", "model_name", "horizon_hours", "model_version")}), "2024-02-10", 48),
    }
    for name, df in cut.items():
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan_of(df))
        assert filters and all("day#" in f for f in filters), name


def test_newest_rows_are_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(windows.latest_per(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_orderdate").desc()))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_future_frame_shuffles_the_history_once(stored):
    load, weather = stored
    plan = plan_of(future_features(load.join(weather, ["series_id", "timestamp"]), "2024-03-01", 24))
    # Two for the join of the test data, then one by series; the last known value, sought in all rows, adds one
    # of at most a row per series and task.
    assert len(re.findall(r"Exchange hashpartitioning\(series_id#\d+, \d+\)", plan)) == 2
    assert "partial_max_by" in plan


def test_upsert_joins_once(spark, stored):
    plan = plan_of(upsert(stored[0], stored[0].withColumn("value", F.col("value") + 1), ["series_id", "timestamp"]))
    assert plan.count("Join") == 1 and "FullOuter" in plan


def test_what_is_broadcast_on_purpose_is_small(spark):
    assert holiday_dim(spark).count() < 2000


def test_short_series_are_left_out_without_a_join_by_series(spark, stored):
    """With broadcasts off, no join or window of the rows meets all rows of a series."""
    load, weather = stored
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(build_features(load, weather, FeatureOptions(min_rows=100)))
        assert re.search("SortMergeJoin", plan)
        assert not re.search(r"(SortMergeJoin|ShuffledHashJoin) \[series_id#\d+\], ", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
