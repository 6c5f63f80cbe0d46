"""The matrix after edits equals the matrix built anew, and only what the edits reach is built."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from hourline.config import FeatureOptions
from hourline.plans.features import build_features
from hourline.plans.rebuild import dirty_blocks, rebuild_changed
from hourline.session import written
from hourline.sources.upsert import changes

START = dt.datetime(2023, 3, 1)
OPTIONS = FeatureOptions(min_rows=0)


def tables(spark, load, weather):
    at = lambda h: START + dt.timedelta(hours=h)
    rows = [(s, at(h), v) for (s, h), v in load.items()]
    sky = [(at(h), t, None if h % 5 == 0 else 50.0, 1.0, False) for h, t in weather.items()]
    return (
        written(spark.createDataFrame(rows, "series_id string, timestamp timestamp, value double"), "load"),
        written(spark.createDataFrame(sky, "timestamp timestamp, temperature double, humidity double, cloud_cover double, is_weather_imputed boolean"), "weather"),
    )


def test_edits_of_any_kind(spark):
    draw = random.Random(8)
    load = {(s, h): round(draw.uniform(100, 200), 3) for s in ("gappy", "dense", "untouched") for h in range(2400)
            if s != "gappy" or draw.random() < 0.15 or 900 < h < 1200}
    weather = {h: None if draw.random() < 0.2 else round(draw.uniform(-5, 30), 2) for h in range(2400)}
    before = tables(spark, load, weather)
    features = written(build_features(*before, OPTIONS), "features")
    edited, sky = dict(load), dict(weather)
    for series, kept in (("gappy", 300), ("dense", 700)):
        for h in [draw.randrange(kept, kept + 60) for _ in range(6)]:
            kind = draw.choice("iud")
            if kind == "d":
                edited.pop((series, h), None)
            else:
                edited[series, h] = round(draw.uniform(100, 200), 3)
    edited["dense", 2500] = 5.0
    edited.pop(("dense", 1900))
    sky[1500] = 99.0
    for (old, new) in ((before, tables(spark, edited, weather)), (before, tables(spark, edited, sky))):
        changed = changes(old[0], new[0], ["series_id", "timestamp"]).select("series_id", "timestamp").distinct()
        moved = changes(old[1], new[1], ["timestamp"]).select("timestamp")
        out = rebuild_changed(features, *new, changed, moved, OPTIONS, block_hours=48)
        whole = build_features(*new, OPTIONS)
        assert out.columns == whole.columns
        assert out.exceptAll(whole).isEmpty() and whole.exceptAll(out).isEmpty()


def test_what_is_read_does_not_grow_with_the_series(spark):
    changed = spark.createDataFrame([("s", START + dt.timedelta(hours=1000))], "series_id string, timestamp timestamp")
    read = []
    for hours in (3000, 12_000):
        rows = spark.range(hours).select(F.lit("s").alias("series_id"), F.timestamp_seconds(F.lit(int(START.timestamp())) + F.col("id") * 3600).alias("timestamp"), F.lit(1.0).alias("value"))
        rows = rows.unionByName(rows.withColumn("series_id", F.lit("other")))
        blocks = dirty_blocks(rows, changed, OPTIONS, block_hours=24).collect()
        read.append(sum(b.rows for b in blocks))
        assert {b.series_id for b in blocks} == {"s"} and any(not b.dirty for b in blocks)
    assert read[0] == read[1] < 1000
