"""Small hourly series for the tests."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession

START = dt.datetime(2024, 1, 1)


def hour(i: int, start: dt.datetime = START) -> dt.datetime:
    return start + dt.timedelta(hours=i)


def load_rows(n: int, drop=(), null=(), series="A", start=START):
    return [
        (series, hour(i, start), None if i in null else 4000 + round(500 * math.sin(2 * math.pi * i / 24), 4))
        for i in range(n) if i not in drop
    ]


def load_frame(spark: SparkSession, n: int, **kw) -> DataFrame:
    return spark.createDataFrame(load_rows(n, **kw), "series_id string, timestamp timestamp, value double")


def weather_frame(spark: SparkSession, n: int, series="A", temperature=None) -> DataFrame:
    rows = [
        (series, hour(i), temperature[i] if temperature else 10 + round(5 * math.cos(2 * math.pi * i / 24), 4), 60.0, 20.0, False)
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "series_id string, timestamp timestamp, temperature double, humidity double, cloud_cover double, is_weather_imputed boolean"
    )


def by_hour(df: DataFrame, *columns: str) -> list:
    """Rows in time order; one value each if one column is asked for."""
    rows = df.orderBy("series_id", "timestamp").select(*columns).collect()
    return [r[0] for r in rows] if len(columns) == 1 else [tuple(r) for r in rows]
