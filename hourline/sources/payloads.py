"""Rows from the payloads of the two feeds: load as XML, weather as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline.config import TIMEZONE

XML_SCHEMA = """TimeSeries ARRAY<STRUCT<Period: ARRAY<STRUCT<
  timeInterval: STRUCT<start: STRING>, resolution: STRING,
  Point: ARRAY<STRUCT<position: INT, quantity: DOUBLE>>>>>>"""

# The names the weather feed uses, and ours.
WEATHER_FIELDS = {
    "temperature": "temperature_2m", "humidity": "relative_humidity_2m", "cloud_cover": "cloud_cover",
}
JSON_SCHEMA = "hourly STRUCT<time: ARRAY<STRING>, " + ", ".join(
    f"{field}: ARRAY<DOUBLE>" for field in WEATHER_FIELDS.values()
) + ">"


def _instant(text: Column) -> Column:
    """The feed writes instants to the minute; seconds are accepted too."""
    forms = ("yyyy-MM-dd'T'HH:mmX", "yyyy-MM-dd'T'HH:mm:ssX")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(form)) for form in forms])


def xml_load_points(df: DataFrame, xml_column: str, strict: bool = False) -> DataFrame:
    """One row per expected hour of every series in every document, with the document's other columns.

    Positions count hours from the period's start; a missing one up to the highest is a NULL value.
    A series without points gives no row. With `strict` a malformed document is an error, otherwise it
    gives no row.
    """
    options = {"mode": "FAILFAST" if strict else "PERMISSIVE", "ignoreNamespace": "true"}
    parsed = F.from_xml(F.col(xml_column), XML_SCHEMA, options)
    others = [c for c in df.columns if c != xml_column]
    series = df.select(*others, F.explode(parsed.getField("TimeSeries")).alias("__series"))
    period = F.try_element_at(F.col("__series.Period"), F.lit(1))
    points = period.getField("Point")
    per_period = series.select(
        *others,
        _instant(period.getField("timeInterval").getField("start")).alias("__start"),
        period.getField("resolution").alias("resolution"),
        points.alias("__points"),
        F.array_max(F.transform(points, lambda p: p["position"])).alias("__highest"),
    ).filter(F.col("__highest") >= 1)
    hours = per_period.withColumn("__position", F.explode(F.sequence(F.lit(1), F.col("__highest"))))
    # The last point wins where a document repeats a position.
    here = F.filter("__points", lambda p: p["position"] == F.col("__position"))
    return hours.select(
        *others,
        F.timestamp_add("HOUR", F.col("__position") - 1, F.col("__start")).alias("timestamp"),
        F.try_element_at(here, F.lit(-1)).getField("quantity").alias("value"),
        "resolution",
    )


def _at(values: Column, position: Column) -> Column:
    return F.try_element_at(values, position)


def weather_json_rows(df: DataFrame, json_column: str, timezone: str = TIMEZONE, strict: bool = False) -> DataFrame:
    """One row per hour of every document; its parallel arrays become columns, an absent array NULLs.

    Local times become UTC; an hour the zone skips in spring counts as the hour after it. With `strict`
    a document without times or temperatures is an error.
    """
    hourly = F.from_json(F.col(json_column), JSON_SCHEMA).getField("hourly")
    others = [c for c in df.columns if c != json_column]
    docs = df.select(*others, hourly.alias("__h"))
    if strict:
        usable = F.col("__h.time").isNotNull() & F.col(f"__h.{WEATHER_FIELDS['temperature']}").isNotNull()
        problem = F.raise_error(F.lit("weather document without hourly times or temperatures"))
        docs = docs.filter(F.when(usable, True).otherwise(problem.cast("boolean")))
    rows = docs.select("*", F.posexplode("__h.time").alias("__i", "__time"))
    return rows.select(
        *others,
        F.to_utc_timestamp(F.to_timestamp("__time"), timezone).alias("timestamp"),
        *[_at(F.col(f"__h.{f}"), F.col("__i") + 1).alias(n) for n, f in WEATHER_FIELDS.items()],
        F.lit(False).alias("is_weather_imputed"),
    )
