"""Joins along the hourly grid. Strategies are left to the optimizer, which knows the sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourline.config import WEATHER_COLUMNS
from hourline.operators.slices import BLOCK_HOURS, SERIES, TS
from hourline.operators.windows import latest_per


def join_weather(
    load: DataFrame, weather: DataFrame | None, columns: Sequence[str] = WEATHER_COLUMNS
) -> DataFrame:
    """Every load row with the weather of its hour; absent hours and absent columns are NULL.

    Weather may be per series or shared by all of them (no `series_id` column).
    """
    kinds = {c: "double" for c in columns} | {"is_weather_imputed": "boolean"}
    have = [] if weather is None else [c for c in kinds if c in weather.columns]
    out = load
    if have:
        keys = [c for c in (*SERIES, TS) if c in weather.columns]
        out = load.join(weather.select(*keys, *have), keys, "left")
    return out.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in have})


def attach_actuals(
    forecasts: DataFrame, actuals: DataFrame, column: str = "value", name: str = "actual",
    keys: Sequence[str] = (*SERIES, TS),
) -> DataFrame:
    """Forecasts with the measured value of their hour, NULL where there is none yet."""
    side = actuals.select(*keys, F.col(column).alias(name))
    return forecasts.drop(name).join(side, list(keys), "left")


def newest_run_rows(
    df: DataFrame, run: str = "forecast_run_at", by: Sequence[str] = ()
) -> DataFrame:
    """Rows of the newest run, over everything or per `by`."""
    newest = F.max(run).alias("__newest")
    if by:
        return df.join(df.groupBy(*by).agg(newest).withColumnRenamed("__newest", run), [*by, run], "left_semi")
    return df.join(df.agg(newest), F.col(run) == F.col("__newest"), "left_semi")


def lookup_at(
    df: DataFrame,
    history: DataFrame,
    hours: Sequence[int],
    column: str = "value",
    names: Sequence[str] | None = None,
    fallback: bool = True,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """The history value exactly `h` hours before each row, for every `h`, in one join.

    Each history row is sent to the hours that look it up; pivoting them there costs one shuffle
    however many offsets there are. With `fallback`, an hour absent from the history takes the
    series' last known value.
    """
    keys = list(keys)
    names = list(names or [f"lag_{h}h" for h in hours])
    sent = history.select(
        *keys, TS, F.col(column).alias("__v"), F.explode(F.array(*[F.lit(h) for h in hours])).alias("__h")
    ).withColumn(TS, F.timestamp_add("HOUR", F.col("__h"), F.col(TS)))
    # An hour that is there without a value is not an hour that is absent, so presence is kept apart.
    picks = []
    for h, n in zip(hours, names):
        here = F.col("__h") == h
        picks += [F.max(F.when(here, F.col("__v"))).alias(f"__v_{n}"), F.count_if(here).alias(f"__n_{n}")]
    found = sent.groupBy(*keys, TS).agg(*picks)
    out = df.join(found, [*keys, TS], "left")
    if fallback:
        known = F.col(column).isNotNull()
        last = history.groupBy(*keys).agg(
            F.max_by(F.when(known, F.col(column)), F.when(known, F.col(TS))).alias("__last")
        )
        out = out.join(last, keys, "left")
    absent = F.col("__last") if fallback else F.lit(None).cast("double")
    values = {n: F.when(F.col(f"__n_{n}") > 0, F.col(f"__v_{n}")).otherwise(absent) for n in names}
    return out.withColumns(values).drop(*[f"__{p}_{n}" for p in "vn" for n in names], "__last")


def weather_proxy(
    future: DataFrame,
    history: DataFrame,
    columns: Sequence[str] = WEATHER_COLUMNS,
    days: int = 7,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Weather of the same hour `days` ago for all columns in one join, else that of the last row."""
    keys = list(keys)
    then = history.select(
        *keys, F.timestamp_add("HOUR", F.lit(24 * days), F.col(TS)).alias(TS), F.lit(True).alias("__then"),
        *[F.col(c).alias(f"__then_{c}") for c in columns],
    )
    last = history.groupBy(*keys).agg(*[F.max_by(c, TS).alias(f"__last_{c}") for c in columns])
    out = future.drop(*columns).join(then, [*keys, TS], "left").join(last, keys, "left")
    found = F.col("__then").isNotNull()
    picked = {c: F.when(found, F.col(f"__then_{c}")).otherwise(F.col(f"__last_{c}")) for c in columns}
    return out.withColumns(picked).drop("__then", *[f"__{p}_{c}" for p in ("then", "last") for c in columns])


def absent_spans(df: DataFrame, keys: Sequence[str] = SERIES, slice_hours: int = BLOCK_HOURS) -> DataFrame:
    """The stretches of hours without a row between a series' rows: the hour `before` and the hour `after` each stretch.

    Neighbours are found per slice of time, so a hot series is no single task; the first hours of the slices, a row for each
    slice that has rows, give the neighbour of a slice's last hour. Nothing is laid out hour by hour.
    """
    keys = list(keys)
    hour = F.date_trunc("hour", TS)
    sliced = F.floor(F.unix_seconds("before") / (3600 * slice_hours))
    hours = df.select(*keys, hour.alias("before")).distinct().withColumn("__slice", sliced)
    starts = hours.groupBy(*keys, "__slice").agg(F.min("before").alias("__start"))
    along = Window.partitionBy(*keys).orderBy("__slice")
    edges = starts.select(*keys, "__slice", F.lead("__start").over(along).alias("__edge"))
    inside = Window.partitionBy(*keys, "__slice").orderBy("before")
    placed = hours.withColumn("after", F.lead("before").over(inside)).join(edges, [*keys, "__slice"])
    spans = placed.select(*keys, "before", F.coalesce("after", "__edge").alias("after"))
    return spans.filter(F.unix_seconds("after") - F.unix_seconds("before") > 3600)


def missing_hours(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Hours between a series' first and last row for which it has no row at all. Only the gaps are laid out, a long one in
    parts that are dealt anew."""
    step = F.expr("interval 1 hour")
    first, last = F.timestamp_add("HOUR", F.lit(1), F.col("before")), F.timestamp_add("HOUR", F.lit(-1), F.col("after"))
    parts = absent_spans(df, keys).select(
        *keys, last.alias("__last"), F.explode(F.sequence(first, last, F.expr(f"interval {BLOCK_HOURS} hours"))).alias("__first"))
    end = F.least("__last", F.timestamp_add("HOUR", F.lit(BLOCK_HOURS - 1), F.col("__first")))
    return parts.hint("rebalance").select(*keys, F.explode(F.sequence(F.col("__first"), end, step)).alias(TS))


def only_missing(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    return expected.join(present, list(on), "left_anti")


def best_other(
    rows: DataFrame, candidates: DataFrame, key: str, candidate_id: str, metric: str, *tie: Column
) -> DataFrame:
    """For each row, the candidate with the same key and the lowest metric that is not the row itself.

    `rows` carries `candidate_id` too. Only the two best of each key can win, so the join stays narrow.
    """
    shortlist = latest_per(candidates, [key], F.col(metric).asc_nulls_last(), *tie, n=2)
    left, right = rows.alias("r"), shortlist.alias("c")
    paired = left.join(
        right,
        (F.col(f"r.{key}") == F.col(f"c.{key}")) & (F.col(f"r.{candidate_id}") != F.col(f"c.{candidate_id}")),
    ).select(F.col(f"r.{candidate_id}").alias("__row"), "c.*")
    return latest_per(paired, ["__row"], F.col(metric).asc_nulls_last(), *tie)
