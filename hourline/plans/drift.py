"""Data drift, prediction drift and the decision to retrain, for every series in one plan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourline.config import (
    COLUMN_DRIFT_THRESHOLD, COOLDOWN_HOURS, CURRENT_WINDOW_DAYS, DRIFT_CONSECUTIVE,
    DRIFT_MIN_ROWS, DRIFT_SHARE, MAE_DEGRADATION, MIN_ACTUALS, MODEL_FEATURES, REFERENCE_WINDOW_DAYS,
)
from hourline.functions.scalar import as_time, days_before
from hourline.operators.metrics import mae_with_minimum
from hourline.operators.project import prune_days
from hourline.operators.slices import SERIES, TS
from hourline.operators.windows import consecutive_true, cooldown

BINS = 10
CUTS = 16
METHODS = ("js", "ks", "wasserstein")

# The texts that explain a retrain decision.
NO_DRIFT = "No drift detected."
TOO_SHORT = "Drift detected for %dh (threshold: %dh)."
COOLING = "Cooldown active: last retrain %.1fh ago."
PENDING = "Retrain already pending (flag exists)."
TRIGGERED = "Drift detected for %d consecutive hours in features: %s."


def windows_of(now, reference: tuple | None = None) -> dict[str, tuple[Column, Column]]:
    """Bounds, both included, of the reference and the current window.

    The reference is the logged training window where there is one, else the days before the current.
    """
    now = as_time(now)
    current = days_before(now, CURRENT_WINDOW_DAYS)
    if reference is None:
        bounds = days_before(now, CURRENT_WINDOW_DAYS + REFERENCE_WINDOW_DAYS), current
    else:
        bounds = as_time(reference[0]), as_time(reference[1])
    return {"reference": bounds, "current": (current, now)}


def drift_windows(
    df: DataFrame, now, columns: Sequence[str] = ("value", *MODEL_FEATURES), reference: tuple | None = None
) -> DataFrame:
    """Rows of the two windows with their `window`; an hour on the common bound is in both."""
    bounds = windows_of(now, reference)
    in_window = {name: F.col(TS).between(*b) for name, b in bounds.items()}
    either = in_window["reference"] | in_window["current"]
    labels = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in in_window.items()]))
    starts, ends = zip(*bounds.values())
    rows = prune_days(df, F.least(*starts), F.greatest(*ends)).filter(either).select(*SERIES, TS, *columns)
    return rows.withColumn("window", F.explode(labels))


def enough_current(windows: DataFrame, minimum: int = DRIFT_MIN_ROWS, keys: Sequence[str] = SERIES) -> DataFrame:
    """Per series: rows in the current window, and whether they suffice."""
    n = F.count_if(F.col("window") == "current")
    return windows.groupBy(*keys).agg(n.alias("current_rows")).withColumn(
        "enough", F.col("current_rows") >= minimum
    )


def require_current(windows: DataFrame, minimum: int = DRIFT_MIN_ROWS, keys: Sequence[str] = SERIES) -> DataFrame:
    """Only the series with enough current rows."""
    ready = enough_current(windows, minimum, keys).filter("enough").select(*keys)
    return windows.join(ready, list(keys), "left_semi")


def _as_numbers(windows: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    kinds = dict(windows.dtypes)
    return windows.select(
        *keys, "window",
        *[(F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)).cast("double").alias(c) for c in columns],
    )


def _long(df: DataFrame, columns: Sequence[str], keys: Sequence[str], bucket: dict[str, Column]) -> DataFrame:
    """One row per value and column, with its bucket. Counted right away, so little of it is shuffled."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v"), bucket[c].alias("bucket")) for c in columns
    ])
    return df.select(*keys, "window", F.inline(cells)).filter(F.col("v").isNotNull())


def _counts() -> list[Column]:
    return [F.count_if(F.col("window") == w).alias(a) for w, a in (("reference", "r"), ("current", "c"))]


def _attach(df: DataFrame, stats: list[Column], keys: list[str]) -> DataFrame:
    """Rows with statistics of their series; without keys, of the whole frame."""
    if keys:
        return df.join(df.groupBy(*keys).agg(*stats), keys)
    return df.select("*", F.inline(F.array(df.agg(F.struct(*stats)).scalar())))


def _js_scores(numbers: DataFrame, columns: Sequence[str], keys: list[str], bins: int) -> DataFrame:
    """Jensen-Shannon divergence in bits over equal-width bins of the pooled range."""
    ends = [f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]
    joined = _attach(numbers, ends, keys)

    def bucket(c: str) -> Column:
        low, high = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        place = F.floor((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)) * bins)
        # A constant column has no width: everything falls into the first bin.
        return F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")

    counted = (
        _long(joined, columns, keys, {c: bucket(c) for c in columns})
        .groupBy(*keys, "column_name", "bucket").agg(*_counts())
    )
    total = Window.partitionBy(*keys, "column_name")
    shares = counted.withColumns({"p": F.col("r") / F.nullif(F.sum("r").over(total), F.lit(0)),
                                  "q": F.col("c") / F.nullif(F.sum("c").over(total), F.lit(0))})
    m = (F.col("p") + F.col("q")) / 2

    def part(x: str) -> Column:
        return F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(0.0)

    return shares.groupBy(*keys, "column_name").agg(
        # NULL where one of the windows has no value at all.
        F.when(F.count("p") * F.count("q") > 0, F.sum(part("p") + part("q")) / 2).alias("score")
    )


def _cumulative(numbers: DataFrame, columns: Sequence[str], keys: list[str], cuts: int) -> DataFrame:
    """Both empirical distribution functions at every distinct value, and the next distinct value.

    The values of a column are cut at sampled quantiles. Counts are added up inside each cut and over
    the cuts, so no task sorts a whole column, and the result is exact wherever the cuts fall.
    """
    steps = [i / cuts for i in range(1, cuts)]
    joined = _attach(numbers, [F.percentile_approx(c, steps, 1000).alias(f"__cuts_{c}") for c in columns], keys)

    def bucket(c: str) -> Column:
        value, at = F.col(c), F.col(f"__cuts_{c}")
        return reduce(add, [(at[i] < value).cast("int") for i in range(len(steps))], F.lit(0))

    each = [*keys, "column_name"]
    counted = (
        _long(joined, columns, keys, {c: bucket(c) for c in columns}).groupBy(*each, "bucket", "v").agg(*_counts())
    )
    # At most `cuts` rows per series and column from here on.
    per_cut = counted.groupBy(*each, "bucket").agg(F.sum("r").alias("cr"), F.sum("c").alias("cc"), F.min("v").alias("lowest"))
    along = Window.partitionBy(*each).orderBy("bucket")
    earlier, all_cuts = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*each)
    placed = per_cut.select(
        *each, "bucket",
        F.coalesce(F.sum("cr").over(earlier), F.lit(0)).alias("r0"), F.coalesce(F.sum("cc").over(earlier), F.lit(0)).alias("c0"),
        F.sum("cr").over(all_cuts).alias("rn"), F.sum("cc").over(all_cuts).alias("cn"),
        F.lead("lowest").over(along).alias("next_lowest"),
    )
    inside = Window.partitionBy(*each, "bucket").orderBy("v")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumns(
        {"ri": F.sum("r").over(so_far), "ci": F.sum("c").over(so_far), "next_v": F.lead("v").over(inside)}
    ).join(placed, [*each, "bucket"])
    return ranked.select(
        *each, "v", F.coalesce("next_v", "next_lowest").alias("next_v"),
        ((F.col("r0") + F.col("ri")) / F.nullif(F.col("rn"), F.lit(0))).alias("fr"),
        ((F.col("c0") + F.col("ci")) / F.nullif(F.col("cn"), F.lit(0))).alias("fc"),
    )


def column_scores(
    windows: DataFrame, columns: Sequence[str], method: str = "js", bins: int = BINS,
    keys: Sequence[str] = SERIES, cuts: int = CUTS,
) -> DataFrame:
    """Distance between the two windows per series and column.

    js           Jensen-Shannon divergence, base 2
    ks           largest difference of the distribution functions
    wasserstein  area between them, in standard deviations of the reference

    With no keys all series are one population; raise `cuts` to the number of tasks that should share
    a column then.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    keys = list(keys)
    numbers = _as_numbers(windows, columns, keys)
    if method == "js":
        return _js_scores(numbers, columns, keys, bins)
    curves = _cumulative(numbers, columns, keys, cuts)
    gap = F.abs(F.col("fr") - F.col("fc"))
    if method == "ks":
        return curves.groupBy(*keys, "column_name").agg(F.max(gap).alias("score"))
    area = curves.groupBy(*keys, "column_name").agg(
        F.when(F.count(gap) > 0, F.coalesce(F.sum(gap * (F.col("next_v") - F.col("v"))), F.lit(0.0))).alias("area")
    )
    known = numbers.filter(F.col("window") == "reference").groupBy(*keys).agg(
        *[F.stddev_pop(c).alias(c) for c in columns]
    )
    spread = known.unpivot(keys, list(columns), "column_name", "spread")
    return area.join(spread, [*keys, "column_name"], "left").select(
        *keys, "column_name",
        (F.col("area") / F.greatest(F.coalesce("spread", F.lit(0.0)), F.lit(0.001))).alias("score"),
    )


def column_drift(
    windows: DataFrame,
    columns: Sequence[str],
    method: str = "js",
    threshold: float = COLUMN_DRIFT_THRESHOLD,
    bins: int = BINS,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Scores with `drifted`: the score reaches the threshold. No value in a window: no drift."""
    scored = column_scores(windows, columns, method, bins, keys)
    return scored.withColumn("drifted", F.coalesce(F.col("score") >= threshold, F.lit(False)))


def dataset_drift(scores: DataFrame, share: float = DRIFT_SHARE, keys: Sequence[str] = SERIES) -> DataFrame:
    """Per series: whether enough columns drifted, how many, and their sorted names.

    The list holds column names, so its length is bounded by the number of columns.
    """
    names = F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("column_name"))))

    def score_of(column: str) -> Column:
        return F.max(F.when(F.col("column_name") == column, F.col("score")))

    return scores.groupBy(*keys).agg(
        (F.avg(F.col("drifted").cast("int")) >= share).alias("data_drift_detected"),
        F.count_if("drifted").cast("int").alias("n_drifted_features"),
        F.concat_ws(",", names).alias("drifted_features"),
        score_of("value").alias("drift_score_value"),
        score_of("temperature").alias("drift_score_temperature"),
    )


def prediction_drift(
    forecasts: DataFrame,
    now,
    reference: tuple | None = None,
    model: str | None = None,
    horizon: int = 24,
    factor: float = MAE_DEGRADATION,
    minimum: int = MIN_ACTUALS,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """MAE of both windows in one pass; drift when the current one is worse by more than the factor."""
    bounds = windows_of(now, reference)
    made = F.col("forecast_run_at")
    inside = {name: made.between(*b) for name, b in bounds.items()}
    rows = forecasts.filter((F.col("horizon_hours") == horizon) & (inside["reference"] | inside["current"]))
    if model is not None:
        rows = rows.filter(F.col("model_name") == model)
    error = F.col("predicted") - F.col("actual")
    out = rows.groupBy(*keys).agg(
        mae_with_minimum(F.when(inside["current"], error), minimum).alias("prediction_mae_current"),
        mae_with_minimum(F.when(inside["reference"], error), minimum).alias("prediction_mae_reference"),
    )
    worse = F.col("prediction_mae_current") > F.col("prediction_mae_reference") * factor
    return out.withColumn("prediction_drift_detected", F.coalesce(worse, F.lit(False)))


def retrain_decision(
    current: DataFrame,
    history: DataFrame,
    pending: DataFrame,
    now,
    threshold: int = DRIFT_CONSECUTIVE,
    cooldown_hours: int = COOLDOWN_HOURS,
    cap: int | None = None,
    contiguous: bool = False,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """Adds `consecutive_drift_hours`, `retrain_triggered` and `reason` to the current findings.

    The rules apply in order: no drift, too short a run, cooldown, a flag already pending, trigger.
    """
    keys = list(keys)
    runs = consecutive_true(history, "any_drift_detected", keys, cap=cap, contiguous=contiguous)
    waits = cooldown(history, as_time(now), keys).select(*keys, "hours_since_trigger")
    flagged = pending.select(*keys).distinct().withColumn("__pending", F.lit(True))
    joined = current.join(runs, keys, "left").join(waits, keys, "left").join(flagged, keys, "left")
    drift = F.col("any_drift_detected")
    length = F.when(drift, F.coalesce("consecutive", F.lit(0)) + 1).otherwise(0).cast("int")
    out = joined.withColumn("consecutive_drift_hours", length)
    n, since = F.col("consecutive_drift_hours"), F.col("hours_since_trigger")
    listed = F.replace("drifted_features", F.lit(","), F.lit(", "))
    reason = (
        F.when(~drift, NO_DRIFT)
        .when(n < threshold, F.format_string(TOO_SHORT, n, F.lit(threshold)))
        .when(since < cooldown_hours, F.format_string(COOLING, since))
        .when(F.col("__pending"), PENDING)
        .otherwise(F.format_string(TRIGGERED, n, listed))
    )
    blocked = ~drift | (n < threshold) | F.coalesce(since < cooldown_hours, F.lit(False)) | F.coalesce("__pending", F.lit(False))
    return out.withColumns({"retrain_triggered": ~blocked, "reason": reason}).drop(
        "consecutive", "hours_since_trigger", "__pending"
    )


def drift_check(
    features: DataFrame,
    forecasts: DataFrame,
    history: DataFrame,
    pending: DataFrame,
    now,
    columns: Sequence[str] = ("value", *MODEL_FEATURES),
    method: str = "js",
    column_threshold: float = COLUMN_DRIFT_THRESHOLD,
    share: float = DRIFT_SHARE,
    minimum: int = DRIFT_MIN_ROWS,
    reference: tuple | None = None,
    model: str | None = None,
    keys: Sequence[str] = SERIES,
) -> DataFrame:
    """The drift record of this hour for every series with enough data that has none yet."""
    keys = list(keys)
    check = F.date_trunc("hour", as_time(now))
    done = history.filter(F.col("check_timestamp") == check)
    windows = require_current(drift_windows(features, check, columns, reference), minimum, keys)
    data = dataset_drift(column_drift(windows, columns, method, column_threshold, keys=keys), share, keys)
    predicted = prediction_drift(forecasts, check, reference, model, keys=keys)
    found = data.join(predicted, keys, "left").join(done.select(*keys), keys, "left_anti").withColumn(
        "prediction_drift_detected", F.coalesce("prediction_drift_detected", F.lit(False))
    )
    found = found.withColumn("any_drift_detected", F.col("data_drift_detected") | F.col("prediction_drift_detected"))
    decided = retrain_decision(found, history, pending, check, keys=keys)
    start, end = windows_of(check, reference)["current"]
    return decided.withColumns(
        {"check_timestamp": check, "window_start": start, "window_end": end,
         "report_path": F.lit(None).cast("string"), "created_at": check}
    )
