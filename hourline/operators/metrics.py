"""Forecast accuracy. Errors are added exactly, so a metric does not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline.config import MIN_ACTUALS, TARGET_MAPE
from hourline.functions.exact import ERROR, dec, exact_mean, square
from hourline.functions.scalar import ratio_pct
from hourline.operators.project import between_ts


def mae_of(error: Column) -> Column:
    return exact_mean(F.abs(error), ERROR)


def rmse_of(error: Column) -> Column:
    squared = square(error, ERROR)
    return F.sqrt(F.sum(squared).cast("double") / F.nullif(F.count(squared), F.lit(0)))


def mape_of(error: Column, actual: Column) -> Column:
    """Percent error where the actual is not zero; 0 when every actual is."""
    share = F.abs(ratio_pct(error, actual))
    return F.when(F.count(error) > 0, F.coalesce(exact_mean(share, ERROR), F.lit(0.0)))


def regression_metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = (), prefix: str = ""
) -> DataFrame:
    """MAE, RMSE, MAPE and the number of pairs, over the rows that have both values."""
    paired = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    error, truth = F.col(actual) - F.col(predicted), F.col(actual)
    return paired.groupBy(*by).agg(
        mae_of(error).alias(f"{prefix}mae"),
        rmse_of(error).alias(f"{prefix}rmse"),
        mape_of(error, truth).alias(f"{prefix}mape"),
        F.count(F.lit(1)).alias(f"{prefix}n"),
    )


def naive_metrics(
    df: DataFrame, actual: str = "actual", baseline: str = "baseline", by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy of the naive baseline. Without groups, no comparable pair at all is an error."""
    out = regression_metrics(df, actual, baseline, by, "naive_")
    if by:
        return out
    problem = "no comparable actuals and baseline predictions"
    checked = F.when(F.col("naive_n") > 0, F.col("naive_mae")).otherwise(
        F.raise_error(F.lit(problem)).cast("double")
    )
    return out.withColumn("naive_mae", checked)


def prediction_mae(
    df: DataFrame,
    start,
    end,
    by: Sequence[str] = ("series_id",),
    model: str | None = None,
    horizon: int = 24,
    minimum: int = MIN_ACTUALS,
    ts: str = "forecast_run_at",
) -> DataFrame:
    """MAE of the forecasts made in the window; NULL with fewer than `minimum` actuals."""
    rows = between_ts(df, start, end, ts).filter(F.col("horizon_hours") == horizon)
    if model is not None:
        rows = rows.filter(F.col("model_name") == model)
    return rows.groupBy(*by).agg(
        F.count("actual").alias("n_actuals"),
        mae_with_minimum(F.col("predicted") - F.col("actual"), minimum).alias("mae"),
    )


def mae_with_minimum(error: Column, minimum: int = MIN_ACTUALS) -> Column:
    return F.when(F.count(error) >= minimum, mae_of(error))


def r2(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()
) -> DataFrame:
    """1 - residual / total sum of squares; 0 when the actuals do not vary. One pass.

    The spread is Spark's mergeable central moment (count, mean, sum of squared deviations): nothing cancels, whatever
    the level of the actuals. The residual is a sum of squares of doubles.
    """
    paired = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    error, n = F.col(actual) - F.col(predicted), F.count(F.lit(1))
    spread = F.var_pop(actual) * n
    flat = F.min(actual) == F.max(actual)
    return paired.groupBy(*by).agg(
        F.when(flat | (spread <= 0), F.lit(0.0)).otherwise(F.lit(1.0) - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
        n.alias("n"),
    )


def weekly_mape(df: DataFrame, minimum: int = MIN_ACTUALS, target: float = TARGET_MAPE) -> DataFrame:
    """MAPE per ISO week and horizon of the weeks with enough measured hours."""
    share = ratio_pct(F.abs(F.col("actual") - F.col("predicted")), F.col("actual"))
    return (
        df.filter(F.col("actual").isNotNull())
        .groupBy(F.date_trunc("week", "timestamp").alias("week_start"), "horizon_hours")
        .agg(exact_mean(share, ERROR).alias("weekly_mape"), F.count(F.lit(1)).alias("n_observations"))
        .filter(F.col("n_observations") >= minimum)
        .withColumn("target_mape", F.lit(target))
        .orderBy("week_start", "horizon_hours")
    )


def cv_mae(
    df: DataFrame, fold: str = "fold", actual: str = "actual", predicted: str = "predicted",
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean over the folds of each fold's MAE."""
    folds = df.groupBy(*by, fold).agg(mae_of(F.col(actual) - F.col(predicted)).alias("fold_mae"))
    return folds.groupBy(*by).agg(
        exact_mean("fold_mae", ERROR).alias("cv_mae"), F.count("fold_mae").alias("folds")
    )
