"""Model runs as a table: records, champion against challenger, promotion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline import schemas
from hourline.config import PROMOTION_GAIN
from hourline.functions.scalar import as_time, number_text, percent_text, promotion_id
from hourline.operators.joins import best_other
from hourline.operators.project import conform
from hourline.operators.windows import latest_per
from hourline.sources.upsert import update_where

# The texts that explain a promotion decision.
FORCED = "Force promotion requested via widget"
FIRST = "No Production version exists — promoting unconditionally"
INVALID = "Invalid challenger metrics — promotion skipped"
PROMOTED_BY = "automated_pipeline"


def run_record(spark: SparkSession, record: Mapping[str, object]) -> DataFrame:
    """One row of the run table; names the record leaves out are NULL."""
    names = schemas.MODEL_RUNS.fieldNames()
    unknown = set(record) - set(names)
    if unknown:
        raise ValueError(f"unknown run fields: {sorted(unknown)}")
    values = {"production": False} | dict(record)
    return spark.createDataFrame([tuple(values.get(n) for n in names)], schemas.MODEL_RUNS)


def champion_challenger(runs: DataFrame, evaluated_at, threshold: float = PROMOTION_GAIN) -> DataFrame:
    """Per model: its newest run against the best of its other runs.

    The challenger wins if it is the only run, or if it lowers the MAPE by more than the threshold.
    `beats_baseline` compares it with the naive forecast and is NULL when either is unknown.
    """
    newest = F.col("started_at").desc(), F.col("run_id")
    challenger = latest_per(runs, ["model_name"], *newest)
    best = best_other(challenger, runs, "model_name", "run_id", "mape", *newest)
    champion = best.select(
        F.col("__row").alias("challenger_run_id"), F.col("run_id").alias("champion_run_id"),
        *[F.col(m).alias(f"champion_{m}") for m in ("mae", "rmse", "mape")],
    )
    new = challenger.select(
        "model_name", "horizon_hours", F.col("run_id").alias("challenger_run_id"),
        *[F.col(m).alias(f"challenger_{m}") for m in ("mae", "rmse", "mape")],
        *[F.col(f"naive_{m}").alias(f"baseline_{m}") for m in ("mae", "rmse", "mape")],
    )
    joined = new.join(champion, "challenger_run_id", "left")
    first = F.col("champion_run_id").isNull()
    wins = first | F.coalesce(relative_gain(F.col("champion_mape"), F.col("challenger_mape")) > threshold, F.lit(False))
    out = joined.withColumns(
        {
            "beats_baseline": F.col("challenger_mape") < F.col("baseline_mape"),
            "challenger_wins": wins, "first_run": first,
            "evaluated_at": as_time(evaluated_at), "promoted": F.lit(False),
        }
    )
    return conform(out, schemas.MODEL_EVALUATION)


def relative_gain(champion: Column, challenger: Column) -> Column:
    return (champion - challenger) / F.nullif(champion, F.lit(0.0))


def recommend(evaluation: DataFrame) -> DataFrame:
    """A line of advice per model, and a warning where it does not beat the naive forecast."""
    mape, champion = F.col("challenger_mape"), F.col("champion_mape")
    against = F.when(champion.isNull() | (champion == 0), F.lit("N/A")).otherwise(number_text(champion, 2))
    verdict = F.when(F.col("challenger_wins"), "PROMOTE").otherwise("SKIP")
    line = F.format_string("%s: %s (MAPE: %.2f%% vs %s)", verdict, F.col("model_name"), mape, against)
    warning = F.when(
        F.col("beats_baseline") == F.lit(False),
        F.format_string(
            "WARNING: %s does NOT beat the naive baseline (model %.2f%% vs baseline %.2f%%).",
            F.col("model_name"), mape, F.col("baseline_mape"),
        ),
    )
    return evaluation.select("model_name", line.alias("recommendation"), warning.alias("warning"))


def decide_promotions(
    evaluation: DataFrame, runs: DataFrame, threshold: float = PROMOTION_GAIN, force: bool = False
) -> DataFrame:
    """A decision for the newest open evaluation of each model against its run in production."""
    open_rows = latest_per(evaluation.filter(~F.col("promoted")), ["model_name"], F.col("evaluated_at").desc())
    serving = latest_per(
        runs.filter("production"), ["model_name"], F.col("mape").asc_nulls_last(), F.col("run_id")
    ).select("model_name", F.col("run_id").alias("champion_run_id"), F.col("mape").alias("champion_mape"))
    rows = open_rows.select("model_name", "challenger_run_id", "challenger_mape").join(serving, "model_name", "left")
    champion, challenger = F.col("champion_mape"), F.col("challenger_mape")
    first = champion.isNull() | (champion == 0)
    gain = relative_gain(champion, challenger)
    improved = F.format_string(
        "MAPE improved by %s (%s%% -> %s%%)", percent_text(gain), number_text(champion), number_text(challenger)
    )
    too_little = F.format_string(
        "Insufficient improvement (%s < %s). Keeping champion.", percent_text(gain), percent_text(F.lit(threshold))
    )
    forced = F.lit(force)
    promote = forced | first | F.coalesce(gain > threshold, F.lit(False))
    reason = (
        F.when(forced, FORCED).when(first, FIRST).when(challenger.isNull(), INVALID)
        .when(gain > threshold, improved).otherwise(too_little)
    )
    return rows.withColumns({"first_run": first, "should_promote": promote, "promotion_reason": reason})


def apply_promotions(
    decisions: DataFrame, runs: DataFrame, evaluation: DataFrame, now, dry_run: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Run and evaluation tables after the decisions: champions retired, winners in production, every
    decided evaluation closed. A dry run changes nothing."""
    if dry_run:
        return runs, evaluation
    promoted = decisions.filter("should_promote")
    retired = update_where(runs, promoted, {"run_id": "champion_run_id"}, {"production": F.lit(False)})
    tagged = update_where(
        retired, promoted, {"run_id": "challenger_run_id"},
        {"production": F.lit(True), "promoted_at": as_time(now)},
    )
    closed = update_where(evaluation, decisions, ["challenger_run_id"], {"promoted": F.lit(True)})
    return tagged, closed


def promotion_log(decisions: DataFrame, now, flags: DataFrame | None = None, version: str | None = None) -> DataFrame:
    """Audit rows of the decisions, with the drift that asked for them (flags pending for the run)."""
    now = as_time(now)
    rows = decisions
    if flags is None:
        rows = rows.withColumns({"drift_triggered": F.lit(False), "drifted_features": F.lit("")})
    else:
        # One row; the set holds feature names, so it is bounded by their number.
        named = flags.select(F.explode_outer("drifted_features").alias("name"))
        found = named.agg(
            F.struct(
                (F.count(F.lit(1)) > 0).alias("triggered"),
                F.concat_ws(",", F.array_sort(F.collect_set("name"))).alias("features"),
            )
        ).scalar()
        rows = rows.withColumn("__drift", found).withColumns(
            {"drift_triggered": F.col("__drift.triggered"), "drifted_features": F.col("__drift.features")}
        )
    out = rows.withColumns(
        {
            "promotion_id": promotion_id("model_name", "challenger_run_id", now),
            "promoted_at": now, "created_at": now, "promoted_by": F.lit(PROMOTED_BY),
            "challenger_version": F.lit(version).cast("string"), "champion_version": F.lit(None).cast("string"),
        }
    )
    return conform(out, schemas.PROMOTION_LOG)
