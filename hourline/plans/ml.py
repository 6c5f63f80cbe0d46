"""Trained models: boosted trees per horizon with `pyspark.ml`, a seasonal curve per series, and tuning.

Trees are trained on all series together. Every pass of a fit is a distributed job over the training
table, which is written once to the shared folder; only metrics and trees reach the driver. Seasonal curves are
fitted for every series in one pass, by sums of products, and solved where the sums are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool
from random import Random

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from hourline.config import (
    CV_FOLDS, CV_GAP, CV_TEST, MIN_TRAINING_ROWS, MODEL_FEATURES, TEST_DAYS, TUNING_TRIALS, VAL_DAYS,
)
from hourline.functions.calendar import add_calendar
from hourline.functions.exact import exact_mean
from hourline.functions.scalar import as_time, hours_before
from hourline.operators.metrics import cv_mae, naive_metrics, regression_metrics
from hourline.operators.windows import add_target
from hourline.plans.splits import holdout_split, ts_folds
from hourline.session import shared_dir, written

LABEL = "target"

# The defaults of the boosted trees, used wherever tuning names nothing else.
DEFAULT_PARAMS = {
    "maxIter": 500, "stepSize": 0.05, "maxDepth": 6, "minInstancesPerNode": 20,
    "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "lossType": "squared", "seed": 42,
}
PATIENCE, TUNING_PATIENCE, TUNING_ROUNDS = 50, 20, 100
ROWS_PER_TASK = 50_000

# What the search draws from; (low, high, scale) or a list of choices.
SEARCH_SPACE = {
    "maxDepth": (4, 6, "int"),
    "stepSize": (0.005, 0.1, "log"),
    "minInstancesPerNode": (5, 30, "int"),
    "subsamplingRate": (0.6, 1.0, "float"),
    "featureSubsetStrategy": (0.6, 1.0, "share"),
    "lossType": ["squared", "absolute"],
}


@dataclass(frozen=True)
class Trained:
    """A fitted model with its scores on the test rows and what the run table records."""

    model: PipelineModel
    metrics: dict[str, float]
    params: dict[str, object]
    best_round: int
    n_train: int
    n_test: int
    training_start: object
    training_end: object
    features: tuple[str, ...] = field(default=MODEL_FEATURES)

    def record(self, run_id: str, model_name: str, family: str, horizon: int, started_at, model_path: str | None = None) -> dict:
        return {
            "run_id": run_id, "model_name": model_name, "family": family, "horizon_hours": horizon,
            "started_at": started_at, **self.metrics, "n_train": self.n_train, "n_test": self.n_test,
            "training_data_start": self.training_start, "training_data_end": self.training_end,
            "params": {k: str(v) for k, v in {**self.params, "best_round": self.best_round}.items()},
            "model_path": model_path,
        }


def save_model(trained: Trained, path: str) -> str:
    """Stores the fitted stages under a path any later session can load."""
    trained.model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def direct_forecast(model: PipelineModel, features: DataFrame, run_at, horizon: int) -> DataFrame:
    """Predictions for the next `horizon` hours from the feature rows of the last `horizon` hours.

    The model predicts the value `horizon` hours after its features, so every input is measured, none
    is assumed; where one is missing, or the whole row of an hour, it is filled by `filled_inputs` and flagged, so
    that every series with a row in these hours has one forecast an hour. `forecast.shape_forecasts` files the rows
    with `target_hours_ahead=horizon`.
    """
    now = as_time(run_at)
    history = features.filter(F.col("timestamp") <= now)
    recent = features.filter((F.col("timestamp") > hours_before(now, horizon)) & (F.col("timestamp") <= now))
    columns = model.stages[0].getInputCols()
    last = F.date_trunc("hour", now)
    hours = F.sequence(F.timestamp_add("HOUR", F.lit(1 - horizon), last), last, F.expr("INTERVAL 1 HOUR"))
    grid = recent.select("series_id").distinct().select("series_id", F.explode(hours).alias("timestamp"))
    absent = add_calendar(grid.join(recent.select("series_id", "timestamp"), ["series_id", "timestamp"], "left_anti"))
    absent = absent.select("series_id", "timestamp", *[c for c in columns if c in absent.columns])
    rows = as_numbers(recent, columns).unionByName(as_numbers(absent, [c for c in columns if c in absent.columns]), allowMissingColumns=True)
    return model.transform(filled_inputs(rows, history, columns))


def as_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The keys and the columns as doubles."""
    kinds = dict(df.dtypes)
    return df.select("series_id", "timestamp", *[
        (F.col(c).cast("int") if kinds[c] == "boolean" else F.col(c)).cast("double").alias(c) for c in columns
    ])


def filled_inputs(rows: DataFrame, history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The keys and the columns as doubles, none NULL: a missing value is its series' mean in `history`, else the mean
    of all series, else 0. `inputs_imputed` marks the rows with such a value. No row is dropped."""
    known = as_numbers(history, columns)
    means = known.groupBy("series_id").agg(*[exact_mean(c).alias(f"__own_{c}") for c in columns])
    overall = known.agg(*[exact_mean(c).alias(f"__all_{c}") for c in columns])
    joined = as_numbers(rows, columns).join(means, "series_id", "left").crossJoin(overall)
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return joined.select(
        "series_id", "timestamp", *[F.coalesce(c, f"__own_{c}", f"__all_{c}", F.lit(0.0)).alias(c) for c in columns],
        missing.alias("inputs_imputed"),
    )


def _checkpointing(spark: SparkSession) -> None:
    """Long boosting lineages are cut in the shared folder; a folder the cluster has set stays."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def model_frame(
    features: DataFrame, horizon: int, columns: Sequence[str] = MODEL_FEATURES, mode: str = "time", baseline: str = "value"
) -> DataFrame:
    """Rows usable for training: the target `horizon` hours ahead and every input known. `__naive` is the baseline."""
    have = dict(features.dtypes)
    numeric = [
        (F.col(c).cast("int") if have[c] == "boolean" else F.col(c)).cast("double").alias(c) for c in columns
    ]
    framed = add_target(features, horizon, mode=mode).select("series_id", "timestamp", "value", F.col(baseline).alias("__naive"), LABEL, *numeric)
    return framed.na.drop(subset=[LABEL, *columns])


def best_round(curve: Sequence[float], patience: int) -> int:
    """Rounds to keep, given the validation loss after each: the best one seen before the loss failed
    to improve for `patience` rounds."""
    best, at = math.inf, 0
    for i, loss in enumerate(curve, 1):
        if loss < best:
            best, at = loss, i
        elif i - at >= patience:
            break
    return max(at, 1)


def _gbt(params: Mapping[str, object], columns: Sequence[str]) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol=LABEL, predictionCol="prediction", **params)
    return Pipeline(stages=[assembler, trees])


def first_trees(model: PipelineModel, keep: int) -> PipelineModel:
    """The fitted model with its first `keep` trees alone: what a fit of as many rounds with the same seed gives."""
    full: GBTRegressionModel = model.stages[-1]
    spark = SparkSession.active()
    trees = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, keep)
    weights = spark.sparkContext._gateway.new_array(spark._jvm.double, keep)
    for i, (tree, weight) in enumerate(zip(full.trees[:keep], full.treeWeights[:keep], strict=True)):
        trees[i], weights[i] = tree._java_obj, float(weight)
    short = spark._jvm.org.apache.spark.ml.regression.GBTRegressionModel(full.uid, trees, weights, full.numFeatures)
    for name in ("featuresCol", "predictionCol", "labelCol"):
        short.set(short.getParam(name), full.getOrDefault(name))
    return PipelineModel([*model.stages[:-1], GBTRegressionModel(short)])


def fit_early_stopped(
    train: DataFrame, validation: DataFrame, params: Mapping[str, object], columns: Sequence[str], patience: int
) -> tuple[PipelineModel, int]:
    """Fits until the loss on the validation rows has failed to improve for `patience` rounds, or for all rounds, and keeps the
    trees up to the best round.

    The seed makes a shorter fit the prefix of a longer one. So the fit starts with little more than `patience` rounds and
    is made anew only while its best round is too near its end: twice as long if that round is in its first half, else, where
    the loss is still falling, at once with all rounds. Nothing is fitted again to drop the trees after the best.
    """
    most = int(params["maxIter"])
    rounds = min(most, patience + max(1, patience // 5))
    while True:
        full = _gbt({**params, "maxIter": rounds}, columns).fit(train)
        trees: GBTRegressionModel = full.stages[-1]
        curve = trees.evaluateEachIteration(full.stages[0].transform(validation), str(params.get("lossType", "squared")))
        keep = best_round(curve, patience)
        if rounds == most or keep + patience <= rounds:
            return (full if keep == trees.getNumTrees else first_trees(full, keep)), keep
        rounds = most if 2 * keep > rounds else min(most, 2 * rounds)


def _one_row(df: DataFrame) -> dict:
    return df.first().asDict()


def train_gbt(
    features: DataFrame,
    horizon: int,
    params: Mapping[str, object] | None = None,
    columns: Sequence[str] = MODEL_FEATURES,
    val_days: int = VAL_DAYS,
    test_days: int = TEST_DAYS,
    min_rows: int = MIN_TRAINING_ROWS,
    patience: int = PATIENCE,
    mode: str = "time",
    baseline: str = "value",
) -> Trained:
    """Boosted trees for one horizon: stopped early on the validation days, scored on the test days, as is the naive
    forecast `baseline`. Horizon 0 trains on the value of the features' own hour."""
    _checkpointing(features.sparkSession)
    settings = {**DEFAULT_PARAMS, **(params or {})}
    rows = written(holdout_split(model_frame(features, horizon, columns, mode, baseline), val_days, test_days), "training")
    part = {name: rows.filter(F.col("split") == name) for name in ("train", "val", "test")}
    size = _one_row(part["train"].agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b")))
    if size["n"] < min_rows:
        raise ValueError(f"insufficient training data: need {min_rows} rows, got {size['n']}")
    train = part["train"].coalesce(max(1, size["n"] // ROWS_PER_TASK))  # every level of every tree is a job over these tasks
    model, rounds = fit_early_stopped(train, part["val"], settings, columns, patience)
    scored = model.transform(part["test"])
    fitted = _one_row(regression_metrics(scored, LABEL, "prediction"))
    naive = _one_row(naive_metrics(part["test"], LABEL, "__naive"))
    return Trained(
        model=model,
        metrics={k: fitted[k] for k in ("mae", "rmse", "mape")} | {k: naive[k] for k in ("naive_mae", "naive_rmse", "naive_mape")},
        params=settings, best_round=rounds, n_train=size["n"], n_test=fitted["n"],
        training_start=size["a"], training_end=size["b"], features=tuple(columns),
    )


# --- seasonal regression --------------------------------------------------------------------------

# Period in days and number of sine and cosine pairs of each season.
SEASONS = {"yearly": (365.25, 10), "weekly": (7.0, 3), "daily": (1.0, 4)}


SERIES_IN_MEMORY, GRAM_PARTS = 1024, 64


def seasonal_terms(ts: str = "timestamp", seasons: Mapping[str, tuple[float, int]] = SEASONS) -> dict[str, Column]:
    """The trend and the Fourier pairs of every season, from the time alone."""
    days = F.unix_seconds(ts) / F.lit(86400.0)
    terms: dict[str, Column] = {"trend": days / F.lit(365.25) - F.lit(45.0)}
    for name, (period, order) in seasons.items():
        for k in range(1, order + 1):
            angle = days * F.lit(2 * math.pi * k / period)
            terms[f"{name}_sin_{k}"], terms[f"{name}_cos_{k}"] = F.sin(angle), F.cos(angle)
    return terms


@dataclass(frozen=True)
class Seasonal:
    """One curve per series: `curves` (series_id, n, intercept, weights) and `scores`, a row of the run table for each."""

    curves: DataFrame
    scores: DataFrame
    regressors: tuple[str, ...]


def _inputs(regressors: Sequence[str]) -> list[Column]:
    return [*seasonal_terms().values(), *[F.col(c).cast("double") for c in regressors]]


def _gram_parts(batches):
    """Rows (series_id, x) -> for each series met the sums of the products of 1 and all entries of x."""
    task, sums = TaskContext.get().partitionId(), {}

    def flush():
        table = pa.table({
            "series_id": pa.array(list(sums), pa.string()), "task": pa.array([task] * len(sums), pa.int32()),
            "gram": pa.array([g.ravel() for g in sums.values()], pa.list_(pa.float64())),
        })
        sums.clear()
        return table.to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).dictionary_encode()
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        x = np.hstack([np.ones((len(x), 1)), x])
        index = keys.indices.to_numpy(zero_copy_only=False)
        for i, key in enumerate(keys.dictionary.to_pylist()):
            own = x[index == i]
            sums[key] = sums.get(key, 0) + own.T @ own
        if len(sums) > SERIES_IN_MEMORY:
            yield from flush()
    yield from flush()


def _added(rows: pa.Table) -> np.ndarray:
    rows = rows.sort_by("task")  # doubles are added in one order, whichever task ends first
    return np.sum([np.array(g) for g in rows.column("gram").to_pylist()], axis=0)


def _merge_parts(rows: pa.Table) -> pa.Table:
    return pa.table({
        "series_id": rows.column("series_id")[:1], "task": rows.column("part")[:1],
        "gram": pa.array([_added(rows)], pa.list_(pa.float64())),
    })


def _solved(ridge: float):
    """The curve of one series from its sums: Cholesky on the standardised normal equations."""
    def run(rows: pa.Table) -> pa.Table:
        sums = _added(rows)
        size = math.isqrt(len(sums))
        sums = sums.reshape(size, size)
        n, mean = sums[0, 0], sums[0, 1:] / sums[0, 0]
        spread = sums[1:, 1:] / n - np.outer(mean, mean)
        deviation = np.sqrt(np.maximum(np.diag(spread), 0))
        fixed = deviation <= 1e-9 * np.maximum(np.abs(mean), 1)  # a column that does not vary gets no weight
        deviation[fixed] = 1
        spread[fixed, :] = spread[:, fixed] = 0
        alike = spread / np.outer(deviation, deviation)
        root = np.linalg.cholesky(alike[:-1, :-1] + (ridge + 1e-12) * np.eye(size - 2))
        weights = np.linalg.solve(root.T, np.linalg.solve(root, alike[:-1, -1])) * deviation[-1] / deviation[:-1]
        return pa.table({
            "series_id": rows.column("series_id")[:1], "n": pa.array([int(round(n))], pa.int64()),
            "intercept": pa.array([mean[-1] - weights @ mean[:-1]], pa.float64()),
            "weights": pa.array([weights], pa.list_(pa.float64())),
        })

    return run


def gram_sums(rows: DataFrame, inputs: Sequence[Column], label: Column) -> DataFrame:
    """(series_id, task, gram): per series the sums of the products of 1, the inputs and the label with each other.

    Every task adds up its own rows with one matrix product a batch; parts of a series meet in GRAM_PARTS groups, so that
    a series on all tasks is no group of as many rows. Its size depends on the number of inputs alone. Inputs
    and label must not be NULL; rows without a series are left out.
    """
    framed = rows.filter(F.col("series_id").isNotNull()).select("series_id", F.array(*inputs, label).alias("x"))
    parts = framed.mapInArrow(_gram_parts, "series_id string, task int, gram array<double>")
    dealt = parts.withColumn("part", F.col("task") % GRAM_PARTS)
    return dealt.groupBy("series_id", "part").applyInArrow(_merge_parts, "series_id string, task int, gram array<double>")


def seasonal_curves(train: DataFrame, regressors: Sequence[str] = ("temperature",), ridge: float = 0.01) -> DataFrame:
    """For each series the ridge regression of log(1 + value) on trend, seasons and regressors; weights of standardised
    inputs are what `ridge` shrinks. The driver sees no rows, sums or curves."""
    sums = gram_sums(train, _inputs(regressors), F.log1p("value"))
    return sums.groupBy("series_id").applyInArrow(
        _solved(ridge), "series_id string, n long, intercept double, weights array<double>")


def seasonal_predict(curves: DataFrame, df: DataFrame, regressors: Sequence[str] = ("temperature",)) -> DataFrame:
    """`df` with `prediction`, in the unit of the value: the model is additive in its logarithm. NULL for a series without
    a curve and where a regressor is unknown."""
    terms = F.zip_with(F.array(*_inputs(regressors)), "weights", lambda x, w: x * w)
    total = F.col("intercept") + F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    joined = df.join(curves.select("series_id", "intercept", "weights"), "series_id", "left")
    return joined.withColumn("prediction", F.expm1(total)).drop("intercept", "weights")


def train_seasonal(
    features: DataFrame,
    horizon: int,
    test_days: int = TEST_DAYS,
    min_rows: int = 200,
    regressors: Sequence[str] = ("temperature",),
    ridge: float = 0.01,
) -> Seasonal:
    """A curve per series: trend, yearly, weekly and daily seasons and regressors, multiplied. Scored per series on its
    test days against the value `horizon` hours earlier. Series with fewer than `min_rows` training rows get no curve;
    if no series has one, that is an error."""
    usable = features.na.drop(subset=["value", *regressors]).filter(F.col("value") > -1)
    usable = usable.select("series_id", "timestamp", "value", f"lag_{horizon}h", *regressors)
    rows = written(holdout_split(usable, 0, test_days), "seasonal")
    train, test = (rows.filter(F.col("split") == s) for s in ("train", "test"))
    bounds = train.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_train"), F.min("timestamp").alias("training_data_start"), F.max("timestamp").alias("training_data_end"))
    curves = written(seasonal_curves(train, regressors, ridge).filter(F.col("n") >= min_rows), "curves")
    if curves.isEmpty():
        most = bounds.agg(F.coalesce(F.max("n_train"), F.lit(0))).first()[0]
        raise ValueError(f"insufficient training data: need {min_rows} rows, got {most}")
    predicted = seasonal_predict(curves, test, regressors)
    fitted = regression_metrics(predicted, "value", "prediction", ["series_id"]).withColumnRenamed("n", "n_test")
    naive = naive_metrics(test, "value", f"lag_{horizon}h", ["series_id"]).drop("naive_n")
    known = curves.select("series_id").join(bounds, "series_id")
    scores = known.join(fitted, "series_id", "left").join(naive, "series_id", "left")
    return Seasonal(curves, scores, tuple(regressors))


# --- tuning ---------------------------------------------------------------------------------------

def draw(space: Mapping[str, object], random: Random) -> dict[str, object]:
    """One set of parameters from the search space."""
    chosen: dict[str, object] = {}
    for name, rule in space.items():
        if isinstance(rule, list):
            chosen[name] = random.choice(rule)
            continue
        low, high, scale = rule
        if scale == "int":
            chosen[name] = random.randint(low, high)
        elif scale == "log":
            chosen[name] = math.exp(random.uniform(math.log(low), math.log(high)))
        elif scale == "share":
            chosen[name] = f"{random.uniform(low, high):.4f}"
        else:
            chosen[name] = random.uniform(low, high)
    return chosen


def cross_validated_mae(
    folds: DataFrame, params: Mapping[str, object], columns: Sequence[str], n_folds: int, patience: int
) -> float:
    """Mean over the folds of the MAE on each fold's test rows."""
    return _searched(folds, [params], columns, n_folds, patience, 1)[0]


def _searched(
    folds: DataFrame, settings: Sequence[Mapping[str, object]], columns: Sequence[str], n_folds: int, patience: int, parallel: int
) -> list[float]:
    """The cross-validated MAE of each setting. Fits of different folds and settings run side by side: their small jobs
    fill the cluster together."""
    tasks = max(1, folds.count() // (n_folds * ROWS_PER_TASK))

    def score(job: tuple[int, int]) -> DataFrame:
        at, i = job
        fold = folds.filter(F.col("fold") == i)
        train, test = fold.filter("role = 'train'").coalesce(tasks), fold.filter("role = 'test'")
        model, _ = fit_early_stopped(train, test, settings[at], columns, patience)
        return model.transform(test).select(F.lit(at).alias("trial"), "fold", LABEL, "prediction")

    jobs = [(at, i) for at in range(len(settings)) for i in range(n_folds)]
    run = inheritable_thread_target(folds.sparkSession)(score)
    with ThreadPool(min(parallel, len(jobs))) as pool:
        together = reduce(DataFrame.unionByName, pool.map(run, jobs))
    found = {r["trial"]: r["cv_mae"] for r in cv_mae(together, actual=LABEL, predicted="prediction", by=["trial"]).collect()}
    return [found.get(at, math.inf) for at in range(len(settings))]


def tune(
    frame: DataFrame,
    horizon: int,
    trials: int = TUNING_TRIALS,
    seed: int = 42,
    space: Mapping[str, object] = SEARCH_SPACE,
    columns: Sequence[str] = MODEL_FEATURES,
    n_folds: int = CV_FOLDS,
    gap: int = CV_GAP,
    test: int = CV_TEST,
    rounds: int = TUNING_ROUNDS,
    patience: int = TUNING_PATIENCE,
    keep: int = 3,
    parallel: int = 4,
) -> dict[str, object]:
    """Seeded random search for the lowest cross-validated MAE by successive halving; no trials, no overrides.

    All trials are drawn first. They start with a fraction of the rounds; the best one in `keep` goes on with
    `keep` times as many, until the last few have had all `rounds`. No clock decides, so the same seed gives the same
    parameters on any machine; ties go to the earlier trial. `frame` comes from `model_frame`; the folds are
    written once and read by all.
    """
    if trials <= 0:
        return {}
    _checkpointing(frame.sparkSession)
    folds = written(ts_folds(frame, n_folds, gap, test), "folds")
    random = Random(seed)
    left = [draw(space, random) for _ in range(trials)]
    rungs = max(0, math.ceil(math.log(len(left), keep) - 1e-9) - 1) if len(left) > 1 else 0
    while True:
        now = max(1, rounds // keep**rungs)
        settings = [{**DEFAULT_PARAMS, **drawn, "maxIter": now, "seed": seed + horizon} for drawn in left]
        maes = _searched(folds, settings, columns, n_folds, patience, parallel)
        order = sorted(range(len(left)), key=lambda i: (maes[i], i))
        if rungs == 0:
            return left[order[0]]
        left = [left[i] for i in sorted(order[: max(1, -(-len(left) // keep))])]
        rungs -= 1


# --- attribution ----------------------------------------------------------------------------------

def gain_importance(trained: Trained, spark: SparkSession) -> DataFrame:
    """The share of split gain of each feature, from the trees."""
    gains = trained.model.stages[-1].featureImportances.toArray()
    rows = [(name, float(g)) for name, g in zip(trained.features, gains)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc())


def permutation_importance(trained: Trained, test: DataFrame, seed: int = 42, rows_per_slice: int = 4096) -> DataFrame:
    """How much the MAE grows when one feature's values are exchanged between the test rows, all of them.

    Rows are dealt into slices by a seeded hash; in its slice each row takes the feature of the next one, the last that of the
    first, so no row keeps its own. All features are scored in one pass over a row per feature; the lengths of the slices
    are bounded whatever the number of rows.
    """
    names = trained.features
    order = F.xxhash64("series_id", "timestamp", F.lit(seed))
    slices = max(1, test.count() // rows_per_slice)
    dealt = test.select("series_id", "timestamp", LABEL, *names).withColumns({"__order": order, "__slice": F.pmod(F.xxhash64(order), F.lit(slices))})
    ring = Window.partitionBy("__slice").orderBy("__order", "series_id", "timestamp")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    given = F.struct(*names)
    last = F.row_number().over(ring) == F.count(F.lit(1)).over(whole)  # its next row is the first one, whatever NULLs it holds
    moved = dealt.withColumn("__next", F.when(last, F.first(given).over(whole)).otherwise(F.lead(given).over(ring)))
    copies = moved.withColumn("feature", F.explode(F.array(F.lit(""), *[F.lit(c) for c in names])))
    swapped = copies.withColumns({c: F.when(F.col("feature") == c, F.col("__next")[c]).otherwise(F.col(c)) for c in names})
    scored = regression_metrics(trained.model.transform(swapped), LABEL, "prediction", ["feature"])
    base = scored.filter("feature = ''").select(F.col("mae").alias("__base"))
    return (
        scored.filter("feature <> ''").crossJoin(base)  # one row
        .select("feature", "mae", (F.col("mae") - F.col("__base")).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )
