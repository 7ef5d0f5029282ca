"""Estimators with their published settings, grid search and fitted-model files."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor)
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from farelens.functions.fares import fare_class
from farelens.functions.keys import fold_of
from farelens.ml import evaluate
from farelens.ml.features import CACHE_LEVEL, FeatureSet, fit_encoded, missing_inputs
from farelens.operators.quantiles import median
from farelens.operators.sampling import train_test_split
from farelens.session import narrow_scans, scratch_dir, stored, use_checkpoints

SEED = 42
TRAINING_PARTITION_BYTES = 8 * 1024 * 1024
#: Tasks of an ensemble's trainer for each core at most, while none takes over ``MERGED`` partitions.
ENSEMBLE_TASKS = 4
MERGED = 4
REGRESSORS = {
    "linear_regression": LinearRegression,
    "decision_tree": DecisionTreeRegressor,
    "random_forest": RandomForestRegressor,
    "gbt": GBTRegressor,
}
CLASSIFIERS = {
    "logistic_regression": LogisticRegression,
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    "gbt": GBTClassifier,
}

# fixed values: settings of the single fits and of the three published grids
REGRESSOR_SETTINGS = {
    "linear_regression": {},
    "decision_tree": {"maxDepth": 10, "seed": SEED},
    "random_forest": {"numTrees": 100, "maxDepth": 12, "seed": SEED},
    "gbt": {"maxIter": 50, "maxDepth": 6, "seed": SEED},
}
CLASSIFIER_SETTINGS = {
    "logistic_regression": {"regParam": 0.01, "elasticNetParam": 0.5, "maxIter": 20},
    "decision_tree": {"maxDepth": 10, "maxBins": 32, "seed": SEED},
    "random_forest": {"numTrees": 50, "maxDepth": 8, "seed": SEED},
    "gbt": {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": SEED},
}
GRIDS = {
    "quick": {
        "linear_regression": {"regParam": [0.0, 0.01], "elasticNetParam": [0.0, 0.5]},
        "decision_tree": {"maxDepth": [5, 10]},
        "random_forest": {"numTrees": [10, 20], "maxDepth": [5, 10]},
        "gbt": {"maxIter": [10, 20], "maxDepth": [5, 7]},
    },
    "notebook": {
        "linear_regression": {"regParam": [0.0, 0.01], "elasticNetParam": [0.0, 0.5, 1.0]},
        "decision_tree": {"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 5]},
        "random_forest": {"numTrees": [20, 50], "maxDepth": [10, 15]},
        "gbt": {"maxIter": [20, 50], "maxDepth": [5, 10]},
    },
    "full": {
        "linear_regression": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
        "decision_tree": {"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 5]},
        "random_forest": {"numTrees": [20, 50], "maxDepth": [10, 20]},
        "gbt": {"maxIter": [20, 50], "maxDepth": [5, 10]},
    },
}


def regressor(name: str, **settings) -> Estimator:
    return REGRESSORS[name](featuresCol="features", labelCol="label",
                            **(settings or REGRESSOR_SETTINGS[name]))


def classifier(name: str, **settings) -> Estimator:
    return CLASSIFIERS[name](featuresCol="features", labelCol="label",
                             **(settings or CLASSIFIER_SETTINGS[name]))


def param_grid(estimator: Estimator, values: dict[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


@dataclass
class Prepared:
    """Encoded train rows (features, label, row_key, fold) and test rows (features, label),
    with the fitted encoders and the rows before encoding."""

    train: DataFrame
    test: DataFrame
    pipeline: PipelineModel
    raw_train: DataFrame
    raw_test: DataFrame
    given: DataFrame
    needed: Sequence[str]
    encoded: DataFrame

    def row_counts(self) -> DataFrame:
        """How many given rows had every input, and how many were left out for a missing one."""
        return missing_inputs(self.given, self.needed)

    def cached(self) -> "Prepared":
        """Trainers pass over the training rows many times."""
        if not self.encoded.is_cached:
            self.encoded.persist(CACHE_LEVEL)
        return self

    def release(self) -> None:
        self.encoded.unpersist()

    @property
    def bins(self) -> int:
        """Tree bins needed for the widest indexed column: one per category, unseen included."""
        indexers = [stage for stage in self.pipeline.stages if isinstance(stage, StringIndexerModel)]
        return max([len(labels) + 1 for stage in indexers for labels in stage.labelsArray], default=0)


def with_bins(estimator: Estimator, bins: int) -> Estimator:
    """Trees reject a category column with more values than bins."""
    if estimator.hasParam("maxBins") and estimator.getOrDefault("maxBins") < bins:
        return estimator.copy({estimator.getParam("maxBins"): bins})
    return estimator


def training_partitions(df: DataFrame, input_bytes: int | None = None) -> int:
    """At least one partition per core, and none much above 8 MB of input: a row's inputs
    are ten times as large in a shuffle as in the files, and larger when encoded."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores, math.ceil((input_bytes or 0) / TRAINING_PARTITION_BYTES))


def for_fit(estimator: Estimator, train: DataFrame) -> DataFrame:
    """The rows in as few tasks as an ensemble should have: its trainer starts hundreds of
    small jobs, and every task sends statistics of all open nodes of all trees. No task takes
    more than four partitions, since it keeps its rows as one block."""
    if not (estimator.hasParam("numTrees") or estimator.hasParam("maxIter") and estimator.hasParam("maxBins")):
        return train
    cores = train.sparkSession.sparkContext.defaultParallelism
    return train.coalesce(max(ENSEMBLE_TASKS * cores, math.ceil(train.rdd.getNumPartitions() / MERGED)))


def fits_at_once(rows: DataFrame, most: int) -> int:
    """How many models to fit on the rows side by side. Each keeps a copy of its own in memory,
    and one whose tasks fill the cores gains nothing from others beside it."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(most, ENSEMBLE_TASKS * cores // max(rows.rdd.getNumPartitions(), 1)))


def prepare(df: DataFrame, features: FeatureSet, label: str | Column, key: str | Column,
            folds: int = 3, partitions: int | None = None,
            relabel: Callable[[DataFrame], Column] | None = None) -> Prepared:
    """Derive once, split by key hash, fit the encoders on the training part and
    encode both parts.

    The derived inputs are written to the shared scratch folder, spread evenly
    over ``partitions`` files: every encoder, every fit and both parts read them
    again, and neither the joins behind them nor their long expressions are
    planned and run each time. ``relabel`` turns the label into another one that
    depends on the training rows, such as a class by their median. The encoded training
    rows stay persisted until ``release``.
    """
    target = F.col(label) if isinstance(label, str) else label
    row_key = F.col(key) if isinstance(key, str) else key
    inputs = df.dropna(subset=list(features.columns)).select(
        *features.columns, target.cast("double").alias("label"), row_key.alias("row_key"))
    if partitions:
        inputs = inputs.repartition(partitions)
    narrow_scans(df.sparkSession)
    rows = stored(inputs, "model-inputs").where(F.col("label").isNotNull())
    raw_train, raw_test = train_test_split(rows, "row_key")
    if relabel:
        final = relabel(raw_train).cast("double")
        raw_train, raw_test = (part.withColumn("label", final) for part in (raw_train, raw_test))
    pipeline, train, encoded = fit_encoded(raw_train, features, ["label", "row_key"])
    train = train.withColumn("fold", fold_of("row_key", folds))
    test = pipeline.transform(raw_test).select("features", "label")
    return Prepared(train, test, pipeline, raw_train, raw_test, df, features.columns, encoded)


def above_median(raw_train: DataFrame) -> Column:
    """Fare class by the training rows' own median fare."""
    return fare_class(median(raw_train, "label").first()[0], "label")


def without_summary(model: Model, spark: SparkSession) -> Model:
    """The model as saved and loaded, if it carries a training summary.

    A classifier's summary holds the session, and scoring sends the model to the
    executors with it. Once anything in the session was observed, that session can no
    longer be sent.
    """
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_dir(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def timed_fit(estimator: Estimator, train: DataFrame) -> tuple[Model, float]:
    use_checkpoints(train.sparkSession)
    start = time.perf_counter()
    model = estimator.fit(for_fit(estimator, train))
    seconds = time.perf_counter() - start
    return without_summary(model, train.sparkSession), seconds


@dataclass
class SearchResult:
    best_model: Model
    best_params: dict[str, object]
    scores: list[tuple[dict[str, object], float]]
    seconds: float


def longest_fits(estimator: Estimator, grid: list[dict]) -> dict[int, list[int]]:
    """The places of the grid points to fit, each with the places that its model answers.

    A boosted model of n rounds is the first n rounds of a longer one with the same other
    settings, so of points that differ in ``maxIter`` only, the longest is fitted.
    """
    if not isinstance(estimator, GBTRegressor):
        return {place: [place] for place in range(len(grid))}
    alike: dict[frozenset, list[int]] = {}
    for place, point in enumerate(grid):
        others = frozenset((param.name, value) for param, value in point.items() if param.name != "maxIter")
        alike.setdefault(others, []).append(place)
    return {max(places, key=lambda place: rounds(estimator, grid[place])): places for places in alike.values()}


def rounds(estimator: Estimator, point: dict) -> int:
    return point.get(estimator.maxIter, estimator.getOrDefault("maxIter"))


def fold_errors(estimator: Estimator, grid: list[dict], models: dict[int, Model],
                answers: dict[int, list[int]], held_out: DataFrame) -> dict[int, float]:
    """Mean squared error of every grid point on the held-out rows: a pass for each boosted
    model, which gives the error after each of its rounds, or one for all other models."""
    if isinstance(estimator, GBTRegressor):
        after = {place: model.evaluateEachIteration(held_out, "squared") for place, model in models.items()}
        return {place: after[longest][rounds(estimator, grid[place]) - 1]
                for longest, places in answers.items() for place in places}
    scored = held_out
    for place, model in models.items():
        scored = model.copy().setPredictionCol(f"p{place}").transform(scored)
    squared = scored.agg(*[
        F.avg((F.col("label") - F.col(f"p{place}")) ** 2).alias(f"p{place}") for place in models]).first()
    return {place: squared[f"p{place}"] for place in models}


def cross_validate(train: DataFrame, estimator: Estimator, grid: list[dict], folds: int = 3,
                   parallelism: int = 4) -> SearchResult:
    """k-fold search by RMSE over a ``fold`` column, refitting the winner on all rows.

    Spark's CrossValidator checks a fold column with a Python function per row;
    here a fold is a plain filter on the cached rows, one pass over the held-out fold
    scores every grid point, and a boosted model is fitted once for all its ``maxIter``.
    """
    use_checkpoints(train.sparkSession)
    start = time.perf_counter()
    errors = [0.0] * len(grid)
    answers = longest_fits(estimator, grid)
    fitted = list(answers)
    with ThreadPool(fits_at_once(for_fit(estimator, train), min(parallelism, len(fitted)))) as pool:
        for fold in range(folds):
            fits = estimator.fitMultiple(
                for_fit(estimator, train.where(F.col("fold") != fold)), [grid[place] for place in fitted])
            fit_next = inheritable_thread_target(train.sparkSession)(lambda _: next(fits))
            models = {fitted[i]: model for i, model in pool.imap_unordered(fit_next, range(len(fitted)))}
            squared = fold_errors(estimator, grid, models, answers, train.where(F.col("fold") == fold))
            for place, error in squared.items():
                errors[place] += math.sqrt(error) / folds
    best = min(range(len(grid)), key=errors.__getitem__)
    best_model = estimator.fit(for_fit(estimator, train), grid[best])
    named = [{param.name: value for param, value in point.items()} for point in grid]
    return SearchResult(best_model, named[best], list(zip(named, errors)),
                        time.perf_counter() - start)


def with_score(predictions: DataFrame) -> DataFrame:
    """Probability of class 1 as a plain ``score`` column."""
    return predictions.withColumn("score", vector_to_array("probability")[1])


def class_report(model: Model, test: DataFrame, name: str, seconds: float) -> DataFrame:
    """One row of classification metrics for a fitted model.

    The test rows are scored once; label, prediction and score are written, and
    all metrics read those three columns.
    """
    scored = stored(with_score(model.transform(test)).select(
        F.lit(name).alias("model"), "label", "prediction", "score"), "scores")
    rates = evaluate.classification_metrics(
        evaluate.confusion_binary(scored, by=["model"]), by=["model"])
    areas = evaluate.curve_areas(scored, by=["model"])
    return rates.join(areas, "model").withColumn("train_seconds", F.lit(round(seconds, 3)))


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)
