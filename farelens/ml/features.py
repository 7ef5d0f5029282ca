"""Feature sets and the encode-assemble-scale pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.operators.quantiles import with_row_numbers
from farelens.session import narrow_caches

#: Whole batches on the heap, streamed to and from disk: a serialized block is read back as one
#: array of its size, in a direct buffer of that size for each thread.
CACHE_LEVEL = StorageLevel.MEMORY_AND_DISK_DESER


@dataclass(frozen=True)
class FeatureSet:
    """Inputs of one model family. ``indexed`` columns become numbers by frequency
    rank, ``one_hot`` columns become slots."""

    numeric: tuple[str, ...]
    one_hot: tuple[str, ...] = ()
    indexed: tuple[str, ...] = ()
    scaled: bool = True

    @property
    def columns(self) -> tuple[str, ...]:
        return self.numeric + self.one_hot + self.indexed


# fixed values: the named feature sets of the fare models
TRIP_ONLY = FeatureSet(
    numeric=("passenger_count", "trip_distance", "PULocationID", "DOLocationID",
             "trip_duration", "pickup_hour", "pickup_day", "pickup_month"),
    one_hot=("VendorID", "store_and_fwd_flag"))
CALENDAR_ONLY = FeatureSet(
    numeric=("passenger_count", "trip_distance", "pickup_hour", "pickup_weekday",
             "pickup_month"), scaled=False)
WITH_CHARGES = FeatureSet(
    numeric=("passenger_count", "trip_distance", "extra", "tip_amount", "tolls_amount",
             "trip_duration", "pickup_hour", "pickup_day", "pickup_month"),
    indexed=("payment_type", "PULocationID", "DOLocationID"), scaled=False)
FARE_CLASS = FeatureSet(
    numeric=("trip_distance", "trip_duration_sec", "passenger_count", "tip_amount",
             "tolls_amount", "extra", "pickup_hour", "pickup_weekday", "pickup_month",
             "is_weekend", "is_rush_hour", "avg_speed_mph", "PULocationID", "DOLocationID",
             "RatecodeID", "VendorID", "payment_type"),
    one_hot=("store_and_fwd_flag",))


def index_columns(columns: Sequence[str]) -> list[StringIndexer]:
    """Category to rank by frequency, all columns in one pass; unseen and missing values
    share an extra index."""
    if not columns:
        return []
    return [StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns],
                          handleInvalid="keep")]


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """(column, column_idx): every category's place by falling frequency, then by name.

    As a string indexer's labels, but a table: a key with as many categories as the data
    has is never gathered on the driver.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    placed = with_row_numbers(counts, [F.desc("_n"), F.col(column).cast("string")], "_place")
    return placed.select(column, F.col("_place").cast("double").alias(f"{column}_idx"))


def feature_pipeline(features: FeatureSet, handle_invalid: str = "skip") -> Pipeline:
    """Stages ending in a ``features`` vector.

    ``skip`` leaves out rows with a missing input; ``missing_inputs`` counts them.
    """
    coded = [*features.one_hot, *features.indexed]
    stages: list = index_columns(coded)
    if features.one_hot:
        stages.append(OneHotEncoder(
            inputCols=[f"{c}_idx" for c in features.one_hot],
            outputCols=[f"{c}_vec" for c in features.one_hot]))
    inputs = [*features.numeric, *[f"{c}_vec" for c in features.one_hot],
              *[f"{c}_idx" for c in features.indexed]]
    assembled = "assembled" if features.scaled else "features"
    stages.append(VectorAssembler(
        inputCols=inputs, outputCol=assembled, handleInvalid=handle_invalid))
    if features.scaled:
        stages.append(StandardScaler(
            inputCol=assembled, outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=stages)


def missing_inputs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows the assembler's ``skip`` keeps and leaves out."""
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return df.agg(F.count_if(complete).alias("kept_rows"), F.count_if(~complete).alias("dropped_rows"))


def slot_names(transformed: DataFrame, vector: str = "features") -> list[str]:
    """A name for each slot of a feature vector, one-hot slots by category.

    The assembler records them as column metadata. A scaler keeps only the
    width, so the names are read from its input in that case.
    """
    attributes = transformed.schema[vector].metadata.get("ml_attr", {})
    if "attrs" not in attributes and "assembled" in transformed.columns:
        attributes = transformed.schema["assembled"].metadata["ml_attr"]
    named = [slot for kind in attributes["attrs"].values() for slot in kind]
    return [slot["name"] for slot in sorted(named, key=lambda slot: slot["idx"])]


def fit_features(train: DataFrame, features: FeatureSet) -> PipelineModel:
    """Fit encoders and scaler on the training rows only."""
    return feature_pipeline(features).fit(train)


def fit_encoded(train: DataFrame, features: FeatureSet, kept: Sequence[str]
                ) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """As ``fit_features``, for training rows that are needed encoded too.

    Returns the fitted pipeline, the rows' ``features`` with the ``kept`` columns, and the
    rows to persist and release with them. Those are encoded once: the scaler's fit and
    what reads ``features`` take them from there and only scale.
    """
    stages = feature_pipeline(features).getStages()
    encoders = Pipeline(stages=stages[:-1] if features.scaled else stages).fit(train)
    narrow_caches(train.sparkSession)
    vector = "assembled" if features.scaled else "features"
    encoded = encoders.transform(train).select(vector, *kept).persist(CACHE_LEVEL)
    if not features.scaled:
        return encoders, encoded, encoded
    scaler = stages[-1].fit(encoded)
    scaled = scaler.transform(encoded).select("features", *kept)
    return PipelineModel([*encoders.stages, scaler]), scaled, encoded
