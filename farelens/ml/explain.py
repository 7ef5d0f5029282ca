"""Which feature counts: coefficients and importances by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from farelens.operators.ranking import top_k


def feature_weights(spark: SparkSession, names: Sequence[str], weights: Sequence[float],
                    column: str) -> DataFrame:
    """Pair slot names with a fitted model's weights; one row per feature slot."""
    if len(names) != len(weights):
        raise ValueError(f"{len(names)} names for {len(weights)} weights")
    rows = [(slot, name, float(weight)) for slot, (name, weight) in enumerate(zip(names, weights))]
    return spark.createDataFrame(rows, f"slot INT, feature STRING, {column} DOUBLE")


def importances(spark: SparkSession, names: Sequence[str], tree_model) -> DataFrame:
    return feature_weights(spark, names, tree_model.featureImportances.toArray(), "importance")


def coefficients(spark: SparkSession, names: Sequence[str], linear_model) -> DataFrame:
    return feature_weights(spark, names, linear_model.coefficients.toArray(), "coefficient")


def top_features(weights: DataFrame, k: int = 15) -> DataFrame:
    return top_k(weights.select("feature", "importance"), "importance", "feature", k)
