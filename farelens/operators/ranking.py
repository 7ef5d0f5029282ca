"""Ranks and extremes of small result tables, and top-k of large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_models(metrics: DataFrame, by: str = "rmse") -> DataFrame:
    """Minimum rank by an error metric (one row per model), best first."""
    return (
        metrics.withColumn("model_rank", F.rank().over(Window.orderBy(by)))
        .orderBy("model_rank", "model"))


def best_and_worst(metrics: DataFrame, by: str = "rmse") -> DataFrame:
    """Ties go to the first model by name."""
    best = F.min(F.struct(by, "model"))
    worst = F.min(F.struct((-F.col(by)).alias(by), "model"))
    return metrics.agg(best.alias("b"), worst.alias("w")).select(
        F.col("b.model").alias("best_model"), F.col(f"b.{by}").alias("best_value"),
        F.col("w.model").alias("worst_model"), (-F.col(f"w.{by}")).alias("worst_value"))


def top_k(df: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The k largest; ties go to the smaller ``tie``."""
    return df.orderBy(F.desc(by), tie).limit(k)
