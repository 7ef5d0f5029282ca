"""Samples, splits and folds.

By default membership depends on a row's key only: the same rows come out for
any file layout, any number of partitions and after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions.keys import HASH_RANGE, fold_of, unit_hash, whole_hash


def hash_sample(df: DataFrame, key: str | Column, fraction: float) -> DataFrame:
    """About ``fraction`` of the rows; a smaller fraction is a subset of a larger one."""
    return df.where(unit_hash(key) < fraction)


def bottom_k(df: DataFrame, key: str | Column, k: int, ranges: int = 4_096, most: int = 100_000
             ) -> DataFrame:
    """Exactly ``k`` rows (all, if there are fewer): those whose keys have the smallest hashes,
    ties by the columns in their order. Rows without key come last.

    Nothing is sorted as a whole. Rows are counted by range of the hash, at most
    ``ranges`` numbers; every range before the one that holds the k-th row is taken as it
    is. That one is cut into ranges again until it holds at most ``most`` rows or one hash
    only, and there the smallest rows fill up what is missing.
    """
    hashed = df.withColumn("_hash", F.coalesce(whole_hash(key).cast("bigint"), F.lit(HASH_RANGE)))
    low, high, missing = 0, HASH_RANGE + 1, k
    while True:
        width = -(-(high - low) // ranges)
        inside = hashed.where((F.col("_hash") >= low) & (F.col("_hash") < high))
        counts = sorted((r[0], r[1]) for r in inside.groupBy(
            F.floor((F.col("_hash") - low) / width).cast("bigint")).count().collect())
        border = None
        for place, count in counts:
            if count > missing:
                border = place, count
                break
            missing -= count
        if border is None:
            return hashed.where(F.col("_hash") < high).drop("_hash")
        low, high = low + border[0] * width, min(high, low + (border[0] + 1) * width)
        if border[1] <= most or high - low <= 1:
            break
    whole = hashed.where(F.col("_hash") < low)
    if missing:
        last = hashed.where((F.col("_hash") >= low) & (F.col("_hash") < high))
        whole = whole.unionByName(last.orderBy("_hash", *df.columns).limit(missing))
    return whole.drop("_hash")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's own sample; the rows depend on the partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def with_split(df: DataFrame, key: str | Column, train: float = 0.8) -> DataFrame:
    return df.withColumn("split", F.when(unit_hash(key) < train, "train").otherwise("test"))


def train_test_split(df: DataFrame, key: str | Column, train: float = 0.8
                     ) -> tuple[DataFrame, DataFrame]:
    inside = unit_hash(key) < train
    return df.where(inside), df.where(~inside)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
                 ) -> list[DataFrame]:
    """Spark's own split; the rows depend on the partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def with_fold(df: DataFrame, key: str | Column, folds: int) -> DataFrame:
    return df.withColumn("fold", fold_of(key, folds))
