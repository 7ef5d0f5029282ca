"""Measured execution: partitions, timings, cached against uncached."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rows_per_partition(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("row_count"))


def partition_profile(df: DataFrame, widths: Sequence[int]) -> DataFrame:
    """Rows per partition after an even redistribution to each width."""
    return reduce(DataFrame.unionByName, [
        rows_per_partition(df.repartition(width)).select(
            F.lit(width).alias("partitions"), "partition_id", "row_count")
        for width in widths])


def seconds(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run(df: DataFrame) -> None:
    """Execute the whole plan without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def execution_performance(spark: SparkSession, source: DataFrame,
                          steps: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Operation, Time (s), Category: each step on the plain and on the cached source."""
    rows = [("load", seconds(lambda: run(source)), "Uncached")]
    rows += [(name, seconds(lambda: run(step(source))), "Uncached") for name, step in steps.items()]
    kept = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows.append(("load", seconds(lambda: run(kept)), "Caching"))
        rows += [(name, seconds(lambda: run(step(kept))), "Cached") for name, step in steps.items()]
    finally:
        kept.unpersist()
    return spark.createDataFrame(
        [(name, round(spent, 3), category) for name, spent, category in rows],
        "Operation STRING, `Time (s)` DOUBLE, Category STRING")
