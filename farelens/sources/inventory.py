"""Which files hold the data, and how large they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Path and length of every file below the paths. Only the listing is read:
    the content column is pruned away."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .load(list(paths)).select("path", "length"))


def file_inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """Size per file, its share, and the total."""
    files = list_files(spark, *paths)
    total = files.agg(F.sum("length")).scalar()
    megabytes = F.round(F.col("length") / F.lit(1024.0 * 1024.0), 4)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"), megabytes.alias("size_mb"),
        total.alias("total_bytes")).orderBy("file_name")


def input_bytes(spark: SparkSession, *paths: str) -> int:
    return list_files(spark, *paths).agg(F.sum("length")).first()[0] or 0
