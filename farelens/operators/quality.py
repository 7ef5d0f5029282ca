"""What is missing, repeated or impossible in a frame; each answer in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_nan(df: DataFrame, name: str) -> Column:
    """NaN exists in floating-point columns only."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.isnan(name)
    return F.lit(False)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def null_nan_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.agg(*[
        F.count_if(F.col(c).isNull() | _is_nan(df, c)).alias(c) for c in columns or df.columns])


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with gaps, worst first: Column, Missing Count, Missing %."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counted.unpivot("_rows", columns, "Column", "Missing Count")
        .where(F.col("Missing Count") > 0)
        .select("Column", "Missing Count",
                F.round(100.0 * F.col("Missing Count") / F.col("_rows"), 2).alias("Missing %"))
        .orderBy(F.desc("Missing %"), "Column"))


def schema_summary(df: DataFrame) -> DataFrame:
    """One row per column: position, type, and how many values it holds."""
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[
        F.lit(part) for field in df.schema for part in (field.name, field.dataType.simpleString())])
    places = F.array(*[F.lit(c) for c in df.columns])
    return filled.unpivot([], df.columns, "column_name", "filled_rows").select(
        F.array_position(places, F.col("column_name")).cast("int").alias("position"),
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        "filled_rows")


def row_col_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).alias("column_count"))


def _copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies"))


def duplicate_surplus(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each group of equal rows: {a, a, a, b} has 2."""
    return _copies(df, keys or df.columns).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def duplicate_members(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """All rows that share their values with another row: {a, a, a, b} has 3."""
    return _copies(df, keys or df.columns).where(F.col("copies") > 1).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_rows"))


def invalid_count(df: DataFrame, columns: Sequence[str] = ("trip_distance", "fare_amount")
                  ) -> DataFrame:
    """Rows where any of the columns is zero or negative."""
    wrong = reduce(lambda a, b: a | b, [F.col(c) <= 0 for c in columns])
    return df.agg(F.count("*").alias("row_count"), F.count_if(wrong).alias("invalid_rows"))


def dataset_overview(df: DataFrame, invalid: Sequence[str] = ("trip_distance", "fare_amount")
                     ) -> DataFrame:
    """Metric, Value: rows, columns, missing values, duplicates and invalid rows.

    Equal rows are merged first (partly before the shuffle), so the duplicate
    count and the sums come from the same pass.
    """
    names = df.columns
    wrong = reduce(lambda a, b: a | b, [F.col(c) <= 0 for c in invalid])
    gaps = reduce(add, [F.col(c).isNull().cast("int") for c in names])
    counted = _copies(df, names).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("Total Records"),
        F.lit(len(names)).cast("bigint").alias("Total Columns"),
        F.coalesce(F.sum(gaps * F.col("copies")), F.lit(0)).alias("Missing Values"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("Duplicate Rows"),
        F.coalesce(F.sum(F.when(wrong, F.col("copies"))), F.lit(0)).alias("Invalid Records"))
    return counted.unpivot([], counted.columns, "Metric", "Value")


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min and max, one row per column."""
    row = df.agg(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("value_count"),
            F.round(F.mean(c), 6).alias("mean_value"),
            F.round(F.stddev(c), 6).alias("stddev_value"),
            F.min(c).cast("double").alias("min_value"),
            F.max(c).cast("double").alias("max_value")).alias(c)
        for c in columns])
    return row.select(F.inline(F.array(*columns)))
