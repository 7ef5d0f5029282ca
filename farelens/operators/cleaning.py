"""Row filters, de-duplication and the counted cleaning funnel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from farelens.functions.calendar import duration_seconds

RAW_STEP = "Raw Ingestion"


def cleaning_rules() -> dict[str, Column]:
    """The plausibility rules in report order: step name -> rows to keep."""
    # fixed values: step names and limits of the cleaning report
    fare, distance = F.col("fare_amount"), F.col("trip_distance")
    return {
        "Remove invalid fares (<=0 or >=200)": (fare > 0) & (fare < 200),
        "Remove invalid distance (<=0 or >=100)": (distance > 0) & (distance < 100),
        "Remove invalid passenger count": F.col("passenger_count").between(1, 6),
        "Remove invalid duration (<30s or >2h)": duration_seconds().between(30, 7200),
    }


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def keep_positive(df: DataFrame, columns: Sequence[str] = ("trip_distance", "fare_amount")
                  ) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c) > 0 for c in columns]))


def keep_open_range(df: DataFrame, column: str = "fare_amount", low: float = 0, high: float = 500
                    ) -> DataFrame:
    """Strictly between both limits."""
    return df.where((F.col(column) > low) & (F.col(column) < high))


def keep_between(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Inside the closed range of every named column (a bounding box)."""
    return df.where(reduce(lambda a, b: a & b, [
        F.col(name).between(low, high) for name, (low, high) in bounds.items()]))


def keep_duration(df: DataFrame, shortest: float = 30, longest: float = 7200) -> DataFrame:
    return df.where(duration_seconds().between(shortest, longest))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the remaining columns, in their order, nulls first.

    A minimum is combined before the shuffle, so a key with many copies never
    gathers in one task as it would under ``row_number``.
    """
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def rule_report(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Each rule on its own: how many rows pass and fail. A null operand fails."""
    rules = rules or cleaning_rules()
    passed = df.agg(F.count("*").alias("_rows"), *[
        F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return passed.unpivot("_rows", list(rules), "rule", "kept").select(
        "rule", "kept", (F.col("_rows") - F.col("kept")).alias("failed"))


def cleaning_funnel(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Step, Records, Removed for the rules applied one after the other."""
    rules = rules or cleaning_rules()
    kept_so_far, counts = F.lit(True), [F.count("*").alias("0")]
    for place, rule in enumerate(rules.values(), start=1):
        kept_so_far = kept_so_far & F.coalesce(rule, F.lit(False))
        counts.append(F.count_if(kept_so_far).alias(str(place)))
    steps = [
        F.struct(
            F.lit(name).alias("Step"),
            F.col(f"`{place}`").alias("Records"),
            (F.col(f"`{max(place - 1, 0)}`") - F.col(f"`{place}`")).alias("Removed"))
        for place, name in enumerate([RAW_STEP, *rules])]
    return df.agg(*counts).select(F.inline(F.array(*steps)))


def apply_rules(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """The rows at the end of the funnel."""
    return df.where(reduce(lambda a, b: a & b, (rules or cleaning_rules()).values()))


def write_clean(df: DataFrame, path: str, rules: Mapping[str, Column] | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """Writes the rows at the end of the funnel as Parquet; gives the funnel and the null
    counts of the raw columns, which the writing job counts as the rows pass by."""
    rules = rules or cleaning_rules()
    kept_so_far, counts = F.lit(True), [F.count(F.lit(1)).alias("0")]
    for place, rule in enumerate(rules.values(), start=1):
        kept_so_far = kept_so_far & F.coalesce(rule, F.lit(False))
        counts.append(F.count(F.when(kept_so_far, 1)).alias(str(place)))
    gaps = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"null {c}") for c in df.columns]
    seen = Observation()
    df.observe(seen, *counts, *gaps).where(kept_so_far).write.parquet(path)
    found = seen.get
    records = [found[str(place)] for place in range(len(rules) + 1)]
    spark = df.sparkSession
    funnel = spark.createDataFrame(
        [(name, count, before - count) for name, count, before in
         zip([RAW_STEP, *rules], records, [records[0], *records])],
        "Step string, Records bigint, Removed bigint")
    nulls = spark.createDataFrame(
        [(c, found[f"null {c}"], records[0]) for c in df.columns],
        "column_name string, null_rows bigint, row_count bigint")
    return funnel, nulls
