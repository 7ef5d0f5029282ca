"""Reports kept by months: mergeable aggregate state in a table partitioned by month.

A month's state is sums, counts and sketches, a few rows whatever the month holds. When a
month arrives or is delivered anew, only its rows are read and only its partition is
replaced; reports merge the stored states. Sums are decimal, so a report equals the one
over all rows; quantiles come from KLL sketches and distinct counts from HyperLogLog
sketches, within their published error bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "month"
#: Sketch sizes. KLL: normalised rank error about 2.3 / k ** 0.9 (0.33 % here); HyperLogLog:
#: relative standard error about 1.04 / 2 ** (lg / 2) (0.57 % here).
KLL_SIZE = 1_400
HLL_LG = 15
#: At 99 % confidence, for one rank.
RANK_ERROR = 0.0034
#: Types whose values a HyperLogLog sketch takes as they are.
COUNTED = ("integer", "long", "string", "binary")


def month_of(at: str = "pickup_datetime") -> Column:
    """A month's key: its first day as text."""
    return F.date_format(F.date_trunc("month", F.col(at)), "yyyy-MM")


def write_months(rows: DataFrame, path: str) -> None:
    """Rows with a column ``month``, into a table by month; months that ``rows`` holds are
    replaced and the others left. Spark brings a month's rows together and splits those of a
    large month over files."""
    (rows.hint("rebalance", MONTH).write.partitionBy(MONTH).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def read_months(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """The table, or only the partitions of some months."""
    table = spark.read.option("recursiveFileLookup", False).parquet(path)
    table = table.withColumn(MONTH, F.col(MONTH).cast("string"))
    return table if months is None else table.where(F.col(MONTH).isin(*months))


def month_state(rows: DataFrame, amounts: Sequence[str], quantiles: Sequence[str] = (),
                distinct: Sequence[str] = ()) -> DataFrame:
    """One row a month: ``trips``; of every amount its exact sum, its sum of cents and how
    many values it holds; sketches of the named columns. One partial-then-final
    aggregate."""
    sums = [column for a in amounts for column in (
        F.sum(F.col(a).cast("decimal(28,10)")).alias(f"{a}_sum"),
        F.sum(F.col(a).cast("decimal(18,2)")).alias(f"{a}_cents"), F.count(a).alias(f"{a}_n"))]
    return rows.groupBy(MONTH).agg(
        F.count("*").alias("trips"), *sums,
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_SIZE).alias(f"{c}_kll") for c in quantiles],
        # other types by their text, which tells values apart
        *[F.hll_sketch_agg(c if rows.schema[c].dataType.typeName() in COUNTED else F.col(c).cast("string"),
                           HLL_LG).alias(f"{c}_hll") for c in distinct])


def refresh(spark: SparkSession, rows_path: str, state_path: str, months: Sequence[str] | None,
            amounts: Sequence[str], quantiles: Sequence[str] = (), distinct: Sequence[str] = ()) -> None:
    """Brings the state of the named months up to date, or of all. A month of which no row
    is left keeps no state."""
    rows = read_months(spark, rows_path, months)
    state = month_state(rows, amounts, quantiles, distinct)
    if months is None:
        state.coalesce(1).write.partitionBy(MONTH).mode("overwrite").parquet(state_path)
        return
    # every named month gets a partition, so that one that lost its rows is replaced too
    named = spark.createDataFrame([(m,) for m in months], f"{MONTH} string")
    whole = named.join(state, MONTH, "left").select(*state.columns)
    (whole.coalesce(1).write.partitionBy(MONTH).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(state_path))


def by_month_of_year(state: DataFrame, averages: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """pickup_month, trip_count, avg_<amount> and total_<amount>, over the months' states."""
    return state.where("trips IS NOT NULL").groupBy(
        F.substring(MONTH, 6, 2).cast("int").alias("pickup_month")).agg(
        F.sum("trips").alias("trip_count"),
        *[F.round(F.try_divide(F.sum(f"{a}_sum").cast("double"), F.sum(f"{a}_n")), 6).alias(f"avg_{a}")
          for a in averages],
        *[F.sum(f"{a}_cents").cast("double").alias(f"total_{a}") for a in totals]).orderBy("pickup_month")


def merged_quantiles(state: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """probability and estimate, from the months' sketches."""
    one = state.where("trips IS NOT NULL").agg(
        F.kll_merge_agg_double(f"{column}_kll", KLL_SIZE).alias("sketch"))
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(float(p)).alias("probability"),
                 F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("estimate"))
        for p in probabilities])))


def rank_check(estimates: DataFrame, rows: DataFrame, column: str, error: float = RANK_ERROR) -> DataFrame:
    """probability, row_count, and whether the estimate's true rank is within the bound. One
    pass counts the rows at or below and below every estimate; estimates are few."""
    found = [(r["probability"], r["estimate"]) for r in estimates.collect()]
    number = F.col(column).cast("double")
    counted = rows.where(number.isNotNull()).agg(
        F.count("*").alias("n"),
        *[F.count_if(number < e).alias(f"below_{i}") for i, (_, e) in enumerate(found)],
        *[F.count_if(number <= e).alias(f"upto_{i}") for i, (_, e) in enumerate(found)])
    checks = [F.struct(
        F.lit(p).alias("probability"), F.col("n").alias("row_count"),
        ((F.col(f"below_{i}") <= (p + error) * F.col("n")) & (F.col(f"upto_{i}") >= (p - error) * F.col("n")))
        .alias("within_bound")) for i, (p, _) in enumerate(found)]
    return counted.select(F.inline(F.array(*checks)))


def merged_distinct(state: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name and estimate of the distinct values over all months."""
    one = state.where("trips IS NOT NULL").agg(*[
        F.hll_sketch_estimate(F.hll_union_agg(f"{c}_hll")).alias(c) for c in columns])
    return one.unpivot([], list(columns), "column_name", "estimate")
