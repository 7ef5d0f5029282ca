"""Grouped fare summaries. Each is one partial-then-final aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.functions.fares import (
    BIN_LIMIT, average, exact_sum, fare_bin, fare_class_label, fare_range)


def hourly_fare_volume(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.hour("pickup_datetime").alias("pickup_hour"))
        .agg(average("fare_amount").alias("avg_fare"),
             exact_sum("fare_amount").alias("total_revenue"),
             F.count("*").alias("trip_count"))
        .orderBy("pickup_hour"))


def fare_summary(df: DataFrame, by: str) -> DataFrame:
    """Average fare, total fare and trips for each value of one column."""
    return (
        df.groupBy(by)
        .agg(average("fare_amount").alias("avg_fare"),
             exact_sum("fare_amount").alias("total_fare"),
             F.count("*").alias("trip_count"))
        .orderBy(by))


def _by_month(df: DataFrame) -> DataFrame:
    return df.withColumn("pickup_month", F.month("pickup_datetime"))


#: The columns of the reports by month.
MONTHLY_REPORTS = {
    "cost_analysis": ["avg_fare", "avg_tip", "avg_tolls", "avg_congestion", "avg_total", "total_revenue"],
    "trip_behavior": ["avg_distance", "avg_fare", "trip_count"],
    "monthly_fare_summary": ["avg_fare", "total_fare", "trip_count"],
}


def monthly_totals(df: DataFrame) -> DataFrame:
    """What all reports by month need, in one pass; a report picks its columns."""
    return (
        _by_month(df).groupBy("pickup_month")
        .agg(average("fare_amount").alias("avg_fare"),
             average("trip_distance").alias("avg_distance"),
             average("tip_amount").alias("avg_tip"),
             average("tolls_amount").alias("avg_tolls"),
             average("congestion_surcharge").alias("avg_congestion"),
             average("total_amount").alias("avg_total"),
             exact_sum("fare_amount").alias("total_fare"),
             exact_sum("total_amount").alias("total_revenue"),
             F.count("*").alias("trip_count")))


def monthly_report(totals: DataFrame, name: str) -> DataFrame:
    return totals.select("pickup_month", *MONTHLY_REPORTS[name]).orderBy("pickup_month")


def monthly_fare_summary(df: DataFrame) -> DataFrame:
    return monthly_report(monthly_totals(df), "monthly_fare_summary")


def trip_behavior(df: DataFrame) -> DataFrame:
    return monthly_report(monthly_totals(df), "trip_behavior")


def cost_analysis(df: DataFrame) -> DataFrame:
    return monthly_report(monthly_totals(df), "cost_analysis")


def fare_subtotals(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Fares by all dimensions, by ever fewer of them from the right, and in all. ``level`` is
    the bit mask of the dimensions that a row sums over, which tells a subtotal from a
    missing value. One scan; rows are laid out by level and summed inside tasks first."""
    return (
        df.rollup(*dimensions)
        .agg(F.grouping_id().cast("int").alias("level"), average("fare_amount").alias("avg_fare"),
             exact_sum("fare_amount").alias("total_fare"), F.count("*").alias("trip_count")))


def payment_distribution(df: DataFrame) -> DataFrame:
    """Payment types, the most used first."""
    return (
        df.groupBy("payment_type")
        .agg(F.count("*").alias("trips"), average("fare_amount").alias("avg_fare"))
        .orderBy(F.desc("trips"), "payment_type"))


def fare_distribution(df: DataFrame) -> DataFrame:
    """Trips per $5 range below $100."""
    return (
        df.where((F.col("fare_amount") > 0) & (F.col("fare_amount") < BIN_LIMIT))
        .groupBy(fare_bin().alias("fare_bin"))
        .agg(F.count("*").alias("count"))
        .withColumn("fare_range", fare_range())
        .orderBy("fare_bin"))


def class_distribution(classified: DataFrame) -> DataFrame:
    """Fare_Class, count, Percentage, Label; both counts come from one row."""
    counted = classified.agg(
        F.count_if(F.col("Fare_Class") == 0).alias("0"),
        F.count_if(F.col("Fare_Class") == 1).alias("1"))
    rows = [
        F.struct(F.lit(c).alias("Fare_Class"), F.col(f"`{c}`").alias("count")) for c in (0, 1)]
    total = F.col("`0`") + F.col("`1`")
    return counted.select(total.alias("_total"), F.inline(F.array(*rows))).select(
        "Fare_Class", "count",
        F.round(F.try_divide(100.0 * F.col("count"), F.col("_total")), 2).alias("Percentage"),
        fare_class_label().alias("Label"))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Frequency of each value of several columns, from one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.inline(pairs))
        .groupBy("field", "value").agg(F.count("*").alias("trips"))
        .orderBy("field", F.desc("trips"), "value"))


def hour_day_pivot(df: DataFrame) -> DataFrame:
    """Trips by day of month (rows) and hour (columns h00..h23).

    The hours are known, so each is a conditional count and the pivot needs no
    extra job to find its columns.
    """
    hour = F.hour("pickup_datetime")
    return (
        df.groupBy(F.dayofmonth("pickup_datetime").alias("pickup_day"))
        .agg(*[F.count_if(hour == h).alias(f"h{h:02d}") for h in range(24)])
        .orderBy("pickup_day"))


def revenue_by_dimension(df: DataFrame, key: str, names: DataFrame, name: str) -> DataFrame:
    """Revenue per name of a lookup table.

    Trips are summed per key before the join, so the join sees one row per key
    however often a key occurs.
    """
    per_key = df.groupBy(key).agg(
        F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("_revenue"),
        F.count("*").alias("_trips"))
    return (
        per_key.join(names, key, "left")
        .groupBy(name)
        .agg(F.sum("_revenue").cast("double").alias("total_revenue"),
             F.sum("_trips").alias("trip_count"))
        .orderBy(name))
