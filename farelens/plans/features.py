"""Row-level derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.functions import calendar, fares
from farelens.operators.quantiles import median
from farelens.plans.sql_views import HOUR, MONTH, RUSH, SECONDS, WEEKDAY, WEEKEND, sql
from farelens.sources import trips

CATEGORY_SQL = ("CASE WHEN {0} >= 50 THEN 'Premium' WHEN {0} >= 25 THEN 'High' "
                "WHEN {0} >= 10 THEN 'Medium' WHEN {0} >= 0 THEN 'Low' END")


def temporal_features(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.with_calendar(trips(spark, folder)).select(
        "trip_id", "pickup_datetime", "pickup_hour", "pickup_day", "pickup_month",
        "pickup_weekday")


def trip_duration(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.with_duration(trips(spark, folder, with_dropoff=True)).select(
        "trip_id", "trip_duration", F.round("trip_duration_min", 6).alias("trip_duration_min"))


def calendar_flags(spark: SparkSession, folder: str) -> DataFrame:
    return trips(spark, folder).select(
        "trip_id", calendar.is_weekend().alias("is_weekend"),
        calendar.is_rush_hour().alias("is_rush_hour"))


def avg_speed(spark: SparkSession, folder: str) -> DataFrame:
    rows = calendar.with_duration(trips(spark, folder, with_dropoff=True))
    return rows.select("trip_id", F.round(calendar.speed_mph(), 6).alias("avg_speed_mph"))


def classified(rows: DataFrame) -> DataFrame:
    """Rows with ``Fare_Class`` by their own exact median fare."""
    threshold = median(rows, "fare_amount").scalar()
    return rows.withColumn("Fare_Class", fares.fare_class(threshold))


def fare_class_label(spark: SparkSession, folder: str) -> DataFrame:
    return classified(trips(spark, folder)).select(
        "trip_id", "fare_amount", "Fare_Class", fares.fare_class_label().alias("Label"))


def fare_category(spark: SparkSession, folder: str) -> DataFrame:
    return trips(spark, folder).select(
        "trip_id", "fare_amount", fares.fare_category().alias("fare_category"))


def median_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return median(trips(spark, folder), "fare_amount").select(
        F.round("median", 6).alias("median_fare"))


QUERIES = {
    "temporal_features": temporal_features,
    "trip_duration": trip_duration,
    "calendar_flags": calendar_flags,
    "avg_speed": avg_speed,
    "fare_class_label": fare_class_label,
    "fare_category": fare_category,
    "median_threshold": median_threshold,
}

ORACLE = {
    "temporal_features": sql(
        f"SELECT trip_id, pickup_datetime, {HOUR} AS pickup_hour, "
        f"CAST(day(pickup_datetime) AS INTEGER) AS pickup_day, {MONTH} AS pickup_month, "
        f"{WEEKDAY} AS pickup_weekday FROM trips"),
    "trip_duration": sql(
        f"SELECT trip_id, {SECONDS} AS trip_duration, ROUND({SECONDS} / 60, 6) "
        "AS trip_duration_min FROM trips"),
    "calendar_flags": sql(
        f"SELECT trip_id, {WEEKEND} AS is_weekend, {RUSH} AS is_rush_hour FROM trips"),
    "avg_speed": sql(
        f"SELECT trip_id, ROUND(trip_distance / NULLIF({SECONDS} / 3600, 0), 6) "
        "AS avg_speed_mph FROM trips"),
    "fare_class_label": sql("""
        SELECT trip_id, fare_amount, CAST(fare_amount > m AS INTEGER) AS Fare_Class,
          CASE WHEN fare_amount > m THEN 'High Fare' WHEN fare_amount <= m THEN 'Low Fare' END AS Label
        FROM trips, (SELECT quantile_cont(fare_amount, 0.5) AS m FROM trips)"""),
    "fare_category": sql(
        f"SELECT trip_id, fare_amount, {CATEGORY_SQL.format('fare_amount')} AS fare_category "
        "FROM trips"),
    "median_threshold": sql(
        "SELECT ROUND(quantile_cont(fare_amount, 0.5), 6) AS median_fare FROM trips"),
}
