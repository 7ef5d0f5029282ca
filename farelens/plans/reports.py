"""The business report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelens.operators import aggregates
from farelens.plans.features import classified
from farelens.plans.sql_views import HOUR, MONTH, mean, money, sql
from farelens.sources import bills, load_table, trips


def revenue_by_region(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per sales region; nation and region are small fixed lists."""
    customer, nation, region = (
        load_table(spark, folder, name) for name in ("customer", "nation", "region"))
    regions = (
        customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .select(customer["c_custkey"].alias("customer_id"), region["r_name"].alias("region_name")))
    return aggregates.revenue_by_dimension(
        bills(spark, folder), "customer_id", regions, "region_name")


QUERIES = {
    "hourly_fare_volume": lambda spark, folder: aggregates.hourly_fare_volume(trips(spark, folder)),
    "passenger_fare_summary": lambda spark, folder: aggregates.fare_summary(
        trips(spark, folder), "passenger_count"),
    "monthly_fare_summary": lambda spark, folder: aggregates.monthly_fare_summary(
        bills(spark, folder)),
    "trip_behavior": lambda spark, folder: aggregates.trip_behavior(bills(spark, folder)),
    "cost_analysis": lambda spark, folder: aggregates.cost_analysis(bills(spark, folder)),
    "revenue_by_location": lambda spark, folder: aggregates.fare_summary(
        trips(spark, folder), "PULocationID"),
    "payment_distribution": lambda spark, folder: aggregates.payment_distribution(
        trips(spark, folder)),
    "fare_distribution": lambda spark, folder: aggregates.fare_distribution(trips(spark, folder)),
    "class_distribution": lambda spark, folder: aggregates.class_distribution(
        classified(trips(spark, folder))),
    "category_counts": lambda spark, folder: aggregates.category_counts(
        trips(spark, folder), ["passenger_count", "payment_type"]),
    "hour_day_pivot": lambda spark, folder: aggregates.hour_day_pivot(trips(spark, folder)),
    "revenue_by_region": revenue_by_region,
}


def summary_sql(by: str, view: str, name: str | None = None) -> str:
    return sql(f"SELECT {by} AS {name or by}, {mean('fare_amount')} AS avg_fare, "
               f"{money('fare_amount')} AS total_fare, COUNT(*) AS trip_count "
               f"FROM {view} GROUP BY 1")


ORACLE = {
    "hourly_fare_volume": sql(
        f"SELECT {HOUR} AS pickup_hour, {mean('fare_amount')} AS avg_fare, "
        f"{money('fare_amount')} AS total_revenue, COUNT(*) AS trip_count FROM trips GROUP BY 1"),
    "passenger_fare_summary": summary_sql("passenger_count", "trips"),
    "monthly_fare_summary": summary_sql(MONTH, "bills", "pickup_month"),
    "trip_behavior": sql(
        f"SELECT {MONTH} AS pickup_month, {mean('trip_distance')} AS avg_distance, "
        f"{mean('fare_amount')} AS avg_fare, COUNT(*) AS trip_count FROM bills GROUP BY 1"),
    "cost_analysis": sql(
        f"SELECT {MONTH} AS pickup_month, {mean('fare_amount')} AS avg_fare, "
        f"{mean('tip_amount')} AS avg_tip, {mean('tolls_amount')} AS avg_tolls, "
        f"{mean('congestion_surcharge')} AS avg_congestion, {mean('total_amount')} AS avg_total, "
        f"{money('total_amount')} AS total_revenue FROM bills GROUP BY 1"),
    "revenue_by_location": summary_sql("PULocationID", "trips"),
    "payment_distribution": sql(
        f"SELECT payment_type, COUNT(*) AS trips, {mean('fare_amount')} AS avg_fare "
        "FROM trips GROUP BY 1"),
    "fare_distribution": sql("""
        SELECT b AS fare_bin, n AS count, '$' || b * 5 || '-$' || (b * 5 + 5) AS fare_range
        FROM (SELECT CAST(floor(fare_amount / 5) AS BIGINT) AS b, COUNT(*) AS n FROM trips
              WHERE fare_amount > 0 AND fare_amount < 100 GROUP BY 1)"""),
    "class_distribution": sql("""
        SELECT c AS Fare_Class, n AS count, ROUND(100.0 * n / SUM(n) OVER (), 2) AS Percentage,
          CASE c WHEN 1 THEN 'High Fare' WHEN 0 THEN 'Low Fare' END AS Label
        FROM (SELECT CAST(fare_amount > m AS INTEGER) AS c, COUNT(*) AS n
              FROM trips, (SELECT quantile_cont(fare_amount, 0.5) AS m FROM trips) GROUP BY 1)"""),
    "category_counts": sql("""
        SELECT 'passenger_count' AS field, CAST(passenger_count AS VARCHAR) AS value,
          COUNT(*) AS trips FROM trips GROUP BY 2
        UNION ALL SELECT 'payment_type', payment_type, COUNT(*) FROM trips GROUP BY 2"""),
    "hour_day_pivot": sql(
        "SELECT CAST(day(pickup_datetime) AS INTEGER) AS pickup_day, " + ", ".join(
            f"COUNT(*) FILTER (WHERE hour(pickup_datetime) = {h}) AS h{h:02d}" for h in range(24))
        + " FROM trips GROUP BY 1"),
    "revenue_by_region": sql(f"""
        SELECT r_name AS region_name, {money('total_amount')} AS total_revenue,
          COUNT(*) AS trip_count
        FROM bills JOIN customer ON customer_id = c_custkey
          JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1"""),
}
