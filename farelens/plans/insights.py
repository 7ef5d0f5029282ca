"""The business insights and top-k questions."""

from __future__ import annotations

from farelens.operators import aggregates, insights
from farelens.plans import models, stability
from farelens.plans.sql_views import HOUR, MONTH, WEEKEND, mean, money, sql
from farelens.sources import bills, trips


def _cube(source, *dimensions):
    return lambda spark, folder: insights.fare_cube(source(spark, folder), dimensions)


def _answer(question, source, *dimensions):
    cube = _cube(source, *dimensions)
    return lambda spark, folder: question(cube(spark, folder))


def all_insights(spark, folder):
    """All ten: the strongest predictor of a fitted tree and the most stable formula join
    the eight that need no model."""
    return insights.business_insights(
        trips(spark, folder), models.topk_features(spark, folder),
        stability.most_stable_model(spark, folder))


QUERIES = {
    "top3_hours": lambda spark, folder: insights.top_hours(
        aggregates.hourly_fare_volume(trips(spark, folder)), 3),
    "argmax_passenger": lambda spark, folder: insights.highest_average_fare(
        aggregates.fare_summary(trips(spark, folder), "passenger_count"), "passenger_count"),
    "insight_rush_hour": _answer(insights.rush_hour, trips, "pickup_hour"),
    "insight_late_night": _answer(insights.late_night, trips, "pickup_hour"),
    "insight_weekend": _answer(insights.weekend, trips, "is_weekend"),
    "insight_passenger_split": _answer(insights.passenger_split, trips, "party"),
    "insight_vendor_share": _answer(insights.vendor_share, trips, "VendorID"),
    "insight_top_zones": _answer(
        lambda cube: insights.top_zones(cube, 10), trips, "PULocationID"),
    "insight_payment_trend": _answer(
        insights.payment_trend, bills, "pickup_month", "payment_type"),
    "insight_busiest_month": _answer(insights.busiest_month, bills, "pickup_month"),
    "business_insights": all_insights,
}

FARE = "ROUND(CAST(SUM(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 6)"


def _bands(expression: str, name: str) -> str:
    return sql(f"SELECT {expression} AS {name}, COUNT(*) AS trip_count, {FARE} AS avg_fare "
               "FROM trips GROUP BY 1")


PARTY = ("CASE WHEN passenger_count = 1 THEN 'single' WHEN passenger_count > 1 THEN 'multiple' "
         "ELSE 'unknown' END")

ORACLE = {
    "top3_hours": sql(
        f"SELECT {HOUR} AS pickup_hour, {mean('fare_amount')} AS avg_fare, "
        f"{money('fare_amount')} AS total_revenue, COUNT(*) AS trip_count FROM trips GROUP BY 1 "
        "ORDER BY total_revenue DESC, pickup_hour LIMIT 3"),
    "argmax_passenger": sql(
        f"SELECT passenger_count, {mean('fare_amount')} AS avg_fare, COUNT(*) AS trip_count "
        "FROM trips GROUP BY 1 ORDER BY avg_fare DESC, passenger_count LIMIT 1"),
    "insight_rush_hour": _bands(
        "CASE WHEN hour(pickup_datetime) BETWEEN 16 AND 19 THEN 'evening_rush' ELSE 'other' END",
        "hour_band"),
    "insight_late_night": _bands(
        "CASE WHEN hour(pickup_datetime) BETWEEN 0 AND 4 THEN 'late_night' ELSE 'other' END",
        "hour_band"),
    "insight_weekend": _bands(WEEKEND, "is_weekend"),
    "insight_passenger_split": _bands(PARTY, "party"),
    "insight_vendor_share": sql("""
        SELECT VendorID, CAST(n AS BIGINT) AS trip_count,
          ROUND(100.0 * n / SUM(n) OVER (), 4) AS share_pct
        FROM (SELECT VendorID, COUNT(*) AS n FROM trips GROUP BY 1)"""),
    "insight_top_zones": sql(
        f"SELECT PULocationID, COUNT(*) AS trip_count, {money('fare_amount')} AS total_fare "
        "FROM trips GROUP BY 1 ORDER BY total_fare DESC, PULocationID LIMIT 10"),
    "insight_payment_trend": sql(f"""
        SELECT *, ROUND(share_pct - LAG(share_pct) OVER (PARTITION BY payment_type
            ORDER BY pickup_month), 4) AS share_change
        FROM (SELECT pickup_month, payment_type, n AS trip_count,
                ROUND(100.0 * n / SUM(n) OVER (PARTITION BY pickup_month), 4) AS share_pct
              FROM (SELECT {MONTH} AS pickup_month, payment_type, COUNT(*) AS n
                    FROM bills GROUP BY 1, 2))"""),
    "insight_busiest_month": sql(
        f"SELECT {MONTH} AS pickup_month, COUNT(*) AS trip_count FROM bills GROUP BY 1 "
        "ORDER BY trip_count DESC, pickup_month LIMIT 1"),
}
