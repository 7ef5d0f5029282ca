"""The business insights, computed instead of claimed.

All of them read a cube of trip counts and fare sums over a few low-cardinality
columns; the full report scans the trips once for it and once more for zones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.functions.calendar import EVENING_RUSH, LATE_NIGHT, is_weekend
from farelens.operators.ranking import top_k
from farelens.session import stored


def _dimensions() -> dict[str, Column]:
    return {
        "pickup_hour": F.hour("pickup_datetime"),
        "pickup_month": F.month("pickup_datetime"),
        "is_weekend": is_weekend(),
        "payment_type": F.col("payment_type"),
        "VendorID": F.col("VendorID"),
        "party": F.when(F.col("passenger_count") == 1, "single")
                  .when(F.col("passenger_count") > 1, "multiple").otherwise("unknown"),
        "PULocationID": F.col("PULocationID"),
    }


def fare_cube(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Trips and exact fare sum for each combination of the named dimensions."""
    known = _dimensions()
    return df.groupBy(*[known[d].alias(d) for d in dimensions]).agg(
        F.count("*").alias("trips"),
        F.sum(F.col("fare_amount").cast("decimal(18,2)")).alias("fares"))


def _volume_and_fare() -> list[Column]:
    trips, fares = F.sum("trips"), F.sum("fares")
    return [trips.alias("trip_count"),
            F.round(fares.cast("double") / trips, 6).alias("avg_fare")]


def rush_hour(cube: DataFrame) -> DataFrame:
    """Average fare in the evening rush against all other hours."""
    band = F.when(F.col("pickup_hour").between(*EVENING_RUSH), "evening_rush").otherwise("other")
    return cube.groupBy(band.alias("hour_band")).agg(*_volume_and_fare())


def late_night(cube: DataFrame) -> DataFrame:
    band = F.when(F.col("pickup_hour").between(*LATE_NIGHT), "late_night").otherwise("other")
    return cube.groupBy(band.alias("hour_band")).agg(*_volume_and_fare())


def weekend(cube: DataFrame) -> DataFrame:
    return cube.groupBy("is_weekend").agg(*_volume_and_fare())


def passenger_split(cube: DataFrame) -> DataFrame:
    return cube.groupBy("party").agg(*_volume_and_fare())


def _with_share(counts: DataFrame, within: Sequence[str]) -> DataFrame:
    total = F.sum("trip_count").over(Window.partitionBy(*within))
    return counts.withColumn(
        "share_pct", F.round(100.0 * F.col("trip_count") / total, 4))


def vendor_share(cube: DataFrame) -> DataFrame:
    counts = cube.groupBy("VendorID").agg(F.sum("trips").alias("trip_count"))
    return _with_share(counts, []).orderBy(F.desc("trip_count"), "VendorID")


def payment_trend(cube: DataFrame) -> DataFrame:
    """Share of each payment type per month, and its change from the month before."""
    counts = cube.groupBy("pickup_month", "payment_type").agg(F.sum("trips").alias("trip_count"))
    earlier = Window.partitionBy("payment_type").orderBy("pickup_month")
    return (
        _with_share(counts, ["pickup_month"])
        .withColumn("share_change",
                    F.round(F.col("share_pct") - F.lag("share_pct").over(earlier), 4))
        .orderBy("payment_type", "pickup_month"))


def busiest_month(cube: DataFrame) -> DataFrame:
    counts = cube.groupBy("pickup_month").agg(F.sum("trips").alias("trip_count"))
    return top_k(counts, "trip_count", "pickup_month", 1)


def top_zones(cube: DataFrame, k: int) -> DataFrame:
    zones = cube.groupBy("PULocationID").agg(
        F.sum("trips").alias("trip_count"), F.sum("fares").cast("double").alias("total_fare"))
    return top_k(zones, "total_fare", "PULocationID", k)


def top_hours(hourly: DataFrame, k: int = 3) -> DataFrame:
    """The hours with the most revenue."""
    return top_k(hourly, "total_revenue", "pickup_hour", k)


def highest_average_fare(summary: DataFrame, by: str) -> DataFrame:
    """The row of a fare summary with the largest average."""
    return top_k(summary.select(by, "avg_fare", "trip_count"), "avg_fare", by, 1)


# fixed values: insight numbers with their categories
CATEGORIES = {
    1: "Model", 2: "Pricing", 3: "Payments", 4: "Geography", 5: "Demographics",
    6: "Seasonality", 7: "Timing", 8: "Vendor", 9: "Temporal", 10: "Model"}


def _numbered(number: int, sentence: Column, rows: DataFrame) -> DataFrame:
    return rows.select(
        F.lit(number).alias("Insight_No"), sentence.alias("Insight"),
        F.lit(CATEGORIES[number]).alias("Category"))


def business_insights(trips: DataFrame, importances: DataFrame | None = None,
                      stability: DataFrame | None = None) -> DataFrame:
    """Insight_No, Insight, Category with the measured numbers in the sentence.

    ``importances`` (feature, importance) adds insight 1, ``stability``
    (model, mean_change) adds insight 10. The cube is a small table that seven
    questions ask, so it is written once.
    """
    cube = stored(fare_cube(trips, [
        "pickup_hour", "pickup_month", "is_weekend", "payment_type", "VendorID", "party"]),
        "fare-cube")

    def compared(number: int, bands: DataFrame, band: str, chosen, template: str) -> DataFrame:
        is_chosen = F.col(band) == chosen
        row = bands.agg(
            F.max(F.when(is_chosen, F.col("avg_fare"))).alias("fare"),
            F.max(F.when(~is_chosen, F.col("avg_fare"))).alias("other_fare"),
            F.max(F.when(is_chosen, F.col("trip_count"))).alias("trips"),
            F.max(F.when(~is_chosen, F.col("trip_count"))).alias("other_trips"))
        return _numbered(number, F.format_string(
            template, "fare", "other_fare", "trips", "other_trips"), row)

    numbers = "average fare %.2f against %.2f, %d trips against %d"
    payment = top_k(
        _with_share(cube.groupBy("payment_type").agg(F.sum("trips").alias("trip_count")), []),
        "trip_count", "payment_type", 1)
    vendor = vendor_share(cube).limit(1)
    zones = top_zones(fare_cube(trips, ["PULocationID"]), 4).agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct(
                (-F.col("total_fare")).alias("least"), F.col("PULocationID")))),
            lambda z: z["PULocationID"].cast("string")), ", ").alias("zones"))
    parts = [
        compared(2, rush_hour(cube), "hour_band", "evening_rush", f"Evening rush: {numbers}."),
        _numbered(3, F.format_string("Payment type %s leads with %.2f %% of trips.",
                                     F.col("payment_type").cast("string"), "share_pct"), payment),
        _numbered(4, F.format_string("Zones with the most revenue: %s.", "zones"), zones),
        compared(5, passenger_split(cube).where(F.col("party") != "unknown"), "party", "single",
                 f"Single against multiple passengers: {numbers}."),
        _numbered(6, F.format_string("Month %d is the busiest with %d trips.",
                                     "pickup_month", "trip_count"), busiest_month(cube)),
        compared(7, late_night(cube), "hour_band", "late_night", f"Late night: {numbers}."),
        _numbered(8, F.format_string("Vendor %d has %.2f %% of trips.",
                                     "VendorID", "share_pct"), vendor),
        compared(9, weekend(cube), "is_weekend", 1, f"Weekend: {numbers}."),
    ]
    if importances is not None:
        parts.append(_numbered(1, F.format_string(
            "%s is the strongest predictor (importance %.3f).", "feature", "importance"),
            top_k(importances, "importance", "feature", 1)))
    if stability is not None:
        parts.append(_numbered(10, F.format_string(
            "%s is the most stable model (mean change %.3f %%).", "model", "mean_change"),
            stability.orderBy("mean_change", "model").limit(1)))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.orderBy("Insight_No")
