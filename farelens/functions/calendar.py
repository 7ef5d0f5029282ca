"""Time parts and durations of a trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: hours and weekdays (1 = Sunday) behind the flags
MORNING_RUSH = (7, 9)
EVENING_RUSH = (16, 19)
LATE_NIGHT = (0, 4)
WEEKEND_DAYS = (1, 7)


def duration_seconds(pickup: str = "pickup_datetime", dropoff: str = "dropoff_datetime") -> Column:
    """Whole seconds on the wall clock, as a double."""
    return (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)).cast("double")


def elapsed_seconds(zone: str, pickup: str = "pickup_datetime",
                    dropoff: str = "dropoff_datetime") -> Column:
    """Seconds really elapsed in ``zone``, across clock changes."""
    def instant(name: str) -> Column:
        return F.unix_seconds(F.to_utc_timestamp(F.col(name).cast("timestamp"), zone))
    return (instant(dropoff) - instant(pickup)).cast("double")


def is_weekend(pickup: str = "pickup_datetime") -> Column:
    return F.dayofweek(pickup).isin(*WEEKEND_DAYS).cast("int")


def is_rush_hour(pickup: str = "pickup_datetime") -> Column:
    hour = F.hour(pickup)
    return (hour.between(*MORNING_RUSH) | hour.between(*EVENING_RUSH)).cast("int")


def speed_mph(distance: str = "trip_distance", seconds: str = "trip_duration") -> Column:
    """Miles per hour; null for a zero or unknown duration."""
    return F.try_divide(F.col(distance), F.col(seconds) / 3600.0)


def with_calendar(df: DataFrame) -> DataFrame:
    pickup = "pickup_datetime"
    return df.withColumns({
        "pickup_hour": F.hour(pickup),
        "pickup_day": F.dayofmonth(pickup),
        "pickup_month": F.month(pickup),
        "pickup_weekday": F.dayofweek(pickup)})


def with_duration(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "trip_duration": duration_seconds(),
        "trip_duration_min": duration_seconds() / 60.0})


def with_trip_features(df: DataFrame) -> DataFrame:
    """Every derived time feature the models use."""
    return with_duration(with_calendar(df)).withColumns({
        "trip_duration_sec": F.col("trip_duration"),
        "is_weekend": is_weekend(),
        "is_rush_hour": is_rush_hour(),
        "avg_speed_mph": speed_mph()})
