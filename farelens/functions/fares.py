"""Money, fare classes and fare ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: fare categories by lower bound, and the names of the two fare classes
FARE_CATEGORIES = ((0, "Low"), (10, "Medium"), (25, "High"), (50, "Premium"))
CLASS_LABELS = {0: "Low Fare", 1: "High Fare"}
BIN_DOLLARS = 5
BIN_LIMIT = 100


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def exact_sum(amount: Column | str) -> Column:
    """A sum of cents: the same for every order of addition. Returned as a double."""
    return F.sum(_column(amount).cast("decimal(18,2)")).cast("double")


def average(value: Column | str) -> Column:
    return F.round(F.avg(_column(value)), 6)


def fare_class(threshold: Column | float, fare: str = "fare_amount") -> Column:
    """1 for fares above the threshold, else 0; null for a missing fare."""
    return (F.col(fare) > threshold).cast("int")


def fare_class_label(fare_class_column: str = "Fare_Class") -> Column:
    """The name of a class; null for a missing one."""
    chosen = F.col(fare_class_column)
    return F.when(chosen == 1, CLASS_LABELS[1]).when(chosen.isNotNull(), CLASS_LABELS[0])


def fare_category(fare: Column | str = "fare_amount") -> Column:
    """Low / Medium / High / Premium; null below 0 or missing."""
    value = _column(fare)
    chosen = F.lit(None).cast("string")
    for lower, name in FARE_CATEGORIES:
        chosen = F.when(value >= lower, name).otherwise(chosen)
    return chosen


def fare_bin(fare: str = "fare_amount") -> Column:
    return F.floor(F.col(fare) / BIN_DOLLARS)


def fare_range(bin_column: str = "fare_bin") -> Column:
    lower = F.col(bin_column) * BIN_DOLLARS
    return F.format_string("$%d-$%d", lower, lower + BIN_DOLLARS)


def relative_change(after: Column | str, before: Column | str) -> Column:
    """Percent change; null when the base is 0."""
    base = _column(before)
    return F.try_divide(100.0 * (_column(after) - base), base)


def stability_tier(rmse_change: Column | str) -> Column:
    change = F.abs(_column(rmse_change))
    return F.when(change < 5, "High").when(change < 15, "Medium").when(change.isNotNull(), "Low")
