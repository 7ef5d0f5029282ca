"""Exact quantiles and running totals without sorting everything in one task.

Rows are range-partitioned on their order: Spark places the borders by a sample, so
clustered values spread over tasks like any others. One total per partition gives
every partition its starting rank; inside a partition a window does the rest. The
partitioned rows are written once, so that all parts of a plan see the same borders.
NaN is the largest number and infinities are values, as in Spark's ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelens.session import narrow_merges, stored


def _in_ranges(rows: DataFrame, order: Sequence[Column | str], purpose: str) -> DataFrame:
    """The rows written in ranges of ``order``, with the number of each row's range in ``_part``."""
    narrow_merges(rows.sparkSession)
    return stored(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), purpose)


def with_row_numbers(rows: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Add ``out`` = the place of each row in ``order``, from 0. The order must be total."""
    ranged = _in_ranges(rows, order, "places")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_rows"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.join(offsets, "_part").select(*rows.columns, (F.col("_base") + place).alias(out))


def value_histogram(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their counts. Rows without value or group are left out."""
    filled = F.col(value).isNotNull()
    for group in groups:
        filled = filled & F.col(group).isNotNull()
    return (
        df.where(filled)
        .groupBy(*groups, F.col(value).cast("double").alias("_value"))
        .agg(F.count("*").alias("_n")))


def ranged_totals(rows: DataFrame, order: str, counts: Sequence[str], groups: Sequence[str] = (),
                  descending: bool = False) -> DataFrame:
    """As ``with_running_totals``, with the number of each row's range in ``_part``.

    The windows over ranges see one row per range and group.
    """
    keys = [*groups, "_part"]
    ranged = _in_ranges(rows, [*groups, order], "ranks")
    sequence = F.desc if descending else F.asc
    earlier = Window.partitionBy(*groups).orderBy(sequence("_part")).rowsBetween(
        Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*groups)
    offsets = ranged.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts]).select(
        *keys,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_base") for c in counts],
        *[F.sum(c).over(everything).alias(f"{c}_total") for c in counts])
    inside = Window.partitionBy(*keys).orderBy(sequence(order)).rowsBetween(
        Window.unboundedPreceding, -1)
    return ranged.join(offsets, keys).select(
        *rows.columns, "_part",
        *[(F.col(f"{c}_base") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before")
          for c in counts],
        *[F.col(f"{c}_total") for c in counts])


def with_running_totals(rows: DataFrame, order: str, counts: Sequence[str],
                        groups: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Add ``<count>_before`` (total of all rows earlier in ``order``) and ``<count>_total``.

    ``order`` must be a number that is distinct within its group; groups are not null.
    """
    return ranged_totals(rows, order, counts, groups, descending).drop("_part")


def quantiles_of(ranked: DataFrame, probabilities: dict[str, float],
                 groups: Sequence[str] = ()) -> DataFrame:
    """Interpolated quantiles of a histogram with running totals."""

    def position(p: float) -> Column:
        return F.lit(p) * (F.col("_n_total") - 1)

    def at(rank: Column) -> Column:
        held = (F.col("_n_before") <= rank) & (rank < F.col("_n_before") + F.col("_n"))
        return F.max(F.when(held, F.col("_value")))

    ends = ranked.groupBy(*groups).agg(
        F.max("_n_total").alias("_n_total"),
        *[at(F.floor(position(p))).alias(f"_low_{name}") for name, p in probabilities.items()],
        *[at(F.ceil(position(p))).alias(f"_high_{name}") for name, p in probabilities.items()])

    def between(name: str, p: float) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        part = position(p) - F.floor(position(p))
        return F.when((part == 0) | (low == high), low).otherwise(low * (1 - part) + high * part)

    return ends.select(*groups, *[between(name, p).alias(name) for name, p in probabilities.items()])


def exact_quantiles(df: DataFrame, value: str, probabilities: dict[str, float],
                    groups: Sequence[str] = ()) -> DataFrame:
    """Interpolated quantiles (name -> probability), per group if groups are given."""
    ranked = ranged_totals(value_histogram(df, value, groups), "_value", ["_n"], groups)
    return quantiles_of(ranked, probabilities, groups)


def median(df: DataFrame, value: str) -> DataFrame:
    return exact_quantiles(df, value, {"median": 0.5})
