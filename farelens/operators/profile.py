"""Numbers behind the exploratory plots, from all rows rather than a collected sample."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions.keys import unit_hash
from farelens.operators.quantiles import quantiles_of, ranged_totals, value_histogram
from farelens.operators.sampling import bottom_k

PAIRS_IN_A_ROW = 14  # six aggregation buffers each: more leave whole-stage codegen


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, long form.

    Like a pairwise matrix, each pair uses the rows where both values exist. Each group of
    pairs is one row of moments: a count, two means, two squares and a product a pair. All
    pairs in one row are too wide to be compiled and several times slower, so the groups
    are scans of their own, each of its own columns.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def cell(x: str, y: str, place: int) -> Column:
        return F.struct(F.lit(x).alias("feature_x"), F.lit(y).alias("feature_y"),
                        F.col(f"`{place}`").alias("correlation"))

    def measured(group: Sequence[tuple[str, str]]) -> DataFrame:
        row = numbers.agg(*[F.round(F.corr(a, b), 6).alias(f"{i}") for i, (a, b) in enumerate(group)])
        cells = [cell(x, y, i) for i, pair in enumerate(group) for x, y in dict.fromkeys([pair, pair[::-1]])]
        return row.select(F.inline(F.array(*cells)))

    return reduce(DataFrame.unionByName, [
        measured(pairs[at:at + PAIRS_IN_A_ROW]) for at in range(0, len(pairs), PAIRS_IN_A_ROW)])


def _range_of(df: DataFrame, value: str) -> Column:
    """Scalar {lo, hi, sd, n} of one column."""
    number = F.col(value).cast("double")
    return df.agg(F.struct(
        F.min(number).alias("lo"), F.max(number).alias("hi"),
        F.stddev(number).alias("sd"), F.count(number).alias("n")).alias("r")).scalar()


def histogram_equal_width(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between minimum and maximum; empty bins are left out."""
    span = _range_of(df, value)
    width = (span["hi"] - span["lo"]) / bins
    place = F.coalesce(F.try_divide(F.col("_v") - span["lo"], span["hi"] - span["lo"]), F.lit(0.0))
    return (
        df.select(F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
        .groupBy(F.least(F.floor(place * bins), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("row_count"))
        .select("bin",
                F.round(span["lo"] + F.col("bin") * width, 6).alias("bin_start"),
                F.round(span["lo"] + (F.col("bin") + 1) * width, 6).alias("bin_end"),
                "row_count")
        .orderBy("bin"))


def kde_grid(df: DataFrame, value: str, bins: int, points: int) -> DataFrame:
    """Gaussian density on a grid, from the bins of the histogram.

    Every bin contributes to every grid point: bins x points terms, however
    many rows there are. Bandwidth is sd * n^(-1/5).
    """
    span = _range_of(df, value)
    reach = span["hi"] - span["lo"]
    histogram = histogram_equal_width(df, value, bins)
    spread = histogram.select(
        (span["lo"] + (F.col("bin") + 0.5) * reach / bins).alias("_mid"), "row_count",
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    grid = span["lo"] + F.col("point") * reach / (points - 1)
    bandwidth = span["sd"] * F.pow(span["n"].cast("double"), F.lit(-0.2))
    z = F.try_divide(grid - F.col("_mid"), bandwidth)
    kernel = F.col("row_count") * F.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    return (
        spread.groupBy("point")
        .agg(F.sum(kernel).alias("_k"))
        .select("point", F.round(grid, 6).alias("x"),
                F.round(F.try_divide(F.col("_k"), span["n"] * bandwidth), 9).alias("density"))
        .orderBy("point"))


def boxplot_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and outlier count per group.

    Everything after the first count works on distinct (group, value) pairs. The
    quartiles meet them by group and range, so that a group of most rows stays spread.
    """
    ranked = ranged_totals(value_histogram(df, value, [group]), "_value", ["_n"], [group])
    quartiles = quantiles_of(ranked, {"q1": 0.25, "med": 0.5, "q3": 0.75}, [group])
    by_range = ranked.groupBy(group, "_part").agg(F.lit(1).alias("_one")).join(quartiles, group)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("_value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        ranked.join(by_range, [group, "_part"])
        .groupBy(group)
        .agg(F.sum("_n").alias("row_count"),
             *[F.round(F.max(c), 6).alias(c) for c in ("q1", "med", "q3")],
             F.min(F.when(inside, F.col("_value"))).alias("whisker_low"),
             F.max(F.when(inside, F.col("_value"))).alias("whisker_high"),
             F.sum(F.when(inside, 0).otherwise(F.col("_n"))).alias("outliers"))
        .orderBy(group))


def scatter_points(df: DataFrame, key: str | Column, x: str, y: str, most: int) -> DataFrame:
    """The points of a scatter plot, ``most`` of them or all: the rows with the smallest key
    hashes, the same for any layout."""
    place = F.col(key) if isinstance(key, str) else key
    return bottom_k(df.select(place.alias("_key"), x, y), "_key", most).select(x, y)


def scatter_sample(df: DataFrame, key: str | Column, x: str, y: str, fraction: float) -> DataFrame:
    """The points of a scatter plot: a repeatable sample of rows by key hash."""
    return df.where(unit_hash(key) < fraction).select(x, y)
