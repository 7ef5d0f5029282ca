"""Distributions and relations between columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelens.operators import profile
from farelens.plans.sql_views import HOUR, sql
from farelens.sources import line_charges, trips

CHARGES = ["trip_distance", "fare_amount", "tip_amount", "tolls_amount", "extra",
           "congestion_surcharge", "total_amount"]
BINS, POINTS = 50, 100
SCATTER_POINTS = 2_000

QUERIES = {
    "correlation_matrix": lambda spark, folder: profile.correlation_matrix(
        line_charges(spark, folder), CHARGES),
    "histogram_equal_width": lambda spark, folder: profile.histogram_equal_width(
        line_charges(spark, folder), "fare_amount", BINS),
    "histogram_distance": lambda spark, folder: profile.histogram_equal_width(
        trips(spark, folder), "trip_distance", 100),
    "kde_grid": lambda spark, folder: profile.kde_grid(
        trips(spark, folder), "fare_amount", BINS, POINTS),
    "boxplot_by_group": lambda spark, folder: profile.boxplot_by_group(
        trips(spark, folder), "passenger_count", "fare_amount"),
    "boxplot_by_hour": lambda spark, folder: profile.boxplot_by_group(
        trips(spark, folder).withColumn("pickup_hour", F.hour("pickup_datetime")), "pickup_hour", "fare_amount"),
    "scatter_sample": lambda spark, folder: profile.scatter_sample(
        trips(spark, folder), "trip_id", "trip_distance", "fare_amount", 0.1),
    "scatter_points": lambda spark, folder: profile.scatter_points(
        trips(spark, folder), "trip_id", "trip_distance", "fare_amount", SCATTER_POINTS),
}


UNIT_HASH = "((({0} % 2147483648) * 2654435761) % 4294967296) / 4294967296.0::DOUBLE"


def _correlation_sql() -> str:
    return sql(" UNION ALL ".join(
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, ROUND(CORR({a}, {b}), 6) AS correlation "
        "FROM bills" for a in CHARGES for b in CHARGES))


def _histogram_sql(view: str, column: str, bins: int) -> str:
    return sql(f"""
        SELECT bin, ROUND(lo + bin * (hi - lo) / {bins}, 6) AS bin_start,
          ROUND(lo + (bin + 1) * (hi - lo) / {bins}, 6) AS bin_end, COUNT(*) AS row_count
        FROM (SELECT lo, hi, CAST(LEAST(COALESCE(floor(({column} - lo) / NULLIF(hi - lo, 0)
                * {bins}), 0), {bins - 1}) AS INTEGER) AS bin
              FROM {view}, (SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {view}))
        GROUP BY bin, lo, hi""")


def _kde_sql() -> str:
    return sql(f"""
        SELECT CAST(g AS INTEGER) AS point, ROUND(lo + g * (hi - lo) / {POINTS - 1}, 6) AS x,
          ROUND(SUM(n * exp(-0.5 * pow((lo + g * (hi - lo) / {POINTS - 1} - mid) / h, 2))
            / sqrt(2 * pi())) / (MAX(total) * MAX(h)), 9) AS density
        FROM (SELECT lo, hi, total, sd * pow(total, -0.2) AS h,
                lo + (bin + 0.5) * (hi - lo) / {BINS} AS mid, n
              FROM (SELECT lo, hi, total, sd,
                      LEAST(floor((fare_amount - lo) / (hi - lo) * {BINS}), {BINS - 1}) AS bin,
                      COUNT(*) AS n
                    FROM trips, (SELECT MIN(fare_amount) AS lo, MAX(fare_amount) AS hi,
                      STDDEV_SAMP(fare_amount) AS sd, COUNT(*) AS total FROM trips)
                    GROUP BY ALL)),
          range({POINTS}) AS points(g)
        GROUP BY g, lo, hi""")


def _boxplot_sql(group: str, name: str) -> str:
    return sql(f"""
        SELECT g AS {name}, CAST(COUNT(*) AS BIGINT) AS row_count, ROUND(MAX(q1), 6) AS q1,
          ROUND(MAX(med), 6) AS med, ROUND(MAX(q3), 6) AS q3,
          MIN(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
            AS whisker_low,
          MAX(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
            AS whisker_high,
          COUNT(*) FILTER (WHERE v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
            AS outliers
        FROM (SELECT {group} AS g, fare_amount AS v FROM trips)
        JOIN (SELECT {group} AS g, quantile_cont(fare_amount, 0.25) AS q1,
                quantile_cont(fare_amount, 0.5) AS med, quantile_cont(fare_amount, 0.75) AS q3
              FROM trips GROUP BY 1) USING (g)
        GROUP BY g""")


ORACLE = {
    "correlation_matrix": _correlation_sql(),
    "histogram_equal_width": _histogram_sql("bills", "fare_amount", BINS),
    "histogram_distance": _histogram_sql("trips", "trip_distance", 100),
    "kde_grid": _kde_sql(),
    "boxplot_by_group": _boxplot_sql("passenger_count", "passenger_count"),
    "boxplot_by_hour": _boxplot_sql(HOUR, "pickup_hour"),
    "scatter_sample": sql(
        "SELECT trip_distance, fare_amount FROM trips WHERE "
        + UNIT_HASH.format("trip_id") + " < 0.1"),
    "scatter_points": sql(
        "SELECT trip_distance, fare_amount FROM trips ORDER BY "
        + UNIT_HASH.format("trip_id") + f", trip_id LIMIT {SCATTER_POINTS}"),
}
