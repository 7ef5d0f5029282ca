"""Reports on data that arrive in deliveries: streams, months, versions, open intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.functions.fares import exact_sum
from farelens.operators import aggregates, increments, intervals, reconcile
from farelens.plans.sql_views import MONTH, mean, money, sql
from farelens.session import narrow_scans, scratch_dir, stored
from farelens.sources import bills, load_table, trips
from farelens.streaming import hourly

LATENESS = "1 hour"
AMOUNTS = ["trip_distance", "fare_amount", "tip_amount", "tolls_amount", "congestion_surcharge", "total_amount"]
TOTALS = ["fare_amount", "total_amount"]
QUANTILES = [0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
DISTINCT = ["customer_id", "PULocationID", "DOLocationID", "fare_amount"]
SUBTOTALS = ["pickup_month", "payment_type", "VendorID"]


def stream_hourly_fares(spark: SparkSession, folder: str) -> DataFrame:
    """All trips in two deliveries, the second with the last half hour of the first once
    more, taken by two runs of the stream from one checkpoint."""
    root = scratch_dir(spark, "stream")
    all_trips = trips(spark, folder)
    ends = all_trips.agg(F.min("pickup_datetime").alias("first"), F.max("pickup_datetime").alias("last")).first()
    border = ends["first"] + (ends["last"] - ends["first"]) / 2 if ends["first"] else None
    again = F.lit(border).cast("timestamp_ntz") - F.expr("INTERVAL 30 MINUTES")
    deliveries = [all_trips.where(F.col("pickup_datetime") < F.lit(border).cast("timestamp_ntz")),
                  all_trips.where(F.col("pickup_datetime") >= again)]
    for delivery in deliveries:
        delivery.write.mode("append").parquet(f"{root}/landing")
        windows = hourly.hourly_windows(
            hourly.delivered(spark, f"{root}/landing", all_trips.schema), "trip_id", "pickup_datetime",
            "fare_amount", LATENESS)
        hourly.run_available(windows, f"{root}/changes", f"{root}/checkpoint")
    return hourly.hourly_report(spark, f"{root}/changes")


def kept_months(spark: SparkSession, folder: str, amounts=(), quantiles=(), distinct=()
                ) -> tuple[DataFrame, DataFrame]:
    """The bills by month and their state. All months but the last are delivered first, the
    first of them with its first three lines an order only; then both come whole."""
    root = scratch_dir(spark, "months")
    narrow_scans(spark)  # a scan's task counts distinct values of all its rows
    columns = list(dict.fromkeys([*amounts, *quantiles, *distinct]))
    everything = bills(spark, folder).select(
        "l_linenumber", *columns, increments.month_of().alias(increments.MONTH))
    increments.write_months(everything, f"{root}/delivered")
    source = increments.read_months(spark, f"{root}/delivered")
    first, last = source.agg(F.min("month"), F.max("month")).first()
    state = dict(amounts=amounts, quantiles=quantiles, distinct=distinct)
    early = source.where((F.col("month") != last) & ((F.col("month") != first) | (F.col("l_linenumber") <= 3)))
    increments.write_months(early, f"{root}/rows")
    increments.refresh(spark, f"{root}/rows", f"{root}/state", None, **state)
    late = increments.read_months(spark, f"{root}/delivered", [first, last])
    increments.write_months(late, f"{root}/rows")
    increments.refresh(spark, f"{root}/rows", f"{root}/state", [first, last], **state)
    return increments.read_months(spark, f"{root}/rows"), increments.read_months(spark, f"{root}/state")


def monthly_report_kept(spark: SparkSession, folder: str) -> DataFrame:
    return increments.by_month_of_year(kept_months(spark, folder, AMOUNTS)[1], AMOUNTS, TOTALS)


def quantile_sketches(spark: SparkSession, folder: str) -> DataFrame:
    rows, state = kept_months(spark, folder, quantiles=["fare_amount"])
    return increments.rank_check(
        increments.merged_quantiles(state, "fare_amount", QUANTILES), rows, "fare_amount")


def distinct_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """column_name, distinct_values by the exact count, and whether the merged sketches are
    within 2 % of it."""
    rows, state = kept_months(spark, folder, distinct=DISTINCT)
    exact = rows.agg(*[F.count_distinct(c).alias(c) for c in DISTINCT]).unpivot(
        [], DISTINCT, "column_name", "distinct_values")
    return exact.join(increments.merged_distinct(state, DISTINCT), "column_name").select(
        "column_name", "distinct_values",
        (F.abs(F.col("estimate") - F.col("distinct_values")) <= 0.02 * F.col("distinct_values"))
        .alias("within_2_percent"))


def line_versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The lines as first delivered, and a second delivery: returned lines without tax,
    lines of one piece gone, the first line of each order twice."""
    before = load_table(spark, folder, "lineitem").select(*LINE)
    after = before.where("l_quantity <> 1").withColumn(
        "l_tax", F.when(F.col("l_returnflag") == "R", 0.0).otherwise(F.col("l_tax")))
    return before, after.unionByName(after.where("l_linenumber = 1"))


LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag"]


def open_lines(spark: SparkSession, folder: str) -> DataFrame:
    """For each order the lines of the same customer that are ordered by its date and not
    yet shipped: o_orderkey, open_lines and open_amount."""
    orders = load_table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = bills(spark, folder).select(
        F.col("customer_id").alias("o_custkey"), "pickup_datetime", "dropoff_datetime", "fare_amount")
    return intervals.open_totals(
        orders, "o_orderdate", lines, "pickup_datetime", "dropoff_datetime", ["o_custkey"], "fare_amount",
        "open_lines", "open_amount")


def fare_subtotals(spark: SparkSession, folder: str) -> DataFrame:
    rows = bills(spark, folder).withColumn("pickup_month", F.month("pickup_datetime"))
    return aggregates.fare_subtotals(rows, SUBTOTALS)


QUERIES = {
    "stream_hourly_fares": stream_hourly_fares,
    "monthly_report_kept": monthly_report_kept,
    "quantile_sketches": quantile_sketches,
    "distinct_sketches": distinct_sketches,
    "reconcile_lines": lambda spark, folder: reconcile.changes(
        *(stored(v, "versions") for v in line_versions(spark, folder))),
    "reconcile_summary": lambda spark, folder: reconcile.change_summary(*line_versions(spark, folder)),
    "open_lines": open_lines,
    "fare_subtotals": fare_subtotals,
}

VERSIONS_SQL = f"""old AS (SELECT {', '.join(LINE)} FROM lineitem),
changed AS (
  SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_tax END AS l_tax,
    l_returnflag
  FROM lineitem WHERE l_quantity <> 1),
fresh AS (SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE l_linenumber = 1),
compared AS (
  SELECT {', '.join(LINE)}, COALESCE(b, 0) AS copies_before, COALESCE(a, 0) AS copies_after,
    GREATEST(COALESCE(a, 0) - COALESCE(b, 0), 0) AS added,
    GREATEST(COALESCE(b, 0) - COALESCE(a, 0), 0) AS removed,
    GREATEST(COALESCE(a, 0) - 1, 0) AS repeated
  FROM (SELECT {', '.join(LINE)}, COUNT(*) AS b FROM old GROUP BY ALL)
  FULL JOIN (SELECT {', '.join(LINE)}, COUNT(*) AS a FROM fresh GROUP BY ALL) USING ({', '.join(LINE)}))"""

ORACLE = {
    "stream_hourly_fares": sql(
        f"SELECT date_trunc('hour', pickup_datetime) AS pickup_window, "
        f"ROUND(CAST(SUM(CAST(fare_amount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 6) AS avg_fare, "
        f"{money('fare_amount')} AS total_revenue, COUNT(*) AS trip_count FROM trips GROUP BY 1"),
    "monthly_report_kept": sql(
        f"SELECT {MONTH} AS pickup_month, COUNT(*) AS trip_count, " + ", ".join(
            [f"{mean(a)} AS avg_{a}" for a in AMOUNTS] + [f"{money(a)} AS total_{a}" for a in TOTALS])
        + " FROM bills GROUP BY 1"),
    "quantile_sketches": sql(" UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS probability, COUNT(fare_amount) AS row_count, TRUE AS within_bound "
        "FROM bills" for p in QUANTILES)),
    "distinct_sketches": sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_values, TRUE AS within_2_percent "
        "FROM bills" for c in DISTINCT)),
    "reconcile_lines": sql(
        "SELECT * FROM compared WHERE added > 0 OR removed > 0 OR repeated > 0", VERSIONS_SQL),
    "reconcile_summary": sql(
        "SELECT " + ", ".join(f"CAST(COALESCE(SUM({e}), 0) AS BIGINT) AS {n}" for n, e in {
            "rows_before": "copies_before", "rows_after": "copies_after",
            "kept": "LEAST(copies_before, copies_after)", "added": "added", "removed": "removed",
            "repeated": "repeated"}.items()) + " FROM compared", VERSIONS_SQL),
    "open_lines": sql(f"""
        SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, COUNT(*) AS open_lines,
          {money('fare_amount')} AS open_amount
        FROM orders o JOIN bills b ON b.customer_id = o.o_custkey
          AND b.pickup_datetime <= o.o_orderdate AND o.o_orderdate < b.dropoff_datetime
        GROUP BY ALL"""),
    "fare_subtotals": sql(f"""
        SELECT {MONTH} AS pickup_month, payment_type, VendorID,
          CAST(GROUPING({MONTH}, payment_type, VendorID) AS INTEGER) AS level,
          {mean('fare_amount')} AS avg_fare, {money('fare_amount')} AS total_fare, COUNT(*) AS trip_count
        FROM bills GROUP BY ROLLUP ({MONTH}, payment_type, VendorID)"""),
}
