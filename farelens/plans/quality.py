"""Gaps, duplicates, impossible rows and cleaning."""

from __future__ import annotations

from farelens.operators import cleaning, quality
from farelens.plans.sql_views import SECONDS, sql
from farelens.session import scratch_dir
from farelens.sources import documents_labels, line_charges, load_table, trips

KEY = ["l_orderkey", "l_linenumber"]
REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate"]
BOX = {"PULocationID": (20, 120), "DOLocationID": (10, 80), "trip_distance": (1.0, 7.5),
       "passenger_count": (1, 5)}
NUMERIC = ["trip_distance", "fare_amount", "tip_amount", "tolls_amount", "total_amount"]


def lines(spark, folder):
    return load_table(spark, folder, "lineitem")


def written_clean(spark, folder):
    return cleaning.write_clean(
        trips(spark, folder, with_dropoff=True), scratch_dir(spark, "clean-trips"))


QUERIES = {
    "null_counts": lambda spark, folder: quality.null_counts(documents_labels(spark, folder)),
    "null_nan_counts": lambda spark, folder: quality.null_nan_counts(
        trips(spark, folder, with_dropoff=True)),
    "missing_values": lambda spark, folder: quality.missing_values(
        documents_labels(spark, folder)),
    "dropna_subset": lambda spark, folder: cleaning.drop_missing(
        documents_labels(spark, folder), ["quality", "toxic"]),
    "duplicate_surplus": lambda spark, folder: quality.duplicate_surplus(lines(spark, folder), KEY),
    "duplicate_members": lambda spark, folder: quality.duplicate_members(lines(spark, folder), KEY),
    "distinct_rows": lambda spark, folder: cleaning.distinct_rows(lines(spark, folder)),
    "distinct_keys": lambda spark, folder: cleaning.distinct_rows(
        lines(spark, folder).select(*KEY)),
    "dedup_by_key": lambda spark, folder: cleaning.dedup_by_key(lines(spark, folder), KEY),
    "invalid_count": lambda spark, folder: quality.invalid_count(trips(spark, folder)),
    "invalid_balance_count": lambda spark, folder: quality.invalid_count(
        load_table(spark, folder, "customer"), ["c_acctbal"]),
    "filter_positive": lambda spark, folder: cleaning.keep_positive(trips(spark, folder)),
    "filter_open_range": lambda spark, folder: cleaning.keep_open_range(
        trips(spark, folder), "fare_amount", 0, 500),
    "filter_between": lambda spark, folder: cleaning.keep_between(trips(spark, folder), BOX),
    "filter_duration": lambda spark, folder: cleaning.keep_duration(
        trips(spark, folder, with_dropoff=True)),
    "clean_rules": lambda spark, folder: cleaning.rule_report(
        trips(spark, folder, with_dropoff=True)),
    "data_quality_funnel": lambda spark, folder: cleaning.cleaning_funnel(
        trips(spark, folder, with_dropoff=True)),
    "funnel_while_writing": lambda spark, folder: written_clean(spark, folder)[0],
    "nulls_while_writing": lambda spark, folder: written_clean(spark, folder)[1],
    "dataset_overview": lambda spark, folder: quality.dataset_overview(trips(spark, folder)),
    "describe_numeric": lambda spark, folder: quality.describe_numeric(
        line_charges(spark, folder), NUMERIC),
}

LABELED_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
TRIP_COLUMNS = [
    "trip_id", "VendorID", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type",
    "fare_amount"]
FLOATS = {"trip_distance", "fare_amount"}
RULES = {
    "Remove invalid fares (<=0 or >=200)": "fare_amount > 0 AND fare_amount < 200",
    "Remove invalid distance (<=0 or >=100)": "trip_distance > 0 AND trip_distance < 100",
    "Remove invalid passenger count": "passenger_count BETWEEN 1 AND 6",
    "Remove invalid duration (<30s or >2h)": f"{SECONDS} BETWEEN 30 AND 7200",
}


def _funnel_sql() -> str:
    steps, kept = [("Raw Ingestion", "TRUE")], "TRUE"
    for name, rule in RULES.items():
        kept = f"{kept} AND COALESCE({rule}, FALSE)"
        steps.append((name, kept))
    rows = " UNION ALL ".join(
        f"SELECT {place} AS place, '{name}' AS Step, COUNT(*) FILTER (WHERE {rule}) AS Records "
        "FROM trips" for place, (name, rule) in enumerate(steps))
    return sql("SELECT Step, Records, COALESCE(LAG(Records) OVER (ORDER BY place) - Records, 0) "
               f"AS Removed FROM ({rows})")


def _overview_sql() -> str:
    names = [c for c in TRIP_COLUMNS if c != "dropoff_datetime"]
    gaps = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in names)
    values = {
        "Total Records": "COUNT(*)",
        "Total Columns": f"MAX({len(names)})",
        "Missing Values": f"SUM({gaps})",
        "Duplicate Rows": f"COUNT(*) - COUNT(DISTINCT ({', '.join(names)}))",
        "Invalid Records": "COUNT(*) FILTER (WHERE trip_distance <= 0 OR fare_amount <= 0)",
    }
    return sql(" UNION ALL ".join(
        f"SELECT '{metric}' AS Metric, CAST({value} AS BIGINT) AS Value FROM trips"
        for metric, value in values.items()))


def _describe_sql() -> str:
    return sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS value_count, "
        f"ROUND(AVG({c}), 6) AS mean_value, ROUND(STDDEV_SAMP({c}), 6) AS stddev_value, "
        f"MIN({c}) AS min_value, MAX({c}) AS max_value FROM bills" for c in NUMERIC))


ORACLE = {
    "null_counts": sql("SELECT " + ", ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in LABELED_COLUMNS) + " FROM labeled"),
    "null_nan_counts": sql("SELECT " + ", ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL" + (f" OR isnan({c})" if c in FLOATS else "")
        + f") AS {c}" for c in TRIP_COLUMNS) + " FROM trips"),
    "missing_values": sql(
        'SELECT "Column", "Missing Count", ROUND(100.0 * "Missing Count" / total, 2) AS "Missing %" '
        "FROM (" + " UNION ALL ".join(
            f"SELECT '{c}' AS \"Column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS \"Missing Count\", "
            "COUNT(*) AS total FROM labeled" for c in LABELED_COLUMNS)
        + ') WHERE "Missing Count" > 0'),
    "dropna_subset": sql(
        "SELECT * FROM labeled WHERE quality IS NOT NULL AND toxic IS NOT NULL"),
    "duplicate_surplus":
        "SELECT CAST(COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) "
        "AS duplicate_rows FROM lineitem",
    "duplicate_members":
        "SELECT CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows FROM (SELECT COUNT(*) AS n "
        "FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)",
    "distinct_rows": "SELECT DISTINCT * FROM lineitem",
    "distinct_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "dedup_by_key":
        "SELECT * EXCLUDE (place) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, "
        "l_linenumber ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in REST)
        + ") AS place FROM lineitem) WHERE place = 1",
    "invalid_count": sql(
        "SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE trip_distance <= 0 OR "
        "fare_amount <= 0) AS invalid_rows FROM trips"),
    "invalid_balance_count":
        "SELECT COUNT(*) AS row_count, COUNT(*) FILTER (WHERE c_acctbal <= 0) AS invalid_rows "
        "FROM customer",
    "filter_positive": sql(
        "SELECT * EXCLUDE (dropoff_datetime) FROM trips WHERE trip_distance > 0 "
        "AND fare_amount > 0"),
    "filter_open_range": sql(
        "SELECT * EXCLUDE (dropoff_datetime) FROM trips WHERE fare_amount > 0 "
        "AND fare_amount < 500"),
    "filter_between": sql(
        "SELECT * EXCLUDE (dropoff_datetime) FROM trips WHERE " + " AND ".join(
            f"{c} BETWEEN {low} AND {high}" for c, (low, high) in BOX.items())),
    "filter_duration": sql(f"SELECT * FROM trips WHERE {SECONDS} BETWEEN 30 AND 7200"),
    "clean_rules": sql(" UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE {rule}) AS kept, "
        f"COUNT(*) - COUNT(*) FILTER (WHERE {rule}) AS failed FROM trips"
        for name, rule in RULES.items())),
    "data_quality_funnel": _funnel_sql(),
    "funnel_while_writing": _funnel_sql(),
    "nulls_while_writing": sql(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_rows, "
        "COUNT(*) AS row_count FROM trips" for c in TRIP_COLUMNS)),
    "dataset_overview": _overview_sql(),
    "describe_numeric": _describe_sql(),
}
