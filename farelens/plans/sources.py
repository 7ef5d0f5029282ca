"""Scans, inspection and written results."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.ml import train as training
from farelens.ml.evaluate import regression_metrics
from farelens.ml.features import FeatureSet, fit_features
from farelens.operators import aggregates, cleaning, quality
from farelens.plans.sql_views import HOUR, mean, money, sql
from farelens.session import scratch_dir, stored
from farelens.sinks import files
from farelens.sources import bills, line_charges, load_table, read_paths, trips
from farelens.sources import inventory

NATION_KEYS = ("nation", "customer", "supplier")


def scan_multi(spark: SparkSession, folder: str) -> DataFrame:
    """Three tables in one scan under one declared schema, tagged by their file."""
    one_scan = read_paths(
        spark, *[f"{folder}/{name}.parquet" for name in NATION_KEYS],
        schema="n_nationkey INT, c_nationkey INT, s_nationkey INT")
    source = F.regexp_extract("_metadata.file_path", "/([a-z]+)[.]parquet", 1)
    key = F.coalesce("n_nationkey", "c_nationkey", "s_nationkey")
    return one_scan.groupBy(source.alias("source"), key.alias("nationkey")).agg(
        F.count("*").alias("row_count"))


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.file_inventory(
        spark, *[f"{folder}/{name}.parquet" for name in ("events", "lineitem", "orders")])


def preview_first20(spark: SparkSession, folder: str) -> DataFrame:
    return trips(spark, folder).orderBy("trip_id").limit(20)


def schema_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.schema_summary(load_table(spark, folder, "lineitem"))


def row_col_count(spark: SparkSession, folder: str) -> DataFrame:
    return quality.row_col_count(trips(spark, folder))


def project_cols(spark: SparkSession, folder: str) -> DataFrame:
    return trips(spark, folder).select("trip_id", "trip_distance", "fare_amount")


def sink_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    report = aggregates.hourly_fare_volume(trips(spark, folder))
    path = scratch_dir(spark, "hourly_fare_volume")
    files.write_csv(report, path)
    return files.read_csv(spark, path, report.schema)


def metrics_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_charges(spark, folder)
    metrics = regression_metrics(lines, "total_amount", "fare_amount").select(
        F.lit("flat").alias("model"), "*")
    path = scratch_dir(spark, "metrics")
    files.write_json(metrics, path)
    return files.read_json(spark, path, metrics.schema)


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a saved and reloaded pipeline and model against the originals."""
    lines = line_charges(spark, folder)
    pipeline = fit_features(
        lines, FeatureSet(numeric=("fare_amount", "tip_amount", "tolls_amount")))
    rows = pipeline.transform(lines).select("features", F.col("total_amount").alias("label"))
    model = training.regressor("linear_regression").fit(rows)
    path = scratch_dir(spark, "model")
    training.save_model(pipeline, f"{path}/pipeline")
    training.save_model(model, f"{path}/regressor")
    again = LinearRegressionModel.load(f"{path}/regressor")
    encoded = PipelineModel.load(f"{path}/pipeline").transform(lines)
    both = again.setPredictionCol("reloaded").transform(
        model.transform(encoded.select("features")))
    return both.agg(
        F.count("*").alias("row_count"),
        F.max(F.abs(F.col("prediction") - F.col("reloaded"))).alias("largest_difference"))


def export_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Write the CSV reports, then read every one of them back. Drop-offs are looked up once
    and lines meet their orders once, for all reports that need them."""
    all_trips = stored(trips(spark, folder, with_dropoff=True), "trips")
    by_month = stored(aggregates.monthly_totals(bills(spark, folder)), "months")
    reports = {
        "dataset_overview": quality.dataset_overview(trips(spark, folder)),
        "data_quality": cleaning.cleaning_funnel(all_trips),
        "missing_values": quality.missing_values(all_trips),
        "hourly_fare_volume": aggregates.hourly_fare_volume(trips(spark, folder)),
        "fare_distribution": aggregates.fare_distribution(trips(spark, folder)),
        **{name: aggregates.monthly_report(by_month, name) for name in aggregates.MONTHLY_REPORTS},
    }
    root = scratch_dir(spark, "exports")
    for name, report in reports.items():
        files.write_csv(report, f"{root}/{name}")
    return files.export_manifest(
        spark, {name: (f"{root}/{name}", report.schema) for name, report in reports.items()})


QUERIES = {
    "scan_multi": scan_multi,
    "file_inventory": file_inventory,
    "preview_first20": preview_first20,
    "schema_summary": schema_summary,
    "row_col_count": row_col_count,
    "project_cols": project_cols,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "metrics_json_roundtrip": metrics_json_roundtrip,
    "model_roundtrip": model_roundtrip,
    "export_manifest": export_manifest,
}

LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz"}

ORACLE = {
    "scan_multi": " UNION ALL ".join(
        f"SELECT '{table}' AS source, {key} AS nationkey, COUNT(*) AS row_count "
        f"FROM {table} GROUP BY {key}"
        for table, key in zip(NATION_KEYS, ("n_nationkey", "c_nationkey", "s_nationkey"))),
    "preview_first20": sql(
        "SELECT * EXCLUDE (dropoff_datetime) FROM trips ORDER BY trip_id LIMIT 20"),
    "schema_summary": " UNION ALL ".join(
        f"SELECT CAST({place} AS INTEGER) AS position, '{name}' AS column_name, "
        f"'{kind}' AS data_type, COUNT({name}) AS filled_rows FROM lineitem"
        for place, (name, kind) in enumerate(LINEITEM_TYPES.items(), start=1)),
    "row_col_count": sql(
        "SELECT COUNT(*) AS row_count, CAST(10 AS INTEGER) AS column_count FROM trips"),
    "project_cols": sql("SELECT trip_id, trip_distance, fare_amount FROM trips"),
    "sink_csv_roundtrip": sql(
        f"SELECT {HOUR} AS pickup_hour, {mean('fare_amount')} AS avg_fare, "
        f"{money('fare_amount')} AS total_revenue, COUNT(*) AS trip_count FROM trips GROUP BY 1"),
    "metrics_json_roundtrip": sql("""
        SELECT 'flat' AS model, ROUND(SQRT(AVG(e * e)), 6) AS rmse, ROUND(AVG(ABS(e)), 6) AS mae,
          ROUND(AVG(e * e), 6) AS mse, ROUND(1 - AVG(e * e) / VAR_POP(total_amount), 6) AS r2
        FROM (SELECT total_amount, total_amount - fare_amount AS e FROM bills)"""),
    "export_manifest": sql(" UNION ALL ".join(
        f"SELECT '{name}' AS report, TRUE AS header_ok, CAST({rows} AS BIGINT) AS row_count "
        f"FROM {view}" for name, (rows, view) in {
            "dataset_overview": ("5 + 0 * COUNT(*)", "trips"),
            "data_quality": ("5 + 0 * COUNT(*)", "trips"),
            "missing_values": ("COUNT(*) FILTER (WHERE dropoff_datetime IS NULL) > 0", "trips"),
            "hourly_fare_volume": ("COUNT(DISTINCT hour(pickup_datetime))", "trips"),
            "fare_distribution": (
                "COUNT(DISTINCT CASE WHEN fare_amount > 0 AND fare_amount < 100 "
                "THEN floor(fare_amount / 5) END)", "trips"),
            "cost_analysis": ("COUNT(DISTINCT month(pickup_datetime))", "bills"),
            "trip_behavior": ("COUNT(DISTINCT month(pickup_datetime))", "bills"),
            "monthly_fare_summary": ("COUNT(DISTINCT month(pickup_datetime))", "bills"),
        }.items())),
    "model_roundtrip":
        "SELECT COUNT(*) AS row_count, CAST(0 AS DOUBLE) AS largest_difference FROM lineitem",
}
