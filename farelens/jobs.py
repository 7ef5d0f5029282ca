"""Whole jobs over trip files: reports, regressors, classifiers.

    python -m farelens.jobs reports  --trips 'data/tripdata_*.parquet' --out exports
    python -m farelens.jobs regress  --trips ... --out models --sample 0.01
    python -m farelens.jobs classify --trips ... --out models
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens import perf
from farelens.functions.calendar import duration_seconds, with_trip_features
from farelens.functions.fares import fare_class
from farelens.functions.keys import row_key
from farelens.ml import evaluate, explain, scenarios
from farelens.ml import train as training
from farelens.ml.features import (
    CALENDAR_ONLY, FARE_CLASS, TRIP_ONLY, WITH_CHARGES, FeatureSet, slot_names)
from farelens.operators import aggregates, cleaning, insights, quality, ranking, sampling
from farelens.operators.quantiles import median
from farelens.session import build_session, remove_scratch, size_shuffles
from farelens.sinks import files
from farelens.sources import canonical_trips, read_trips
from farelens.sources.inventory import input_bytes

# fixed values: report column names
METRIC_NAMES = {
    "model": "Model", "accuracy": "Accuracy", "precision": "Precision", "recall": "Recall",
    "f1": "F1 Score", "roc_auc": "ROC-AUC", "pr_auc": "PR-AUC", "specificity": "Specificity",
    "sensitivity": "Sensitivity", "fpr": "FPR", "fnr": "FNR", "TP": "TP", "TN": "TN", "FP": "FP",
    "FN": "FN", "train_seconds": "Training Time (s)"}
STABILITY_NAMES = {
    "scenario": "Scenario", "model": "Model", "accuracy": "Accuracy", "precision": "Precision",
    "recall": "Recall", "f1": "F1", "roc_auc": "ROC-AUC", "train_seconds": "Time (s)"}


FEATURE_SETS = {"trip": TRIP_ONLY, "calendar": CALENDAR_ONLY, "charges": WITH_CHARGES}
NOISY = ("trip_distance", "tip_amount", "tolls_amount")


def business_trips(trips: DataFrame) -> DataFrame:
    """The rows the business reports count: plausible fare and distance, over half a minute."""
    return cleaning.keep_open_range(cleaning.keep_positive(trips)).where(
        duration_seconds() / 60.0 > 0.5)


def with_class(trips: DataFrame, threshold: float | None = None) -> DataFrame:
    """``Fare_Class`` by a given threshold, else by the rows' own median."""
    cut = F.lit(threshold) if threshold is not None else median(trips, "fare_amount").scalar()
    return trips.withColumn("Fare_Class", fare_class(cut))


def report_tables(trips: DataFrame) -> dict[str, DataFrame]:
    """Every report that needs no model, by file name."""
    business = business_trips(trips)
    hourly = aggregates.hourly_fare_volume(business)
    return {
        "dataset_overview": quality.dataset_overview(trips),
        "data_quality": cleaning.cleaning_funnel(trips),
        "missing_values": quality.missing_values(trips),
        "class_distribution": aggregates.class_distribution(
            with_class(cleaning.apply_rules(trips))),
        "hourly_fare_volume": hourly,
        "hourly_fare_summary": hourly.withColumnRenamed("total_revenue", "total_fare"),
        "passenger_fare_summary": aggregates.fare_summary(business, "passenger_count"),
        "monthly_fare_summary": aggregates.monthly_fare_summary(business),
        "trip_behavior_analysis": aggregates.trip_behavior(business),
        "business_insights": insights.business_insights(business),
        "business_insights_revenue": aggregates.fare_summary(business, "PULocationID"),
        "cost_analysis": aggregates.cost_analysis(business),
        "fare_distribution": aggregates.fare_distribution(business),
    }


def export_reports(spark: SparkSession, trips: DataFrame, out: str,
                   more: dict[str, DataFrame] | None = None) -> DataFrame:
    """Write all reports as CSV and return the manifest read back from the files."""
    tables = {**report_tables(trips), **(more or {})}
    tables["execution_performance"] = perf.execution_performance(
        spark, business_trips(trips).select("pickup_datetime", "fare_amount", "payment_type"),
        {"hourly summary": aggregates.hourly_fare_volume,
         "payment summary": aggregates.payment_distribution})
    for name, table in tables.items():
        files.write_csv(table, f"{out}/{name}")
    return files.export_manifest(
        spark, {name: (f"{out}/{name}", table.schema) for name, table in tables.items()})


def _model_rows(trips: DataFrame) -> DataFrame:
    rows = cleaning.keep_positive(cleaning.distinct_rows(trips))
    rows = rows.withColumn("trip_key", row_key(trips))
    return with_trip_features(rows).where(F.col("trip_duration") > 0)


def train_regressors(spark: SparkSession, trips: DataFrame, out: str, grid: str = "quick",
                     folds: int = 3, partitions: int | None = None,
                     features: FeatureSet = TRIP_ONLY) -> DataFrame:
    """Search, fit, save and rank the four fare regressors; metrics also go to JSON."""
    data = training.prepare(
        _model_rows(trips), features, "fare_amount", "trip_key", folds,
        partitions or training.training_partitions(trips)).cached()
    training.save_model(data.pipeline, f"{out}/pipeline")
    rows = []
    try:
        for name in training.REGRESSORS:
            estimator = training.with_bins(training.regressor(name), data.bins)
            found = training.cross_validate(
                data.train, estimator,
                training.param_grid(estimator, training.GRIDS[grid][name]), folds)
            training.save_model(found.best_model, f"{out}/{name}")
            rows.append(evaluate.regression_metrics(found.best_model.transform(data.test)).select(
                F.lit(name).alias("model"), F.lit(found.seconds).alias("time"),
                F.lit(str(found.best_params)).alias("params"), "*"))
    finally:
        data.release()
    stored = _through_json(spark, reduce(DataFrame.unionByName, rows), f"{out}/regression_metrics")
    return ranking.rank_models(stored)


def _through_json(spark: SparkSession, table: DataFrame, path: str) -> DataFrame:
    """The stored metrics: read back, so that nothing is scored twice."""
    files.write_json(table, path)
    return files.read_json(spark, path, table.schema)


def train_classifiers(spark: SparkSession, trips: DataFrame, out: str,
                      partitions: int | None = None, features: FeatureSet = FARE_CLASS,
                      noise: float = 0.01) -> dict[str, DataFrame]:
    """Fit and save the four fare-class models; returns model_metrics,
    feature_importance and stability_results."""
    data = training.prepare(
        _model_rows(cleaning.apply_rules(trips)), features, "fare_amount", "trip_key",
        partitions=partitions or training.training_partitions(trips),
        relabel=training.above_median).cached()
    training.save_model(data.pipeline, f"{out}/pipeline")
    fitted, originals = {}, []
    try:
        for name in training.CLASSIFIERS:
            fitted[name], seconds = training.timed_fit(
                training.with_bins(training.classifier(name), data.bins), data.train)
            training.save_model(fitted[name], f"{out}/{name}")
            originals.append(training.class_report(fitted[name], data.test, name, seconds))
        disturbed = scenarios.classifier_scenarios(data, training.CLASSIFIERS, NOISY, noise, fitted)
    finally:
        data.release()
    metrics = _through_json(spark, reduce(DataFrame.unionByName, originals),
                            f"{out}/classification_metrics")
    results = _through_json(spark, disturbed, f"{out}/stability_metrics")
    best = metrics.where(F.col("model") != "logistic_regression").orderBy(
        F.desc("roc_auc"), "model").first()["model"]
    names = slot_names(data.pipeline.transform(data.raw_test))
    return {
        "model_metrics": metrics.select(
            *[F.col(c).alias(name) for c, name in METRIC_NAMES.items()]),
        "feature_importance": explain.importances(spark, names, fitted[best]).select(
            "feature", "importance").orderBy(F.desc("importance"), "feature"),
        "stability_results": results.select(
            *[F.col(c).alias(name) for c, name in STABILITY_NAMES.items()]),
    }


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["reports", "regress", "classify"])
    parser.add_argument("--trips", nargs="+", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--grid", choices=list(training.GRIDS), default="quick")
    parser.add_argument("--folds", type=int, default=3)
    parser.add_argument("--features", choices=list(FEATURE_SETS), default="trip")
    parser.add_argument("--sample", type=float, help="share of trips to train on")
    chosen = parser.parse_args(arguments)
    spark = build_session()
    given = input_bytes(spark, *chosen.trips)
    size_shuffles(spark, given)
    try:
        run_job(spark, chosen, given)
    finally:
        remove_scratch(spark)


def run_job(spark: SparkSession, chosen: argparse.Namespace, given: int) -> None:
    trips = canonical_trips(read_trips(spark, *chosen.trips))
    partitions = training.training_partitions(trips, given)
    if chosen.sample:
        trips = sampling.hash_sample(trips, row_key(trips), chosen.sample)
    if chosen.job == "reports":
        export_reports(spark, trips, chosen.out).show(50, truncate=False)
    elif chosen.job == "regress":
        train_regressors(spark, trips, chosen.out, chosen.grid, chosen.folds, partitions,
                         FEATURE_SETS[chosen.features]).show(truncate=False)
    else:
        tables = train_classifiers(spark, trips, chosen.out, partitions)
        for name, table in tables.items():
            files.write_csv(table, f"{chosen.out}/{name}")
        files.export_manifest(spark, {
            name: (f"{chosen.out}/{name}", table.schema) for name, table in tables.items()
        }).show(truncate=False)


if __name__ == "__main__":
    main()
