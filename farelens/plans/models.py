"""Encoders, fitted models, searches and their explanation."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.functions.calendar import with_trip_features
from farelens.functions.keys import row_key
from farelens.ml import evaluate, explain, scenarios, stability
from farelens.ml import train as training
from farelens.ml.features import (
    FARE_CLASS, TRIP_ONLY, FeatureSet, feature_pipeline, frequency_index, missing_inputs, slot_names)
from farelens.plans.sql_views import HOUR, SECONDS, sql
from farelens.sources import bills, line_charges, trips
from farelens.sources.inventory import input_bytes

# The total of a bill follows from its price and terms, so the price joins the trip features.
BILL_TOTAL = FeatureSet(
    numeric=(*TRIP_ONLY.numeric, "fare_amount", "tip_amount", "tolls_amount"),
    one_hot=TRIP_ONLY.one_hot)
TRIP_ENCODED = FeatureSet(
    numeric=("passenger_count", "trip_distance", "trip_duration", "pickup_hour"),
    one_hot=("VendorID", "store_and_fwd_flag"))

TRIP_INDEXED = FeatureSet(
    numeric=("passenger_count", "trip_distance", "trip_duration", "pickup_hour", "pickup_day",
             "pickup_month"),
    indexed=("payment_type", "PULocationID", "DOLocationID"), scaled=False)


# --- encoders -------------------------------------------------------------------------

def string_index(spark: SparkSession, folder: str) -> DataFrame:
    """Zones are users here and grow with the data, so their index is a table."""
    rows = trips(spark, folder).select("trip_id", "payment_type", "PULocationID")
    for column in ("payment_type", "PULocationID"):
        rows = rows.join(frequency_index(rows, column), column, "left")
    return rows.select("trip_id", "payment_type", "PULocationID", "payment_type_idx", "PULocationID_idx")


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    rows = trips(spark, folder).select("trip_id", "payment_type")
    encoded = feature_pipeline(
        FeatureSet(numeric=(), one_hot=("payment_type",), scaled=False)).fit(rows).transform(rows)
    slots = vector_to_array("features")
    return encoded.select("trip_id", *[slots[i].alias(f"slot_{i}") for i in range(5)])


def assemble_skip(spark: SparkSession, folder: str) -> DataFrame:
    """Rows the assembler keeps and leaves out for missing inputs."""
    rows = with_trip_features(trips(spark, folder, with_dropoff=True))
    inputs = ["trip_distance", "trip_duration"]
    assembled = VectorAssembler(inputCols=inputs, outputCol="v", handleInvalid="skip").transform(
        rows.select(*inputs))
    survivors = assembled.agg(F.count("*").alias("assembled_rows"))
    return missing_inputs(rows, inputs).select("*", survivors.scalar().alias("assembled_rows"))


def _scaled(rows: DataFrame, features: FeatureSet, key: str) -> DataFrame:
    encoded = feature_pipeline(features).fit(rows).transform(rows)
    slots = vector_to_array("features")
    width = len(slot_names(encoded))
    return encoded.select(key, *[F.round(slots[i], 6).alias(f"f{i}") for i in range(width)])


def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    return _scaled(trips(spark, folder),
                   FeatureSet(numeric=("trip_distance", "fare_amount")), "trip_id")


def prepare_features(spark: SparkSession, folder: str) -> DataFrame:
    """Derive, index, one-hot, assemble and scale."""
    return _scaled(with_trip_features(trips(spark, folder, with_dropoff=True)),
                   TRIP_ENCODED, "trip_id")


def linreg_fit(spark: SparkSession, folder: str) -> DataFrame:
    rows = VectorAssembler(inputCols=["fare_amount"], outputCol="features").transform(
        line_charges(spark, folder)).select("features", F.col("total_amount").alias("label"))
    model = training.regressor("linear_regression", solver="normal").fit(rows)
    weights = explain.coefficients(spark, ["fare_amount"], model)
    return weights.select(
        "feature", F.round("coefficient", 6).alias("coefficient"),
        F.round(F.lit(model.intercept), 4).alias("intercept"),
        F.round(F.lit(model.summary.r2), 6).alias("r2"))


# --- regression -----------------------------------------------------------------------

def _partitions(spark: SparkSession, folder: str) -> int:
    size = input_bytes(spark, f"{folder}/lineitem.parquet", f"{folder}/orders.parquet")
    return training.training_partitions(spark.range(1), size)


def bill_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_trip_features(bills(spark, folder))
    return rows.withColumn("bill_key", row_key(
        rows, ["l_orderkey", "l_linenumber", "DOLocationID", "PULocationID", "fare_amount"]))


def prepared_totals(spark: SparkSession, folder: str) -> training.Prepared:
    return training.prepare(
        bill_rows(spark, folder), BILL_TOTAL, "total_amount", "bill_key",
        partitions=_partitions(spark, folder))


def fit_regressor(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        data = prepared_totals(spark, folder).cached()
        try:
            model, _ = training.timed_fit(training.regressor(name), data.train)
        finally:
            data.release()
        return evaluate.regression_metrics(model.transform(data.test)).select(
            F.lit(name).alias("model"), "*")
    return query


def reg_tree_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """A tree on indexed zones: more categories than the default bins."""
    rows = with_trip_features(trips(spark, folder, with_dropoff=True))
    size = input_bytes(spark, f"{folder}/events.parquet")
    data = training.prepare(
        rows, TRIP_INDEXED, "fare_amount", "trip_id",
        partitions=training.training_partitions(rows, size)).cached()
    tree = training.with_bins(training.regressor("decision_tree", maxDepth=5, seed=42), data.bins)
    try:
        model, _ = training.timed_fit(tree, data.train)
    finally:
        data.release()
    return evaluate.regression_metrics(model.transform(data.test)).select(
        F.lit(data.bins).alias("bins"), "*")


def cv_search(name: str, grid: str = "quick", folds: int = 3):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        data = prepared_totals(spark, folder).cached()
        estimator = training.regressor(name)
        try:
            found = training.cross_validate(
                data.train, estimator,
                training.param_grid(estimator, training.GRIDS[grid][name]), folds)
        finally:
            data.release()
        return evaluate.regression_metrics(found.best_model.transform(data.test)).select(
            F.lit(name).alias("model"), F.lit(str(found.best_params)).alias("params"), "*")
    return query


def topk_features(spark: SparkSession, folder: str) -> DataFrame:
    data = prepared_totals(spark, folder).cached()
    try:
        model = training.regressor("decision_tree").fit(data.train)
    finally:
        data.release()
    names = slot_names(data.pipeline.transform(data.raw_test))
    return explain.top_features(explain.importances(spark, names, model), 15)


def feature_name_map(spark: SparkSession, folder: str) -> DataFrame:
    data = prepared_totals(spark, folder).cached()
    try:
        model = training.regressor("linear_regression").fit(data.train)
    finally:
        data.release()
    names = slot_names(data.pipeline.transform(data.raw_test))
    return explain.coefficients(spark, names, model)


# --- classification -------------------------------------------------------------------

def prepared_classes(spark: SparkSession, folder: str) -> training.Prepared:
    """Fare classes by the training rows' median fare."""
    rows = bill_rows(spark, folder).drop("payment_type").withColumnRenamed(
        "payment_code", "payment_type")
    return training.prepare(
        rows, FARE_CLASS, "fare_amount", "bill_key", partitions=_partitions(spark, folder),
        relabel=training.above_median)


def fit_classifier(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        data = prepared_classes(spark, folder).cached()
        try:
            model, seconds = training.timed_fit(training.classifier(name), data.train)
        finally:
            data.release()
        return training.class_report(model, data.test, name, seconds).drop("train_seconds")
    return query


# --- stability ------------------------------------------------------------------------

SCENARIO_MODELS = ("logistic_regression", "decision_tree")
MOVED = ("trip_distance", "tip_amount", "tolls_amount")


def stability_reduction(spark: SparkSession, folder: str) -> DataFrame:
    """Refits on nested 90 % and 80 % samples of the training rows."""
    data = prepared_classes(spark, folder).cached()
    try:
        return scenarios.classifier_scenarios(data, SCENARIO_MODELS).drop("train_seconds")
    finally:
        data.release()


def stability_results(spark: SparkSession, folder: str) -> DataFrame:
    """The reductions, and the full model on noisy test rows."""
    data = prepared_classes(spark, folder).cached()
    try:
        return scenarios.classifier_scenarios(data, SCENARIO_MODELS, MOVED).drop("train_seconds")
    finally:
        data.release()


def model_noise(spark: SparkSession, folder: str) -> DataFrame:
    """A fitted regressor on normal noise and on a dropped feature, against its baseline."""
    data = prepared_totals(spark, folder).cached()
    try:
        model, _ = training.timed_fit(training.regressor("decision_tree"), data.train)
    finally:
        data.release()
    tests = scenarios.regressor_scenarios(data, list(BILL_TOTAL.numeric), 0.01, "pickup_hour")
    return stability.union_scenarios({
        name: evaluate.regression_metrics(model.transform(test)) for name, test in tests.items()})


QUERIES = {
    "string_index": string_index,
    "one_hot": one_hot,
    "assemble_skip": assemble_skip,
    "standard_scale": standard_scale,
    "prepare_features": prepare_features,
    "linreg_fit": linreg_fit,
    "reg_linear": fit_regressor("linear_regression"),
    "reg_tree": fit_regressor("decision_tree"),
    "reg_forest": fit_regressor("random_forest"),
    "reg_gbt": fit_regressor("gbt"),
    "reg_tree_indexed": reg_tree_indexed,
    "cv_search_linear": cv_search("linear_regression"),
    "cv_search_tree": cv_search("decision_tree"),
    "cv_search_forest": cv_search("random_forest"),
    "cv_search_gbt": cv_search("gbt"),
    "clf_logistic": fit_classifier("logistic_regression"),
    "clf_tree": fit_classifier("decision_tree"),
    "clf_forest": fit_classifier("random_forest"),
    "clf_gbt": fit_classifier("gbt"),
    "topk_features": topk_features,
    "feature_name_map": feature_name_map,
    "stability_reduction": stability_reduction,
    "stability_results": stability_results,
    "model_noise": model_noise,
}


def _index_sql(column: str) -> str:
    return (f"(SELECT {column}, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, "
            f"CAST({column} AS VARCHAR)) - 1 AS DOUBLE) AS {column}_idx FROM trips GROUP BY 1)")


def _z(column: str) -> str:
    return f"ROUND(({column} - AVG({column}) OVER ()) / STDDEV_SAMP({column}) OVER (), 6)"


ORACLE = {
    "string_index": sql(
        "SELECT trip_id, payment_type, PULocationID, payment_type_idx, PULocationID_idx "
        f"FROM trips JOIN {_index_sql('payment_type')} USING (payment_type) "
        f"JOIN {_index_sql('PULocationID')} USING (PULocationID)"),
    "one_hot": sql(
        "SELECT trip_id, " + ", ".join(
            f"CAST(payment_type_idx = {i} AS DOUBLE) AS slot_{i}" for i in range(5))
        + f" FROM trips JOIN {_index_sql('payment_type')} USING (payment_type)"),
    "assemble_skip": sql(
        f"SELECT COUNT(*) FILTER (WHERE {SECONDS} IS NOT NULL) AS kept_rows, "
        f"COUNT(*) FILTER (WHERE {SECONDS} IS NULL) AS dropped_rows, "
        f"COUNT({SECONDS}) AS assembled_rows FROM trips"),
    "standard_scale": sql(
        f"SELECT trip_id, {_z('trip_distance')} AS f0, {_z('fare_amount')} AS f1 FROM trips"),
    "prepare_features": sql(
        "SELECT trip_id, " + ", ".join(
            f"{_z(column)} AS f{i}" for i, column in enumerate(
                ["passenger_count", "trip_distance", "seconds", "pickup_hour",
                 "vendor_0", "vendor_1", "flag_0", "flag_1"]))
        + f" FROM (SELECT *, {SECONDS} AS seconds, {HOUR} AS pickup_hour, "
        "CAST(VendorID_idx = 0 AS DOUBLE) AS vendor_0, CAST(VendorID_idx = 1 AS DOUBLE) "
        "AS vendor_1, CAST(store_and_fwd_flag_idx = 0 AS DOUBLE) AS flag_0, "
        "CAST(store_and_fwd_flag_idx = 1 AS DOUBLE) AS flag_1 FROM trips "
        f"JOIN {_index_sql('VendorID')} USING (VendorID) "
        f"JOIN {_index_sql('store_and_fwd_flag')} USING (store_and_fwd_flag)) "
        "WHERE seconds IS NOT NULL"),
    "linreg_fit": sql(
        "SELECT 'fare_amount' AS feature, ROUND(regr_slope(total_amount, fare_amount), 6) "
        "AS coefficient, ROUND(regr_intercept(total_amount, fare_amount), 4) AS intercept, "
        "ROUND(regr_r2(total_amount, fare_amount), 6) AS r2 FROM bills"),
}
