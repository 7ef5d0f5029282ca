import os

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from farelens import jobs
from farelens.functions.keys import row_key
from farelens.ml import explain, stability
from farelens.ml import train as training
from farelens.ml.features import FeatureSet, feature_pipeline, missing_inputs, slot_names
from farelens.plans import models, sources
from farelens.sinks import files
from farelens.sources import TRIP_SCHEMA, canonical_trips, read_trips, trips


@pytest.fixture(scope="module")
def monthly_files(spark, small, tmp_path_factory):
    """Events in the layout of two monthly trip files."""
    source = trips(spark, small, with_dropoff=True)
    known = {
        "tpep_pickup_datetime": F.col("pickup_datetime"),
        "tpep_dropoff_datetime": F.col("pickup_datetime") + F.make_dt_interval(
            mins=F.lit(1) + F.col("DOLocationID") % 90),
        "payment_type": F.length("payment_type").cast("bigint"),
        "RatecodeID": (F.col("trip_id") % 4 + 1).cast("bigint"),
        "trip_distance": F.col("trip_distance"),
        "fare_amount": F.round(3 + 2.5 * F.col("trip_distance") + F.col("fare_amount") % 5, 2),
        "total_amount": F.col("fare_amount") * 1.2,
    }
    columns = [known.get(f.name, F.col(f.name) if f.name in source.columns
                         else F.lit(1.0)).cast(f.dataType).alias(f.name) for f in TRIP_SCHEMA]
    folder = tmp_path_factory.mktemp("trips")
    rows = source.select(*columns, (F.col("trip_id") % 2).alias("part"))
    for part in (0, 1):
        rows.where(F.col("part") == part).drop("part").coalesce(1).write.parquet(
            f"{folder}/tripdata_2025-0{part + 1}.parquet")
    return f"{folder}/tripdata_2025-*.parquet"


@pytest.fixture(scope="module")
def taxi(spark, monthly_files):
    return canonical_trips(read_trips(spark, monthly_files))


def test_reports_job(spark, taxi, tmp_path):
    manifest = {r.report: r for r in jobs.export_reports(spark, taxi, str(tmp_path)).collect()}
    assert len(manifest) == 14 and all(r.header_ok for r in manifest.values())
    assert manifest["hourly_fare_volume"].row_count == 24
    assert manifest["business_insights"].row_count == 8
    funnel = [r for r in os.listdir(tmp_path / "data_quality") if r.endswith(".csv")]
    assert len(funnel) == 1


def test_regression_job(spark, taxi, tmp_path):
    ranked = jobs.train_regressors(spark, taxi, str(tmp_path), folds=2, partitions=4).collect()
    assert [r.model_rank for r in ranked] == sorted(r.model_rank for r in ranked)
    assert {r.model for r in ranked} == set(training.REGRESSORS)
    assert all(abs(r.rmse ** 2 - r.mse) < 1e-4 and r.r2 > 0.5 for r in ranked)
    assert set(os.listdir(tmp_path)) >= set(training.REGRESSORS) | {"pipeline"}


def test_classification_job(spark, taxi, tmp_path, monkeypatch):
    quick = {"logistic_regression": {"maxIter": 5}, "decision_tree": {"maxDepth": 4},
             "random_forest": {"numTrees": 4}, "gbt": {"maxIter": 3}}
    monkeypatch.setattr(training, "CLASSIFIER_SETTINGS", quick)
    tables = jobs.train_classifiers(spark, taxi, str(tmp_path), partitions=4)
    rows = tables["model_metrics"].collect()
    assert len(rows) == 4
    for r in rows:
        assert r["Sensitivity"] + r["FNR"] == pytest.approx(1, abs=1e-5)
        assert r["Specificity"] + r["FPR"] == pytest.approx(1, abs=1e-5)
    assert len({r["TP"] + r["TN"] + r["FP"] + r["FN"] for r in rows}) == 1
    importance = [r.importance for r in tables["feature_importance"].collect()]
    assert len(importance) == 19 and min(importance) >= 0
    assert sum(importance) == pytest.approx(1)
    scenarios = tables["stability_results"].groupBy("Scenario").count().collect()
    assert {(r.Scenario, r["count"]) for r in scenarios} == {
        ("Original", 4), ("90% Data", 4), ("80% Data", 4), ("Noise Injection", 4)}


def test_unseen_and_missing_categories_share_an_index(spark):
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "c STRING")
    fitted = feature_pipeline(FeatureSet((), indexed=("c",), scaled=False)).fit(seen)
    new = spark.createDataFrame([("b",), ("new",), (None,)], "c STRING")
    assert [r.c_idx for r in fitted.transform(new).collect()] == [1.0, 2.0, 2.0]


def test_skipped_rows_are_counted(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, None)], "a DOUBLE, b DOUBLE")
    assert tuple(missing_inputs(df, ["a", "b"]).first()) == (1, 2)
    fitted = feature_pipeline(FeatureSet(("a", "b"), scaled=False)).fit(df)
    assert fitted.transform(df).count() == 1


def test_slot_names_follow_the_vector(spark):
    df = spark.createDataFrame([(1.0, "x"), (2.0, "y"), (3.0, "x")], "a DOUBLE, c STRING")
    encoded = feature_pipeline(FeatureSet(("a",), one_hot=("c",))).fit(df).transform(df)
    assert slot_names(encoded) == ["a", "c_vec_x", "c_vec_y"]
    assert len(encoded.first()["features"]) == 3
    with pytest.raises(ValueError):
        explain.feature_weights(spark, ["a"], [1.0, 2.0], "w")


def test_grid_search_refits_the_best(spark, small):
    data = models.prepared_totals(spark, small).cached()
    estimator = training.regressor("decision_tree")
    grid = training.param_grid(estimator, {"maxDepth": [1, 4]})
    found = training.cross_validate(data.train, estimator, grid, folds=3)
    data.release()
    assert len(grid) == 2 and found.best_params == {"maxDepth": 4}
    assert found.best_model.depth == 4
    assert min(score for _, score in found.scores) == dict(
        (str(p), s) for p, s in found.scores)[str(found.best_params)]


def test_noise_and_dropout(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)], "k BIGINT, v DOUBLE")
    spread = df.agg(F.stddev("v")).first()[0]
    moved = stability.with_noise(df.withColumn("base", F.col("v")), ["v"], 0.1, "k")
    widest = moved.agg(F.max(F.abs(F.col("v") - F.col("base")))).first()[0]
    assert 0 < widest <= 0.1 * spread + 1e-9
    elsewhere = stability.with_noise(df.repartition(7), ["v"], 0.1, "k")
    same = moved.join(elsewhere.withColumnRenamed("v", "w"), "k")
    assert same.agg(F.max(F.abs(F.col("v") - F.col("w")))).first()[0] < 1e-9
    assert stability.with_dropout(df, "v").agg(F.max("v")).first()[0] == 0.0


def test_compare_to_baseline_with_zero_base(spark):
    metrics = spark.createDataFrame(
        [("baseline", "a", 2.0, 0.0), ("noise", "a", 2.2, 0.5), ("baseline", "b", 2.0, 0.5),
         ("noise", "b", 2.5, 0.4)], "scenario STRING, model STRING, rmse DOUBLE, r2 DOUBLE")
    rows = {r.model: r for r in stability.compare_to_baseline(metrics).collect()}
    assert (rows["a"].rmse_change, rows["a"].r2_change, rows["a"].stability) == (10.0, None, "Medium")
    assert (rows["b"].rmse_change, rows["b"].r2_change, rows["b"].stability) == (25.0, -20.0, "Low")


def test_json_falls_back(spark, tmp_path):
    spare = spark.createDataFrame([("m", 1.0)], "model STRING, rmse DOUBLE")
    assert files.read_json(spark, f"{tmp_path}/none", spare.schema, spare).first().model == "m"


def test_row_key_is_stable(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "n INT, s STRING")
    assert df.select(row_key(df)).distinct().count() == 2


def test_classifiers_score_after_an_observation(spark):
    seen = Observation()
    numbers = spark.range(200).select(
        (F.col("id") % 2).cast("double").alias("side"), (F.col("id") % 10 < 6).cast("double").alias("label"))
    numbers.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 200}
    rows = VectorAssembler(inputCols=["side"], outputCol="features").transform(numbers)
    for name, settings in (("logistic_regression", {"maxIter": 5}), ("random_forest", {"numTrees": 2})):
        fitted, seconds = training.timed_fit(training.classifier(name, **settings), rows)
        report = training.class_report(fitted, rows, name, seconds).first()
        assert report["TP"] + report["TN"] + report["FP"] + report["FN"] == 200


def test_training_tasks_stay_small_and_ensembles_have_few(spark):
    cores = spark.sparkContext.defaultParallelism
    assert training.training_partitions(spark.range(1), 4 << 30) == max(cores, 512)
    wide = spark.range(0, 1000, 1, 8 * cores)
    assert training.for_fit(training.regressor("gbt"), wide).rdd.getNumPartitions() == 4 * cores
    assert training.for_fit(training.regressor("decision_tree"), wide).rdd.getNumPartitions() == 8 * cores


def test_training_rows_are_encoded_once(spark, small):
    data = models.prepared_totals(spark, small)
    assert data.encoded.storageLevel.useMemory
    held = data.train.agg(F.count("*"))._jdf.queryExecution().withCachedData().toString()
    assert "InMemoryRelation" in held
    expected = data.pipeline.transform(data.raw_train).select("row_key", "features").collect()
    found = data.train.select("row_key", "features").collect()
    assert sorted((r[0], list(r[1])) for r in found) == sorted((r[0], list(r[1])) for r in expected)
    data.release()
    assert not data.encoded.storageLevel.useMemory


def test_boosted_search_fits_only_the_longest(spark, small, monkeypatch):
    data = models.prepared_totals(spark, small).cached()
    estimator = training.regressor("gbt", maxDepth=2, seed=42)
    grid = training.param_grid(estimator, {"maxIter": [2, 5], "maxDepth": [2, 3]})
    asked, fit_multiple = [], type(estimator).fitMultiple
    monkeypatch.setattr(type(estimator), "fitMultiple", lambda self, rows, points: (
        asked.append(len(points)), fit_multiple(self, rows, points))[1])
    found = training.cross_validate(data.train, estimator, grid, folds=2)
    assert asked == [2, 2]
    for point, (named, score) in zip(grid, found.scores):
        apart = 0.0
        for fold in range(2):
            rows = training.for_fit(estimator, data.train.where(F.col("fold") != fold))
            scored = estimator.fit(rows, point).transform(data.train.where(F.col("fold") == fold))
            apart += scored.agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0] / 2
        assert score == pytest.approx(apart, rel=1e-9), named
    data.release()
    assert found.best_model.getNumTrees == found.best_params["maxIter"]


def test_model_roundtrip_predicts_the_same(spark, tmp_path):
    spark.range(1, 41).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "CAST(id % 5 + 1 AS INT) AS l_linenumber",
        "CAST(id % 7 AS DOUBLE) AS l_quantity", "100.0D + id AS l_extendedprice",
        "CAST(id % 3 AS DOUBLE) / 100 AS l_discount", "CAST(id % 4 AS DOUBLE) / 100 AS l_tax",
        "'A' AS l_returnflag", "'F' AS l_linestatus", "TIMESTAMP_NTZ'2024-01-01' AS l_shipdate"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert tuple(sources.model_roundtrip(spark, str(tmp_path)).first()) == (40, 0.0)


def test_encoded_rows_are_cached_in_small_batches(spark, small):
    spark.conf.unset("spark.sql.inMemoryColumnarStorage.batchSize")
    data = models.prepared_totals(spark, small)
    level = data.encoded.storageLevel
    assert level.useMemory and level.useDisk and level.deserialized
    assert int(spark.conf.get("spark.sql.inMemoryColumnarStorage.batchSize")) == 1_000
    data.release()


def test_a_task_of_an_ensemble_takes_four_partitions_at_most(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, 40 * cores)
    for estimator in (training.classifier("gbt"), training.classifier("random_forest")):
        assert training.for_fit(estimator, many).rdd.getNumPartitions() == 10 * cores


def test_models_that_fill_the_cores_are_fitted_one_at_a_time(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    at_once = [training.fits_at_once(spark.range(0, 1000, 1, n), 4) for n in (1, cores, 2 * cores, 4 * cores, 50 * cores)]
    assert at_once == [4, 4, 2, 1, 1]
    estimator = training.regressor("decision_tree")
    grid = training.param_grid(estimator, {"maxDepth": [1, 2]})
    pools, pool = [], training.ThreadPool
    monkeypatch.setattr(training, "ThreadPool", lambda n: (pools.append(n), pool(n))[1])
    wide = spark.createDataFrame(
        [(float(i), float(i % 7), i % 2) for i in range(200)], "x DOUBLE, label DOUBLE, fold INT")
    wide = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame(wide.rdd.repartition(4 * cores), wide.schema))
    training.cross_validate(wide, estimator, grid, folds=2)
    assert pools == [1]
