import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farelens.functions import calendar, fares
from farelens.ml import evaluate
from farelens.operators import aggregates, profile, sampling
from farelens.operators.neighbours import next_in_key
from farelens.operators.quantiles import (
    exact_quantiles, median, ranged_totals, with_running_totals)
from farelens.sources import load_table, trips


def test_next_in_key_equals_plain_window(spark, small):
    """Also with a key of a third of all rows bunched in one second, with null keys, and
    with rows that share a moment."""
    events = load_table(spark, small, "events").select("event_id", "ts", "user_id").withColumns({
        "user_id": F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 7 != 0, F.col("user_id")),
        "ts": F.when(F.col("event_id") % 3 == 0, F.expr(
            "TIMESTAMP_NTZ'2024-01-05 10:00:00' + make_dt_interval(0, 0, 0, event_id % 50 / 100.0)"))
        .when(F.col("event_id") % 11 == 0, F.date_trunc("day", "ts")).otherwise(F.col("ts"))})
    plain = events.withColumn("next", F.lead("ts").over(
        Window.partitionBy("user_id").orderBy("ts", "event_id")))
    found = next_in_key(events, "user_id", "ts", "event_id", "next")
    assert plain.exceptAll(found).count() == 0 and found.count() == plain.count()


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 3.0, float("nan"), float("nan")], [float("-inf"), 1.0, float("inf")],
    [float("inf")] * 3 + [0.0], [0.0, -0.0, 5.0]])
def test_quantiles_equal_percentile(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for p in (0.25, 0.5, 1.0):
        expected = df.agg(F.percentile("v", p)).first()[0]
        found = exact_quantiles(df, "v", {"p": p}).first()[0]
        assert found == expected or (found != found and expected != expected)


def test_clustered_values_spread_over_tasks(spark):
    df = spark.range(20_000).select((1 - F.col("id") / 2e8).alias("v"), F.lit(1).alias("n"))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # so few rows would be one partition
    try:
        ranked = ranged_totals(df, "v", ["n"])
        sizes = [r["count"] for r in ranked.groupBy("_part").count().collect()]
    finally:
        spark.conf.unset(merging)
    assert len(sizes) > 1 and max(sizes) < 15_000


def test_quantiles_equal_sorted_list(spark):
    random.seed(3)
    values = [round(random.uniform(-50, 400), 2) for _ in range(301)] + [33.3] * 150 + [None] * 5
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "v DOUBLE, g INT")
    known = [v for v in values if v is not None]
    assert median(df, "v").first()[0] == pytest.approx(statistics.median(known))
    by_group = {r.g: r for r in exact_quantiles(
        df, "v", {"q1": 0.25, "q3": 0.75}, ["g"]).collect()}
    for g in range(3):
        part = [v for i, v in enumerate(values) if i % 3 == g and v is not None]
        q1, _, q3 = statistics.quantiles(part, n=4, method="inclusive")
        assert (by_group[g].q1, by_group[g].q3) == (pytest.approx(q1), pytest.approx(q3))


def test_median_of_even_count_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v DOUBLE")
    assert median(df, "v").first()[0] == 2.5
    assert median(df.where("false"), "v").first()[0] is None


def test_running_totals(spark):
    df = spark.createDataFrame([(float(i), i) for i in range(200)], "v DOUBLE, n INT")
    rows = with_running_totals(df, "v", ["n"], descending=True).collect()
    assert all(r.n_before == sum(range(r.n + 1, 200)) and r.n_total == 19900 for r in rows)


def test_clock_change(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-03-09 01:50:00' AS pickup_datetime, "
                   "TIMESTAMP_NTZ'2025-03-09 03:10:00' AS dropoff_datetime")
    assert df.select(calendar.duration_seconds()).first()[0] == 4800.0
    assert df.select(calendar.elapsed_seconds("America/New_York")).first()[0] == 1200.0


def test_speed_at_zero_seconds_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 1800.0)], "trip_distance DOUBLE, trip_duration DOUBLE")
    assert [r[0] for r in df.select(calendar.speed_mph()).collect()] == [None, 10.0]


def test_fare_labels(spark):
    values = [0.0, 9.99, 10.0, 25.0, 49.99, 50.0, -1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "fare_amount DOUBLE")
    assert [r[0] for r in df.select(fares.fare_category()).collect()] == [
        "Low", "Low", "Medium", "High", "High", "Premium", None, None]
    ranges = aggregates.fare_distribution(spark.createDataFrame(
        [(10.0,), (14.99,), (99.99,), (100.0,), (0.0,)], "fare_amount DOUBLE")).collect()
    assert [(r["fare_range"], r["count"]) for r in ranges] == [("$10-$15", 2), ("$95-$100", 1)]


def test_class_shares_sum_to_100(spark, small):
    rows = trips(spark, small).withColumn("Fare_Class", fares.fare_class(12.8))
    found = aggregates.class_distribution(rows).collect()
    assert sum(r["count"] for r in found) == 1000
    assert sum(r.Percentage for r in found) == pytest.approx(100)


def test_histogram_counts_every_row(spark, small):
    rows = trips(spark, small)
    assert profile.histogram_equal_width(rows, "fare_amount", 50).agg(
        F.sum("row_count")).first()[0] == 1000
    same = spark.createDataFrame([(4.0,), (4.0,)], "v DOUBLE")
    assert [(r.bin, r.row_count) for r in
            profile.histogram_equal_width(same, "v", 10).collect()] == [(0, 2)]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_split_and_folds_ignore_layout(spark, small, parts):
    events = load_table(spark, small, "events").select("event_id")
    train, test = sampling.train_test_split(events.repartition(parts), "event_id")
    reference, _ = sampling.train_test_split(events, "event_id")
    assert train.exceptAll(reference).count() == 0
    assert train.count() + test.count() == events.count()
    assert train.intersect(test).count() == 0
    sizes = sampling.with_fold(events, "event_id", 3).groupBy("fold").count().collect()
    assert sorted(r.fold for r in sizes) == [0, 1, 2]
    tenth = sampling.hash_sample(events, "event_id", 0.1)
    fifth = sampling.hash_sample(events, "event_id", 0.2)
    assert tenth.exceptAll(fifth).count() == 0


def test_metric_identities(spark):
    confusion = spark.createDataFrame(
        [(1612131, 1782684, 10183, 125671)], "TP BIGINT, TN BIGINT, FP BIGINT, FN BIGINT")
    row = evaluate.classification_metrics(confusion).first()
    assert [round(row[c], 4) for c in ("accuracy", "precision", "recall", "f1", "specificity",
                                       "sensitivity", "fpr", "fnr")] == [
        0.9615, 0.9635, 0.9615, 0.9615, 0.9943, 0.9277, 0.0057, 0.0723]


def test_r2_without_variance_is_null(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "label DOUBLE, prediction DOUBLE")
    row = evaluate.regression_metrics(df).first()
    assert row.rmse ** 2 == row.mse == 1.0 and row.r2 is None


def test_areas_equal_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    random.seed(5)
    rows = [(float(random.random() < 0.4), round(random.random(), 2)) for _ in range(800)]
    df = spark.createDataFrame(rows, "label DOUBLE, score DOUBLE")
    found = evaluate.curve_areas(df).first()
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert found.roc_auc == pytest.approx(judge.evaluate(df), abs=1e-8)
    assert found.pr_auc == pytest.approx(
        judge.evaluate(df, {judge.metricName: "areaUnderPR"}), abs=1e-8)
    points = evaluate.roc_curve(df).orderBy("fpr", "tpr").collect()
    assert (points[0].fpr, points[0].tpr) == (0, 0) and (points[-1].fpr, points[-1].tpr) == (1, 1)


def test_ranges_of_ranks_stay_small(spark):
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
                "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32",
                "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        scores = spark.range(3_000_000).select((F.xxhash64("id") / 2.0 ** 63).alias("v"), F.lit(1).alias("n"))
        ranked = ranged_totals(scores, "v", ["n"])
        sizes = [r["count"] for r in ranked.groupBy("_part").count().collect()]
        assert sum(sizes) == 3_000_000 and max(sizes) < 1_500_000
        assert ranked.agg(F.count_distinct("n_before"), F.max("n_before")).first()[:] == (3_000_000, 2_999_999)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
