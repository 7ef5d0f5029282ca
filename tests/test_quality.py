from datetime import datetime

import pytest
from pyspark.sql import functions as F

from farelens.operators import cleaning, quality
from farelens.sources import NoInputFiles, SchemaMismatch, load_table, read_paths, trips
from farelens.sources.tables import conform, declare

NAN = float("nan")


def first(df):
    return df.first().asDict()


def test_two_duplicate_counts(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", None), ("b", 1)], "k STRING, v INT")
    assert first(quality.duplicate_surplus(df)) == {"duplicate_rows": 2}
    assert first(quality.duplicate_members(df)) == {"duplicate_rows": 3}
    empty = df.where("false")
    assert first(quality.duplicate_surplus(empty)) == {"duplicate_rows": 0}
    assert first(quality.duplicate_members(empty)) == {"duplicate_rows": 0}


def test_nan_is_not_null(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, None), (NAN, "y")], "d DOUBLE, s STRING")
    assert first(quality.null_counts(df)) == {"d": 1, "s": 1}
    assert first(quality.null_nan_counts(df)) == {"d": 2, "s": 1}


def test_missing_values_lists_gaps_only(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None)], "full INT, gaps INT")
    assert [tuple(r) for r in quality.missing_values(df).collect()] == [("gaps", 2, 66.67)]


def test_open_range_is_strict(spark):
    fares = [-7.2, 0.0, 0.01, 99.99, 100.0, 200.0, 499.99, 500.0, None]
    df = spark.createDataFrame([(f,) for f in fares], "fare_amount DOUBLE")
    kept = [r[0] for r in cleaning.keep_open_range(df).collect()]
    assert kept == [0.01, 99.99, 100.0, 200.0, 499.99]


def trip(fare, distance, passengers, seconds):
    start = datetime(2025, 1, 1, 12)
    return (fare, distance, passengers, start,
            None if seconds is None else datetime.fromtimestamp(start.timestamp() + seconds))


TRIP = ("fare_amount DOUBLE, trip_distance DOUBLE, passenger_count BIGINT, "
        "pickup_datetime TIMESTAMP_NTZ, dropoff_datetime TIMESTAMP_NTZ")


def test_funnel_counts_each_step(spark):
    rows = [
        trip(10.0, 2.0, 1, 600), trip(200.0, 2.0, 1, 600), trip(0.0, 2.0, 1, 600),
        trip(10.0, 100.0, 1, 600), trip(10.0, 2.0, 0, 600), trip(10.0, 2.0, None, 600),
        trip(10.0, 2.0, 1, 29), trip(10.0, 2.0, 1, 30), trip(10.0, 2.0, 1, 7200),
        trip(10.0, 2.0, 1, 7201), trip(10.0, 2.0, 1, None)]
    df = spark.createDataFrame(rows, TRIP)
    steps = cleaning.cleaning_funnel(df).collect()
    assert [(r.Records, r.Removed) for r in steps] == [(11, 0), (9, 2), (8, 1), (6, 2), (3, 3)]
    assert cleaning.apply_rules(df).count() == 3
    assert cleaning.keep_duration(df).count() == 8


def test_funnel_of_nothing(spark):
    steps = cleaning.cleaning_funnel(spark.createDataFrame([], TRIP)).collect()
    assert {(r.Records, r.Removed) for r in steps} == {(0, 0)}


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dedup_does_not_depend_on_layout(spark, small, parts):
    lines = load_table(spark, small, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    once = cleaning.dedup_by_key(lines, key)
    again = cleaning.dedup_by_key(lines.repartition(parts), key)
    assert once.exceptAll(again).count() == 0 and once.count() == again.count()
    assert once.select(*key).distinct().count() == once.count()


def test_schema_problems_have_names(spark, small):
    with pytest.raises(NoInputFiles):
        read_paths(spark, f"{small}/no-such-*.parquet")
    with pytest.raises(SchemaMismatch):
        conform(spark.range(1), declare("fare_amount DOUBLE"))
    assert conform(spark.range(1).select(F.lit(1).alias("n")), declare("n BIGINT")).dtypes == [
        ("n", "bigint")]


def test_trip_counts(spark, small, medium):
    for folder, rows, no_end, no_distance, no_passenger in (
            (small, 1000, 15, 14, 138), (medium, 10000, 150, 93, 1486)):
        found = trips(spark, folder, with_dropoff=True).agg(
            F.count("*"), F.count_if(F.col("dropoff_datetime").isNull()),
            F.count_if(F.col("trip_distance") == 0), F.count_if(F.col("passenger_count") == 0))
        assert tuple(found.first()) == (rows, no_end, no_distance, no_passenger)
