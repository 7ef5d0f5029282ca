"""The physical plans that the design counts on."""

import pytest
from pyspark.sql import functions as F

from farelens.operators import aggregates, cleaning
from farelens.plans import queries
from farelens.sources import TRIP_SCHEMA, canonical_trips, load_table, read_trips, trips


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plan") / "trips.parquet")
    spark.range(10).select(*[
        F.lit(None).cast(f.dataType).alias(f.name) for f in TRIP_SCHEMA]).write.parquet(path)
    return path


def test_filters_and_columns_reach_the_scan(spark, files):
    rows = cleaning.keep_open_range(cleaning.keep_positive(canonical_trips(read_trips(spark, files))))
    text = plan(aggregates.hourly_fare_volume(rows))
    for pushed in ("GreaterThan(trip_distance,0.0)", "GreaterThan(fare_amount,0.0)",
                   "LessThan(fare_amount,500.0)"):
        assert pushed in text
    assert ("ReadSchema: struct<tpep_pickup_datetime:timestamp_ntz,trip_distance:double,"
            "fare_amount:double>") in text


def test_time_of_next_event_is_not_computed_unless_asked(spark, small):
    assert "Window" not in plan(trips(spark, small))
    assert "Window" in plan(trips(spark, small, with_dropoff=True))


def test_dedup_combines_before_the_shuffle(spark, small):
    text = plan(cleaning.dedup_by_key(load_table(spark, small, "lineitem"), ["l_orderkey"]))
    assert "Window" not in text and "partial_min" in text


def test_median_shuffles_counts_only(spark, small):
    text = plan(queries()["median_threshold"](spark, small))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", [
    "hourly_fare_volume", "cost_analysis", "class_distribution", "boxplot_by_group", "kde_grid",
    "roc_auc", "stability_compare", "revenue_by_region"])
def test_no_cross_join_and_no_python(spark, small, name):
    text = plan(queries()[name](spark, small))
    for node in ("CartesianProduct", "NestedLoop", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in text
