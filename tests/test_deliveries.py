"""Streams, months kept by increments, reconciled versions, interval joins, capped samples."""

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from farelens import session
from farelens.ml import evaluate
from farelens.operators import cleaning, increments, intervals, profile, reconcile, sampling
from farelens.plans import reports, sources
from farelens.session import scratch_dir
from farelens.sources import bills, trips
from farelens.streaming import hourly

TRIP = "trip_id BIGINT, pickup_datetime TIMESTAMP_NTZ, fare_amount DOUBLE"
START = dt.datetime(2024, 3, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def trip_rows(count, seed, first=0, hours=48):
    rng = random.Random(seed)
    return [(first + i, START + dt.timedelta(seconds=rng.randrange(hours * 3600)), rng.randrange(100, 9000) / 100)
            for i in range(count)]


class Landing:
    """A folder with deliveries and a stream over it."""

    def __init__(self, spark):
        self.spark, self.root = spark, scratch_dir(spark, "stream-test")

    def land(self, rows):
        self.spark.createDataFrame(rows, TRIP).coalesce(1).write.mode("append").parquet(f"{self.root}/landing")

    def run(self, lateness="1 hour"):
        schema = self.spark.createDataFrame([], TRIP).schema
        return hourly.run_available(
            hourly.hourly_windows(hourly.delivered(self.spark, f"{self.root}/landing", schema), "trip_id",
                                  "pickup_datetime", "fare_amount", lateness),
            f"{self.root}/changes", f"{self.root}/checkpoint")

    def report(self):
        return {r.pickup_window: (r.trip_count, r.total_revenue, r.avg_fare)
                for r in hourly.hourly_report(self.spark, f"{self.root}/changes").collect()}


def by_hour(rows):
    out = {}
    for _, at, fare in {r[0]: r for r in rows}.values():
        hour = at.replace(minute=0, second=0, microsecond=0)
        count, cents = out.get(hour, (0, 0))
        out[hour] = count + 1, cents + round(fare * 100)
    return {hour: (count, cents / 100, pytest.approx(cents / 100 / count, abs=1e-6))
            for hour, (count, cents) in out.items()}


def test_stream_equals_batch_with_and_without_a_restart(spark):
    early = sorted(trip_rows(120, 1), key=lambda r: r[1])
    border = early[-1][1]
    late_copies = [r for r in early if r[1] > border - dt.timedelta(minutes=30)]
    second = [(1000 + i, border + dt.timedelta(minutes=7 * i), 5.25) for i in range(30)] + late_copies
    restarted = Landing(spark)
    restarted.land(early)
    assert restarted.run().rows == 120
    assert restarted.report() == by_hour(early)
    restarted.land(second)
    summary = restarted.run()
    assert (summary.rows, summary.too_late) == (len(second), 0) and late_copies
    assert restarted.run().rows == 0
    once = Landing(spark)
    once.land(early)
    once.land(second)
    once.run()
    assert restarted.report() == once.report() == by_hour(early + second)


def test_late_trips_count_within_the_watermark_and_are_counted_beyond_it(spark):
    landing = Landing(spark)
    landing.land([(1, START + dt.timedelta(hours=10), 10.0)])
    landing.run()
    # the watermark is 09:00: half past nine is late but counts, eight is too late
    landing.land([(2, START + dt.timedelta(hours=9, minutes=30), 3.0), (3, START + dt.timedelta(hours=8), 4.0)])
    assert landing.run().too_late == 1
    assert landing.report() == by_hour([(1, START + dt.timedelta(hours=10), 10.0),
                                        (2, START + dt.timedelta(hours=9, minutes=30), 3.0)])


def test_a_stream_without_files_has_an_empty_report(spark):
    assert hourly.hourly_report(spark, scratch_dir(spark, "nothing")).collect() == []


def test_a_month_is_replaced_by_reading_it_alone(spark):
    rows = [(m, i, float(i % 7 + m), f"k{i % (10 * m)}") for m in (1, 2, 3) for i in range(200)]
    df = spark.createDataFrame(rows, "m INT, i INT, fare DOUBLE, k STRING").withColumn(
        "month", F.format_string("2024-%02d", "m"))
    root = scratch_dir(spark, "months-test")
    state = dict(amounts=["fare"], quantiles=["fare"], distinct=["k"])
    increments.write_months(df.where("m < 3 AND NOT (m = 2 AND i >= 50)"), f"{root}/rows")
    increments.refresh(spark, f"{root}/rows", f"{root}/state", None, **state)
    increments.write_months(df.where("m >= 2"), f"{root}/rows")
    text = plan(increments.read_months(spark, f"{root}/rows", ["2024-02", "2024-03"]))
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    before = {r.month: r.trips for r in increments.read_months(spark, f"{root}/state").collect()}
    assert before == {"2024-01": 200, "2024-02": 50}
    increments.refresh(spark, f"{root}/rows", f"{root}/state", ["2024-02", "2024-03"], **state)
    kept = increments.read_months(spark, f"{root}/state")
    report = increments.by_month_of_year(kept, ["fare"], ["fare"]).collect()
    whole = increments.by_month_of_year(increments.month_state(df, **state), ["fare"], ["fare"]).collect()
    assert report == whole and [r.trip_count for r in report] == [200] * 3
    # a month that lost all its rows keeps no state
    increments.refresh(spark, f"{root}/rows", f"{root}/state", ["2031-01"], **state)
    assert increments.by_month_of_year(
        increments.read_months(spark, f"{root}/state"), ["fare"], ["fare"]).collect() == whole
    estimate = {r.column_name: r.estimate for r in increments.merged_distinct(kept, ["k"]).collect()}
    assert estimate == {"k": 30}
    checked = increments.rank_check(increments.merged_quantiles(kept, "fare", [0.1, 0.5]), df, "fare").collect()
    assert [(r.row_count, r.within_bound) for r in checked] == [(600, True)] * 2
    off = spark.createDataFrame([(0.5, 9.5)], "probability DOUBLE, estimate DOUBLE")
    assert not increments.rank_check(off, df, "fare").first().within_bound


@pytest.mark.parametrize("ranges,most", [(4_096, 100_000), (4, 10)])
def test_bottom_k_is_exact_on_any_layout(spark, ranges, most):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(5000)]), i % 9) for i in range(700)] + [(7, 1)] * 30
    df = spark.createDataFrame(rows, "id BIGINT, v INT")

    def place(row):
        return 1 << 32 if row[0] is None else row[0] % (1 << 31) * 2654435761 % (1 << 32)

    for k in (0, 1, 25, 300, 730, 9999):
        wanted = sorted(rows, key=lambda r: (place(r), r[0] is not None, r[0] or 0, r[1]))[:k]
        for parts in (1, 7):
            got = sampling.bottom_k(df.repartition(parts), "id", k, ranges, most).collect()
            assert sorted(got, key=repr) == sorted((tuple(w) for w in wanted), key=repr), k


def test_scatter_points_are_as_many_as_asked(spark, small):
    assert profile.scatter_points(trips(spark, small), "trip_id", "trip_distance", "fare_amount", 77).count() == 77


def test_reconcile_counts_copies_and_nulls(spark):
    schema = "a INT, b STRING"
    before = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y"), (4, "z")], schema)
    after = spark.createDataFrame([(1, "x"), (2, None), (2, None), (2, None), (4, "z"), (5, "n")], schema)
    got = {tuple(r) for r in reconcile.changes(before, after).collect()}
    assert got == {(1, "x", 2, 1, 0, 1, 0), (2, None, 1, 3, 2, 0, 2), (3, "y", 1, 0, 0, 1, 0),
                   (5, "n", 0, 1, 1, 0, 0)}
    assert tuple(reconcile.change_summary(before, after).first()) == (5, 6, 3, 3, 2, 2)
    added = sum(r.added for r in reconcile.reconcile(before, after).collect())
    assert added == after.exceptAll(before).count()
    nothing = before.limit(0)
    assert reconcile.changes(nothing, nothing).collect() == []
    assert tuple(reconcile.change_summary(nothing, nothing).first()) == (0,) * 6


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(4)
    moment = lambda: START + dt.timedelta(seconds=rng.randrange(400 * 86_400))
    points = [(i, rng.randrange(3), moment()) for i in range(300)] + [(900, 1, None)]
    spans = [(i, rng.randrange(3), *sorted((moment(), moment()))) for i in range(60)]
    spans += [(60 + i, i % 3, at, at + dt.timedelta(minutes=rng.randrange(300))) for i, at in
              enumerate(p[2] for p in points[:90])]
    # one over everything, one backwards, one empty, one open
    spans += [(500, 1, dt.datetime(1990, 1, 1), dt.datetime(2060, 1, 1)), (501, 1, moment(), dt.datetime(1990, 1, 1)),
              (502, 1, START, START), (503, 1, START, None)]
    p = spark.createDataFrame(points, "point INT, k INT, at TIMESTAMP_NTZ")
    s = spark.createDataFrame(spans, "span INT, k INT, start TIMESTAMP_NTZ, stop TIMESTAMP_NTZ")
    joined = intervals.in_intervals(p, "at", s, "start", "stop", ["k"], width=3600)
    assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)
    expected = sorted((i, n) for i, k, at in points for n, j, start, stop in spans
                      if k == j and at and stop and start <= at < stop)
    assert sorted((r.point, r.span) for r in joined.collect()) == expected
    assert (900, 500) not in expected and sum(n == 500 for _, n in expected) > 50
    none = intervals.in_intervals(p, "at", s.where("start > stop"), "start", "stop", ["k"])
    assert none.collect() == []


def test_open_totals_equal_the_interval_join(spark):
    rng = random.Random(6)
    moment = lambda: START + dt.timedelta(seconds=rng.randrange(400 * 86_400))
    points = [(i, rng.randrange(3), moment()) for i in range(200)]
    points += [*points[:5], (900, 1, None), (901, None, moment())]
    spans = [(rng.randrange(3), *sorted((moment(), moment())), rng.randrange(-500, 9000) / 100) for _ in range(60)]
    # begin and end at moments, carry no amount, run over everything or backwards
    spans += [(k, at, at + dt.timedelta(hours=5), 1.25) for _, k, at in points[:40]]
    spans += [(k, at - dt.timedelta(hours=5), at, 2.5) for _, k, at in points[40:80]]
    spans += [(7, START, moment(), None), (1, dt.datetime(1960, 1, 1), dt.datetime(2060, 1, 1), None),
              (1, moment(), dt.datetime(1990, 1, 1), 1.0), (None, START, moment(), 1.0), (2, START, None, 1.0)]
    points.append((902, 7, START))
    p = spark.createDataFrame(points, "point INT, k INT, at TIMESTAMP_NTZ")
    s = spark.createDataFrame(spans, "k INT, start TIMESTAMP_NTZ, stop TIMESTAMP_NTZ, fare DOUBLE")
    pairs = intervals.in_intervals(p, "at", s, "start", "stop", ["k"]).groupBy(*p.columns).agg(
        F.count("*").alias("n"), F.sum(F.col("fare").cast("decimal(18,2)")).cast("double").alias("cents"))
    expected = sorted(map(tuple, pairs.collect()))
    assert (902, 7, START, 1, None) in expected and len(expected) > 150
    for width in (3600, 86_400 * 30, 365 * 86_400):
        found = intervals.open_totals(p, "at", s, "start", "stop", ["k"], "fare", "n", "cents", width)
        assert sorted(map(tuple, found.collect())) == expected
        assert found.schema == pairs.schema
        assert "Generate explode" not in plan(found)


def test_an_interval_over_all_buckets_costs_two_rows(spark):
    wide = spark.createDataFrame([(1, dt.datetime(1970, 1, 1), dt.datetime(2100, 1, 1))],
                                 "span INT, start TIMESTAMP_NTZ, stop TIMESTAMP_NTZ")
    points = spark.createDataFrame([(START,)], "at TIMESTAMP_NTZ")
    joined = intervals.in_intervals(points, "at", wide, "start", "stop", width=60)
    assert joined.count() == 1
    level = intervals._level(F.lit(130 * 365.25 * 86_400), 60)
    assert wide.select(level).first()[0] < intervals.LEVELS


def test_metrics_come_from_the_writing_job(spark, small):
    rows = trips(spark, small).withColumn("dropoff_datetime", F.col("pickup_datetime") + F.expr("INTERVAL 5 MINUTES"))
    path = scratch_dir(spark, "clean-test")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("writing", "one job")
    funnel, nulls = cleaning.write_clean(rows, path)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("writing")) == 1
    assert [tuple(r) for r in funnel.collect()] == [tuple(r) for r in cleaning.cleaning_funnel(rows).collect()]
    assert spark.read.parquet(path).count() == funnel.collect()[-1].Records == cleaning.apply_rules(rows).count()
    assert {r.column_name: r.null_rows for r in nulls.collect()}["passenger_count"] == 0


@pytest.mark.parametrize("curve,thin,axes", [
    (evaluate.roc_curve, evaluate.thin_roc_curve, ("fpr", "tpr")),
    (evaluate.pr_curve, evaluate.thin_pr_curve, ("recall", "precision"))])
def test_thinned_curves_are_short_and_near(spark, curve, thin, axes):
    rng = random.Random(6)
    rows = [(m, int(rng.random() < s), s) for m in "ab" for s in (rng.random() for _ in range(4000))]
    df = spark.createDataFrame(rows, "model STRING, label INT, score DOUBLE")
    whole, thinned = (f(df, by=["model"]).collect() for f in (curve, thin))
    for model in "ab":
        full = sorted((r[axes[0]], r.threshold is not None, -(r.threshold or 0), r[axes[1]])
                      for r in whole if r.model == model)
        line = sorted((r[axes[0]], r.threshold is not None, -(r.threshold or 0), r[axes[1]])
                      for r in thinned if r.model == model)
        assert len(line) <= 1000 < len(full) and {(p[0], p[3]) for p in line} <= {(p[0], p[3]) for p in full}
        gap = max(r.gap for r in thinned if r.model == model)
        assert 0 < gap < 0.02
        points = [(p[0], p[3]) for p in line]
        for x, _, _, y in full:
            # the line passes the value y within the gap of x, or x itself is on it
            assert any(min(a[0], b[0]) - gap - 1e-9 <= x <= max(a[0], b[0]) + gap + 1e-9
                       and min(a[1], b[1]) - gap - 1e-9 <= y <= max(a[1], b[1]) + gap + 1e-9
                       for a, b in zip(points, points[1:]))


def test_ids_beyond_32_bits_stay_whole(spark, tmp_path):
    rows = [(1, START, 3_000_000_000, "a", 1.0, '{"k": 5}'), (2, START, 3_000_000_000, "a", 2.0, '{"k": 6}')]
    spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                          "value DOUBLE, props STRING").write.parquet(f"{tmp_path}/events.parquet")
    assert {r.PULocationID for r in trips(spark, str(tmp_path)).collect()} == {3_000_000_000}


def test_exports_by_month_read_one_stored_aggregate(spark, small, monkeypatch):
    written, write_csv = {}, sources.files.write_csv
    monkeypatch.setattr(sources.files, "write_csv", lambda report, path: (
        written.update({path.rsplit("/", 1)[1]: report}), write_csv(report, path))[1])
    sources.export_manifest(spark, small)
    for name in ("cost_analysis", "trip_behavior", "monthly_fare_summary"):
        alone = reports.QUERIES[name](spark, small)
        assert written[name].columns == alone.columns
        assert written[name].collect() == alone.collect()
        assert "Join" not in plan(written[name])
    assert "Join" not in plan(written["missing_values"]) and "Join" not in plan(written["data_quality"])


def test_shuffles_of_the_bills_widen_with_the_files(spark, small, monkeypatch):
    sizes = [os.path.getsize(f"{small}/{table}.parquet") for table in ("lineitem", "orders")]
    monkeypatch.setattr(session, "SHUFFLE_INPUT_BYTES", math.ceil(sum(sizes) / 50))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert "hashpartitioning(l_orderkey" in plan(bills(spark, small))
        assert ", 50), ENSURE_REQUIREMENTS" in plan(bills(spark, small))
        assert session.widen_shuffles(spark, 0) == 50
    finally:
        spark.conf.unset(session.INITIAL_WIDTH)
        spark.conf.set(threshold, before)
