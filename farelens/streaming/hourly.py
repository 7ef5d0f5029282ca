"""Hourly fares as a stateful stream over delivered files.

Deliveries land as Parquet files in one folder. A run takes what is new, in one batch
for each delivery if files arrive between runs, and stops; a later run goes on from the
checkpoint with the state it left. Trips may be delivered twice: copies of a trip_id
within the watermark count once. A trip that is later than the watermark is dropped, and
how many were is in the run's summary.

Each batch writes the windows it changed under its own number, replacing what a failed
try of the same batch left. The newest entry of each window is the report, so it is
whole at any moment, open windows included, and state is held for the time of the
watermark only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHANGES = ("window_start timestamp_ntz, trip_count bigint, revenue decimal(38,2), batch bigint")


@dataclass(frozen=True)
class Summary:
    """What one run has done."""
    batches: int
    rows: int
    too_late: int


def delivered(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A stream of the files that land in ``folder``."""
    return spark.readStream.schema(schema).parquet(folder)


def hourly_windows(trips: DataFrame, key: str, at: str, amount: str, lateness: str) -> DataFrame:
    """window_start, trip_count and revenue of every hour, each key once. ``at`` is a
    wall-clock time; it is read as UTC for the watermark."""
    utc = F.to_utc_timestamp(F.col(at).cast("timestamp"), F.current_timezone())
    timed = trips.select(F.col(key).alias("key"), utc.alias("at"),
                         F.col(amount).cast("decimal(18,2)").alias("amount"))
    once = timed.withWatermark("at", lateness).dropDuplicatesWithinWatermark(["key"])
    return (once.groupBy(F.window("at", "1 hour").alias("hour"))
            .agg(F.count("*").alias("trip_count"), F.sum("amount").alias("revenue"))
            .select(F.from_utc_timestamp("hour.start", F.current_timezone())
                    .cast("timestamp_ntz").alias("window_start"), "trip_count",
                    F.col("revenue").cast("decimal(38,2)").alias("revenue")))


def run_available(windows: DataFrame, changes: str, checkpoint: str) -> Summary:
    """Takes all files that have not been taken, writes the changed windows and stops."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch={number}")

    query = (windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(put).start())
    query.awaitTermination()
    if error := query.exception():
        raise error
    progress = [p for p in query.recentProgress if p.numInputRows or p.stateOperators]
    return Summary(
        batches=len({p.batchId for p in progress}), rows=sum(p.numInputRows for p in progress),
        too_late=sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators))


def hourly_report(spark: SparkSession, changes: str) -> DataFrame:
    """pickup_window, avg_fare, total_revenue and trip_count: each window as last written."""
    schema = T.StructType.fromDDL(CHANGES)
    try:
        found = spark.read.schema(schema).parquet(changes)
    except AnalysisException:
        found = spark.createDataFrame([], schema)
    newest = found.groupBy("window_start").agg(
        F.max_by(F.struct("trip_count", "revenue"), "batch").alias("last"))
    revenue, count = F.col("last.revenue").cast("double"), F.col("last.trip_count")
    return newest.select(
        F.col("window_start").alias("pickup_window"), F.round(revenue / count, 6).alias("avg_fare"),
        revenue.alias("total_revenue"), count.alias("trip_count"))
