"""Moments and the intervals that hold them: joins on time buckets, and running totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Levels of buckets; each is twice as wide as the one before. 2**40 seconds and more fit.
LEVELS = 41


def _seconds(at: str) -> Column:
    return F.unix_timestamp(F.col(at))


def _level(length: Column, width: int) -> Column:
    """The first level whose buckets are at least as wide as an interval."""
    halvings = F.ceil(F.log2(F.greatest(length / F.lit(float(width)), F.lit(1.0))))
    return F.least(halvings, F.lit(LEVELS - 1)).cast("int")


def in_intervals(moments: DataFrame, at: str, intervals: DataFrame, start: str, stop: str,
                 keys: Sequence[str] = (), width: int = 86_400) -> DataFrame:
    """Every row of ``moments`` with every row of ``intervals`` where start <= at < stop and
    the keys are equal. Columns besides the keys must have different names.

    An interval goes to the level whose buckets are just wider than it and is in one or two
    of them there; a moment is in one bucket of each level that some interval has. So an
    interval over all buckets costs two rows, not one for each bucket, and a hot key is
    spread over its buckets. Rows with null times, or intervals that end before they
    begin, match nothing.
    """
    # which levels there are: at most LEVELS numbers
    valid = intervals.where((F.col(start) < F.col(stop)))
    level = _level((_seconds(stop) - _seconds(start) + 1).cast("double"), width)
    found = sorted(r[0] for r in valid.select(level.alias("level")).distinct().collect())
    if not found:
        found = [0]
    span = F.pow(F.lit(2.0), F.col("_level")).cast("bigint") * width

    def bucket(at_second: Column) -> Column:
        return F.floor(at_second / span).cast("bigint")

    held = (valid.withColumn("_level", level)
            .withColumn("_bucket", F.explode(F.sequence(bucket(_seconds(start)), bucket(_seconds(stop))))))
    asked = (moments.where(F.col(at).isNotNull())
             .withColumn("_level", F.explode(F.array(*[F.lit(n) for n in found])))
             .withColumn("_bucket", bucket(_seconds(at))))
    return (asked.join(held, [*keys, "_level", "_bucket"])
            .where((F.col(start) <= F.col(at)) & (F.col(at) < F.col(stop)))
            .drop("_level", "_bucket"))


def open_totals(moments: DataFrame, at: str, intervals: DataFrame, start: str, stop: str, keys: Sequence[str],
                amount: str, count: str, total: str, width: int = 365 * 86_400) -> DataFrame:
    """Every different row of ``moments`` that is inside an interval of its keys, with the number of
    pairs ``in_intervals`` has for it and their sum of cents.

    No pair is made. An interval is a step up at its start and one down at its stop, and a
    moment reads the running totals of its keys. Those run inside buckets of ``width`` seconds,
    which begin with what the buckets before left open, so a hot key is spread over them.
    """
    cents = F.col(amount).cast("decimal(18,2)")
    filled = cents.isNotNull().cast("bigint")
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    columns = moments.columns

    def step(when: str, sign: int) -> Column:
        return F.struct(F.col(when).alias("_at"), F.lit(sign).cast("bigint").alias("_n"),
                        (sign * filled).alias("_filled"), (sign * cents).cast("decimal(18,2)").alias("_cents"))

    none = F.lit(None)
    steps = intervals.where(known & (F.col(start) < F.col(stop))).select(
        *keys, F.inline(F.array(step(start, 1), step(stop, -1)))).withColumn(
        "_row", none.cast(moments.select(F.struct(*columns)).schema[0].dataType))
    asked = moments.where(known & F.col(at).isNotNull()).select(
        *keys, F.col(at).alias("_at"), F.lit(0).cast("bigint").alias("_n"), F.lit(0).cast("bigint").alias("_filled"),
        none.cast("decimal(18,2)").alias("_cents"), F.struct(*columns).alias("_row"))
    bucket = F.floor(_seconds("_at") / width).cast("int")
    placed = steps.unionByName(asked).withColumn("_bucket", bucket).repartition(*keys, "_bucket")
    sums = ("_n", "_filled", "_cents")
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy(*keys, "_bucket").agg(*[F.sum(c).alias(c) for c in sums]).select(
        *keys, "_bucket", *[F.sum(c).over(earlier).alias(f"{c}_before") for c in sums])
    # steps at the moment itself count: start <= at < stop
    so_far = Window.partitionBy(*keys, "_bucket").orderBy("_at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0)
    running = placed.select(*keys, "_bucket", "_row", *[F.sum(c).over(so_far).alias(c) for c in sums]).where(
        F.col("_row").isNotNull())
    read = running.join(carried, [*keys, "_bucket"]).select(
        *keys, "_bucket", "_row",
        *[(F.coalesce(c, zero) + F.coalesce(f"{c}_before", zero)).alias(c) for c in sums]).where("_n > 0")
    cents_open = F.when(F.col("_filled") > 0, F.col("_cents"))
    # equal moments are one row with the pairs of all of them
    return read.groupBy(*keys, "_bucket", "_row").agg(
        F.coalesce(F.sum("_n"), zero).alias(count), F.sum(cents_open).cast("double").alias(total)).select("_row.*", count, total)
