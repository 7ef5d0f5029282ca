"""The next row of the same key, also when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on keys that may be null."""
    named = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return left.join(named, same, "left").drop(*[f"_r_{c}" for c in keys])


def _lead_of_heads(moments: DataFrame, keys: Sequence[str], at: str, step: str, out: str) -> DataFrame:
    """Per key and step: the first moment of the key's next step."""
    heads = moments.groupBy(*keys, step).agg(F.min(at).alias("_head"))
    following = Window.partitionBy(*keys).orderBy(step)
    return heads.select(*keys, step, F.lead("_head").over(following).alias(out))


def next_in_key(rows: DataFrame, key: str, at: str, tie: str, out: str) -> DataFrame:
    """Add ``out`` = ``lead(at)`` over ``key`` ordered by ``(at, tie)``.

    A plain window sorts each key in one task. Here the rows are first summed up
    by (key, at): of rows that share a moment only the last by ``tie`` looks beyond
    it, the others' next time is that moment itself. The next moment is looked up
    in three windows of fixed reach, for all keys alike: inside the second, from
    second to second inside the hour, and from hour to hour. Null keys are a key
    like any other; rows without ``at`` come first. ``tie`` tells the rows of one
    key and moment apart; rows that share all three all count as the last.
    """
    moments = rows.groupBy(key, at).agg(F.max(tie).alias("_last")).withColumns({
        "_second": F.date_trunc("second", at), "_hour": F.date_trunc("hour", at)})
    inside = Window.partitionBy(key, "_second").orderBy(at)
    found = moments.withColumn("_in_second", F.lead(at).over(inside))
    found = _null_safe(found, _lead_of_heads(moments, [key, "_hour"], at, "_second", "_in_hour"),
                       [key, "_hour", "_second"])
    found = _null_safe(found, _lead_of_heads(moments, [key], at, "_hour", "_later"), [key, "_hour"])
    found = found.select(key, at, "_last", F.coalesce("_in_second", "_in_hour", "_later").alias("_next"))
    joined = _null_safe(rows, found, [key, at])
    last = F.col(tie).eqNullSafe(F.col("_last"))
    return joined.select(*rows.columns, F.when(last, F.col("_next")).otherwise(F.col(at)).alias(out))
