"""What differs between two deliveries of one table, copies counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every distinct row of either with ``copies_before``, ``copies_after``, ``added``,
    ``removed`` and ``repeated``.

    added and removed are what exceptAll gives in either direction, repeated is what a row
    has beyond one copy afterwards. Both deliveries meet in one aggregate that counts
    inside tasks first, so a row with very many copies does not gather, and nulls are
    equal. The row's columns come first, in the order of ``before``.
    """
    columns = list(columns or before.columns)
    both = (before.select(*columns, F.lit(1).alias("_before"), F.lit(0).alias("_after"))
            .unionByName(after.select(*columns, F.lit(0).alias("_before"), F.lit(1).alias("_after"))))
    counted = both.groupBy(*columns).agg(
        F.sum("_before").alias("copies_before"), F.sum("_after").alias("copies_after"))
    grown = F.col("copies_after") - F.col("copies_before")
    none = F.lit(0).cast("bigint")
    return counted.withColumns({
        "added": F.greatest(grown, none), "removed": F.greatest(-grown, none),
        "repeated": F.greatest(F.col("copies_after") - 1, none)})


def changes(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``reconcile`` that were added or removed, or stand there repeatedly."""
    return reconcile(before, after, columns).where("added > 0 OR removed > 0 OR repeated > 0")


def change_summary(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows before and after, kept, added, removed and repeated."""
    totals = {"rows_before": F.col("copies_before"), "rows_after": F.col("copies_after"),
              "kept": F.least("copies_before", "copies_after"), "added": F.col("added"),
              "removed": F.col("removed"), "repeated": F.col("repeated")}
    return reconcile(before, after, columns).agg(*[
        F.coalesce(F.sum(total), F.lit(0)).alias(name) for name, total in totals.items()])
