"""Samples, splits and folds by key hash."""

from __future__ import annotations

from pyspark.sql import functions as F

from farelens.operators import sampling
from farelens.plans.profile import UNIT_HASH
from farelens.sources import load_table


def events(spark, folder):
    return load_table(spark, folder, "events").select("event_id", "user_id", "value")


QUERIES = {
    "hash_sample": lambda spark, folder: sampling.hash_sample(
        events(spark, folder), "event_id", 0.05),
    "train_test_split": lambda spark, folder: sampling.with_split(
        events(spark, folder), "event_id").groupBy("split").agg(
            F.count("*").alias("row_count"), F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"), F.sum("event_id").alias("id_sum")),
    "kfold_assign": lambda spark, folder: sampling.with_fold(
        events(spark, folder), "event_id", 3).select("event_id", "fold"),
}

HASH = UNIT_HASH.format("event_id")
FOLD_HASH = HASH.replace("2654435761", "2246822519")

ORACLE = {
    "hash_sample": f"SELECT event_id, user_id, value FROM events WHERE {HASH} < 0.05",
    "train_test_split":
        f"SELECT CASE WHEN {HASH} < 0.8 THEN 'train' ELSE 'test' END AS split, "
        "COUNT(*) AS row_count, MIN(event_id) AS first_id, MAX(event_id) AS last_id, "
        "CAST(SUM(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1",
    "kfold_assign":
        f"SELECT event_id, CAST(floor({FOLD_HASH} * 3) AS INTEGER) AS fold FROM events",
}
