"""Trip-shaped views of the shared test tables.

``trips`` reads events, ``bills`` reads order lines with their orders,
``line_charges`` is the part of ``bills`` that needs no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.operators.neighbours import next_in_key
from farelens.session import widen_shuffles
from farelens.sources.inventory import input_bytes
from farelens.sources.tables import load_table


def trips(spark: SparkSession, folder: str, with_dropoff: bool = False) -> DataFrame:
    """Events as trips. The drop-off (the user's next event) costs a shuffle, so
    it is added only on request."""
    events = load_table(spark, folder, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    dropoff: dict[str, Column] = {}
    if with_dropoff:
        events = next_in_key(events, "user_id", "ts", "event_id", "dropoff_datetime")
        dropoff = {"dropoff_datetime": F.col("dropoff_datetime")}
    columns = {
        "trip_id": F.col("event_id"),
        "VendorID": (F.col("event_id") % 2 + 1).cast("int"),
        "pickup_datetime": F.col("ts"),
        **dropoff,
        "passenger_count": (k % 7).cast("bigint"),
        "trip_distance": k / F.lit(10.0),
        "store_and_fwd_flag": F.when(F.col("event_id") % 50 == 0, "Y").otherwise("N"),
        "PULocationID": F.col("user_id"),
        "DOLocationID": k,
        "payment_type": F.col("event_type"),
        "fare_amount": F.col("value"),
    }
    return events.select(*[column.alias(name) for name, column in columns.items()])


def _charges() -> dict[str, Column]:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return {
        "l_orderkey": F.col("l_orderkey"),
        "l_linenumber": F.col("l_linenumber"),
        "VendorID": (F.col("l_linenumber") % 2 + 1).cast("int"),
        "passenger_count": F.col("l_linenumber").cast("bigint"),
        "trip_distance": F.col("l_quantity"),
        "RatecodeID": (F.col("l_partkey") % 6 + 1).cast("bigint"),
        "store_and_fwd_flag": F.col("l_linestatus"),
        "PULocationID": F.col("l_suppkey"),
        "DOLocationID": F.col("l_partkey"),
        "fare_amount": price,
        "extra": discount * 10,
        "tip_amount": price * discount,
        "tolls_amount": price * tax,
        "congestion_surcharge": F.col("l_linenumber") * F.lit(0.5),
        "total_amount": price * (1 - discount) * (1 + tax),
    }


def line_charges(spark: SparkSession, folder: str) -> DataFrame:
    """The charge columns of ``bills``; order dates are not needed, so no join."""
    lines = load_table(spark, folder, "lineitem")
    return lines.select(*[column.alias(name) for name, column in _charges().items()])


def bills(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their order's date and priority.

    Both sides grow with the data: a plain equi-join, where AQE splits the
    partition of an order key that holds too many lines. Its shuffles widen with the
    files, so that no task's share grows with them.
    """
    widen_shuffles(spark, input_bytes(spark, f"{folder}/lineitem.parquet", f"{folder}/orders.parquet"))
    lines = load_table(spark, folder, "lineitem")
    orders = load_table(spark, folder, "orders")
    columns = {
        **_charges(),
        "pickup_datetime": F.col("o_orderdate"),
        "dropoff_datetime": F.col("l_shipdate"),
        "payment_type": F.col("o_orderpriority"),
        "payment_code": F.substring("o_orderpriority", 1, 1).cast("bigint"),
        "customer_id": F.col("o_custkey"),
    }
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return joined.select(*[column.alias(name) for name, column in columns.items()])


def documents_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels; about 60 % of the labels are missing."""
    documents = load_table(spark, folder, "documents")
    return documents.join(load_table(spark, folder, "labels"), "doc_id", "left")
