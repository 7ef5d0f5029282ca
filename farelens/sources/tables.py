"""Parquet readers with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TYPES = {
    "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(), "TIMESTAMP_NTZ": T.TimestampNTZType()}


def declare(columns: str) -> T.StructType:
    """``name TYPE, ...`` as a schema; unlike DDL parsing it needs no session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# fixed values: the monthly trip files' columns, in file order
TRIP_SCHEMA = declare("""
    VendorID INT,
    tpep_pickup_datetime TIMESTAMP_NTZ,
    tpep_dropoff_datetime TIMESTAMP_NTZ,
    passenger_count BIGINT,
    trip_distance DOUBLE,
    RatecodeID BIGINT,
    store_and_fwd_flag STRING,
    PULocationID INT,
    DOLocationID INT,
    payment_type BIGINT,
    fare_amount DOUBLE,
    extra DOUBLE,
    mta_tax DOUBLE,
    tip_amount DOUBLE,
    tolls_amount DOUBLE,
    improvement_surcharge DOUBLE,
    total_amount DOUBLE,
    congestion_surcharge DOUBLE,
    Airport_fee DOUBLE,
    cbd_congestion_fee DOUBLE
""")

TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
}


class NoInputFiles(FileNotFoundError):
    """No file matches the given path or pattern."""


class SchemaMismatch(ValueError):
    """A declared column is missing from the files."""


def read_paths(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None
               ) -> DataFrame:
    """One scan over one or many parquet paths or glob patterns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise NoInputFiles(", ".join(paths)) from error
        raise


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns, casting where a file's type differs."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise SchemaMismatch(f"columns not in the files: {missing}")
    found = {f.name: f.dataType for f in df.schema}
    return df.select(*[
        F.col(f.name) if found[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema])


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = read_paths(spark, f"{folder.rstrip('/')}/{name}.parquet")
    return conform(df, declare(TABLES[name]))


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Monthly trip files, by pattern or as an explicit list, under the trip schema."""
    return conform(read_paths(spark, *paths), TRIP_SCHEMA)


def canonical_trips(df: DataFrame) -> DataFrame:
    """Meter-specific timestamp names become ``pickup_datetime``/``dropoff_datetime``.

    The timestamps stay wall-clock (``timestamp_ntz``), so hours and durations
    do not depend on the session's zone.
    """
    return df.withColumnsRenamed({
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime"})
