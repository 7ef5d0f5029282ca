"""The trip-shaped views as SQL, for the equivalent queries."""

from __future__ import annotations

TRIPS = """trips AS (
  SELECT event_id AS trip_id, CAST(event_id % 2 + 1 AS INTEGER) AS VendorID,
    ts AS pickup_datetime,
    LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dropoff_datetime,
    CAST(k % 7 AS BIGINT) AS passenger_count, CAST(k AS DOUBLE) / 10 AS trip_distance,
    CASE WHEN event_id % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    user_id AS PULocationID, k AS DOLocationID,
    event_type AS payment_type, value AS fare_amount
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events))"""

BILLS = """bills AS (
  SELECT l_orderkey, l_linenumber, CAST(l_linenumber % 2 + 1 AS INTEGER) AS VendorID,
    CAST(l_linenumber AS BIGINT) AS passenger_count, l_quantity AS trip_distance,
    CAST(l_partkey % 6 + 1 AS BIGINT) AS RatecodeID, l_linestatus AS store_and_fwd_flag,
    l_suppkey AS PULocationID, l_partkey AS DOLocationID,
    l_extendedprice AS fare_amount, l_discount * 10 AS extra,
    l_extendedprice * l_discount AS tip_amount, l_extendedprice * l_tax AS tolls_amount,
    l_linenumber * CAST(0.5 AS DOUBLE) AS congestion_surcharge,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS total_amount,
    o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
    o_orderpriority AS payment_type, o_custkey AS customer_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

LABELED = """labeled AS (
  SELECT d.doc_id, text, lang, source, n_chars, quality, toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

SECONDS = ("CAST(floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime)) AS DOUBLE)")
HOUR = "CAST(hour(pickup_datetime) AS INTEGER)"
MONTH = "CAST(month(pickup_datetime) AS INTEGER)"
WEEKDAY = "CAST(dayofweek(pickup_datetime) + 1 AS INTEGER)"
WEEKEND = "CAST(dayofweek(pickup_datetime) IN (0, 6) AS INTEGER)"
RUSH = ("CAST(hour(pickup_datetime) BETWEEN 7 AND 9 OR hour(pickup_datetime) BETWEEN 16 AND 19 "
        "AS INTEGER)")


def money(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(column: str) -> str:
    return f"ROUND(AVG({column}), 6)"


def sql(body: str, *more: str) -> str:
    """The views, further named subqueries, then the query."""
    return "WITH " + ",\n".join([TRIPS, BILLS, LABELED, *more]) + "\n" + body.strip()
