"""Explicit schemas and the fixed values of the trip data model."""

from __future__ import annotations

from pyspark.sql import types as T

# The 19 raw trip columns, in order.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)

# Columns without which a trip file is rejected.
TRIP_REQUIRED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "fare_amount",
)

# What an absent optional column is filled with.
TRIP_DEFAULTS = {
    "VendorID": 1,
    "passenger_count": 1.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "payment_type": 1,
    "extra": 0.0,
    "mta_tax": 0.0,
    "tip_amount": 0.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.0,
    "total_amount": 0.0,
    "congestion_surcharge": 0.0,
    "airport_fee": 0.0,
}

# The columns of the zone lookup.
ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# Payment code to label; any other code is "other".
PAYMENT_LABELS = {1: "credit_card", 2: "cash", 3: "no_charge", 4: "dispute"}

# The eight charges that make up a trip's total.
CHARGE_COLUMNS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)

# Texts that stand for a missing value in a CSV written or read by pandas.
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The fields of Spark's own event log that the evidence tables use.
EVENT_LOG_DDL = """
`Event` string,
`Stage ID` bigint,
`Stage Attempt ID` bigint,
`Stage Info` struct<`Stage ID`: bigint, `Stage Attempt ID`: bigint, `Stage Name`: string, `Details`: string>,
`Task Info` struct<`Launch Time`: bigint, `Finish Time`: bigint, `Failed`: boolean>,
`Task Metrics` struct<
  `Disk Bytes Spilled`: bigint,
  `Shuffle Read Metrics`: struct<`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>,
  `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>,
  `Input Metrics`: struct<`Records Read`: bigint>>
"""
