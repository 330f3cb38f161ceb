"""The driver tables seen as trips, zones and dirty trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faregate import schemas
from faregate.functions import calendar, rounding
from faregate.operators import joins, sampling
from faregate.operators.defects import DirtyColumns
from faregate.operators.joins import broadcast_if_small

TRIP_EVENTS = DirtyColumns(key="trip_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` with its region as a zone lookup; one borough is not filled in."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(
        broadcast_if_small(region), nation.n_regionkey == region.r_regionkey, "left"
    ).select(
        F.col("n_nationkey").alias("LocationID"),
        F.nullif(F.col("r_name"), F.lit("MIDDLE EAST")).alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.format_string("Service %d", F.col("n_regionkey")).alias("service_zone"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its order as raw trips: 19 columns.

    The supplier's nation is the pick-up zone, the customer's the drop-off
    zone. Customers meet orders before lines do, so the join on the customer
    key runs on the smaller table. A line whose order, customer or supplier is
    not there stays, without their values. Suppliers are broadcast where they
    are few; beyond, hot ones are salted.
    """
    line, order = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = order.join(customer, order.o_custkey == customer.c_custkey, "left").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "c_nationkey"
    )
    supplied = joins.join_or_salt(
        line, supplier.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey", ["l_orderkey", "l_linenumber"]
    )
    joined = supplied.join(placed, supplied.l_orderkey == placed.o_orderkey, "left")
    status = F.col("o_orderstatus")
    raw = joined.select(
        F.col("l_linenumber").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.lit(1.0).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").cast("double").alias("RatecodeID"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        F.col("s_nationkey").alias("PULocationID"),
        F.col("c_nationkey").alias("DOLocationID"),
        F.when(status == "O", 1).when(status == "F", 2).otherwise(9).cast("bigint").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.lit(0.0).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        rounding.half_even(F.col("l_extendedprice") * F.col("l_tax")).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (F.col("l_tax") + F.lit(0.0)).alias("congestion_surcharge"),
        (F.col("l_discount") + F.lit(0.0)).alias("airport_fee"),
    )
    priced = raw.withColumn("total_amount", rounding.row_total(schemas.CHARGE_COLUMNS))
    return priced.select(*schemas.TRIP_SCHEMA.fieldNames())


def trip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as trips with a unique key: the base of the dirty table."""
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.col("user_id").cast("int").alias("PULocationID"),
        F.col("value").alias("fare_amount"),
        (F.col("event_id") % 6 + 1).cast("double").alias("passenger_count"),
        calendar.iso_date(F.col("ts")).alias("pickup_date"),
        (k * 60).alias("trip_duration_sec"),
    )


def skewed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a pick-up zone drawn so that one key holds 90 % of the rows."""
    names = F.array(*[F.lit(name) for name in sampling.BOROUGH_WEIGHTS])
    drawn = table(spark, sf_dir, "events").select(
        "event_id", sampling.skewed_borough(F.col("event_id")).alias("pickup_borough"), "value"
    )
    zone = F.array_position(names, F.col("pickup_borough")).cast("int")
    return drawn.withColumn("LocationID", zone)
