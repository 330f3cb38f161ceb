"""The curated trip table: 19 raw columns become 38."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregate import schemas
from faregate.functions import calendar, rounding, text
from faregate.operators.joins import broadcast_if_small

UNKNOWN = "Unknown"


def pickup_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").alias("PULocationID"),
        F.col("Borough").alias("pickup_borough"),
        F.col("Zone").alias("pickup_zone"),
        F.col("service_zone").alias("pickup_service_zone"),
    )


def dropoff_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").alias("DOLocationID"),
        F.col("Borough").alias("dropoff_borough"),
        F.col("Zone").alias("dropoff_zone"),
    )


def calendar_columns(pickup: Column) -> dict[str, Column]:
    return {
        "pickup_date": calendar.iso_date(pickup),
        "pickup_year": F.year(pickup).cast("smallint"),
        "pickup_month": F.month(pickup).cast("tinyint"),
        "pickup_day": F.dayofmonth(pickup).cast("tinyint"),
        "pickup_hour": F.hour(pickup).cast("tinyint"),
        "pickup_dayofweek": calendar.monday_based_weekday(pickup).cast("tinyint"),
        "is_weekend": calendar.is_weekend(pickup),
    }


def derived_columns(seconds: Column) -> dict[str, Column]:
    return {
        "trip_duration_min": rounding.half_even(seconds / 60),
        "avg_speed_mph": F.when(
            seconds > 0, rounding.half_even(F.col("trip_distance") / (seconds / 3600))
        ),
        "tip_pct": rounding.guarded_ratio(F.col("tip_amount"), F.col("fare_amount"), 100.0),
        "fare_per_mile": rounding.guarded_ratio(F.col("fare_amount"), F.col("trip_distance")),
        "is_airport_trip": F.coalesce(F.col("airport_fee"), F.lit(0.0)) > 0,
        "payment_label": text.label_of(F.col("payment_type"), schemas.PAYMENT_LABELS),
    }


def curate(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Join the zone lookup in both roles and derive the calendar, duration,
    ratio and label columns.

    The lookup is broadcast once its size is checked, so the fact is neither
    shuffled nor sorted; everything else is one projection.
    """
    joined = trips.join(broadcast_if_small(pickup_zones(zones)), "PULocationID", "left").join(
        broadcast_if_small(dropoff_zones(zones)), "DOLocationID", "left"
    )
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    columns = {
        "pickup_borough": F.coalesce(F.col("pickup_borough"), F.lit(UNKNOWN)),
        "pickup_zone": F.col("pickup_zone"),
        "pickup_service_zone": F.col("pickup_service_zone"),
        "dropoff_borough": F.coalesce(F.col("dropoff_borough"), F.lit(UNKNOWN)),
        "dropoff_zone": F.col("dropoff_zone"),
        **calendar_columns(pickup),
        "trip_duration_sec": calendar.duration_seconds(pickup, dropoff),
        **derived_columns(calendar.duration_seconds(pickup, dropoff)),
    }
    return joined.select(
        *trips.columns, *[expr.alias(name) for name, expr in columns.items()]
    )
