"""Star-schema models: staging view, date/zone/payment dimensions, trip fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import DIM_DATE_END, DIM_DATE_START, NOT_AVAILABLE
from tripmart.functions.calendar import date_key, day_name, iso_weekday, is_weekend, month_name
from tripmart.sources.reference import date_series

# Columns of the staging view and of the fact, in their order.
STG_COLUMNS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour",
    "pickup_location_id", "dropoff_location_id", "payment_type", "rate_code_id", "store_and_fwd_flag",
    "passenger_count", "passenger_count_missing", "zero_distance", "trip_distance", "trip_duration_minutes",
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee", "total_amount",
    "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone", "year", "month",
]

FACT_MEASURES = [
    "vendor_id", "rate_code_id", "passenger_count", "passenger_count_missing", "zero_distance",
    "trip_distance", "trip_duration_minutes", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee", "total_amount",
]


def stg_trips(staging: DataFrame) -> DataFrame:
    """Thin projection of the staging table plus pickup_date and pickup_hour (L1)."""
    derived = {
        "pickup_date": F.to_date("pickup_datetime"),
        "pickup_hour": F.hour("pickup_datetime").cast("int"),
    }
    return staging.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in STG_COLUMNS])


def dim_date_from_days(days: DataFrame) -> DataFrame:
    """Calendar attributes for a ``full_date`` column (L2)."""
    d = F.col("full_date")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_weekday(d).alias("day_of_week"),
        day_name(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str = DIM_DATE_START, end: str = DIM_DATE_END) -> DataFrame:
    """Date dimension for [start, end], inclusive."""
    return dim_date_from_days(date_series(spark, start, end))


def dim_date_covering(ts_df: DataFrame, ts_col: str) -> DataFrame:
    """Date dimension covering whole calendar years of the data in ``ts_col``.

    The range is computed by an aggregate and expanded with ``sequence`` on an
    executor: nothing is collected to the driver.
    """
    bounds = ts_df.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi"))
    days = bounds.select(F.explode(F.sequence(
        F.trunc(F.to_date("lo"), "year"),
        F.date_sub(F.add_months(F.trunc(F.to_date("hi"), "year"), 12), 1),
        F.expr("INTERVAL 1 DAY"),
    )).alias("full_date"))
    return dim_date_from_days(days)


def dim_zone(zone_seed: DataFrame) -> DataFrame:
    """Zone dimension; NULL names (seed text N/A) shown as 'N/A' (L3, I1)."""
    cols = {c.lower(): c for c in zone_seed.columns}
    key = cols.get("location_id") or cols["locationid"]
    return zone_seed.select(
        F.col(key).cast("int").alias("zone_key"),
        F.coalesce(F.col(cols["borough"]), F.lit(NOT_AVAILABLE)).alias("borough"),
        F.coalesce(F.col(cols["zone"]), F.lit(NOT_AVAILABLE)).alias("zone_name"),
        F.coalesce(F.col(cols["service_zone"]), F.lit(NOT_AVAILABLE)).alias("service_zone"),
    )


def dim_payment_type(codes: DataFrame) -> DataFrame:
    """Payment dimension from the code seed (L4)."""
    return codes.select(F.col("payment_type").cast("int").alias("payment_type_key"), "payment_type_name")


def fact_trips(stg: DataFrame, keep=()) -> DataFrame:
    """One row per clean trip, 24 columns, surrogate date key and renamed FKs.

    ``keep`` passes extra columns through (the storage layout's year/month).
    """
    return stg.select(
        date_key("pickup_date").alias("pickup_date_key"),
        "pickup_hour", "pickup_datetime", "dropoff_datetime",
        F.col("pickup_location_id").alias("pickup_zone_key"),
        F.col("dropoff_location_id").alias("dropoff_zone_key"),
        F.col("payment_type").alias("payment_type_key"),
        *FACT_MEASURES,
        *keep,
    )
