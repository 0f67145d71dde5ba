"""Profiling aggregates over RAW month files.

Each predicate is counted independently (unlike tagging, where the first
matching rule wins). Column names are the source names; Spark resolves them
case-insensitively, so ``Airport_fee`` and ``airport_fee`` both work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.joins import checked_dimension

from tripmart.functions.months import month_bounds


def row_count(raw: DataFrame) -> DataFrame:
    """Total rows."""
    return raw.agg(F.count(F.lit(1)).alias("total_rows"))


def conditions(raw: DataFrame, month: str) -> DataFrame:
    """Negative fares, dropoff before pickup, NULL passenger count, pickups outside ``month``,
    all in one pass (E21, E22, E24, E26)."""
    start, end = month_bounds(month)
    pickup = F.col("tpep_pickup_datetime")
    return raw.agg(
        F.count_if(F.col("fare_amount") < 0).alias("negative_fares"),
        F.count_if(F.col("tpep_dropoff_datetime") < pickup).alias("bad_times"),
        F.count_if(F.col("passenger_count").isNull()).alias("null_passengers"),
        F.count_if((pickup < start) | (pickup >= end)).alias("outside_month"),
    )


def pickup_range(raw: DataFrame) -> DataFrame:
    """Earliest / latest pickup."""
    return raw.agg(F.min("tpep_pickup_datetime").alias("earliest"), F.max("tpep_pickup_datetime").alias("latest"))


def distance_profile(raw: DataFrame) -> DataFrame:
    """Zero-distance and over-100-mile counts and the maximum distance."""
    d = F.col("trip_distance")
    return raw.agg(F.count_if(d == 0).alias("zero_distance"), F.count_if(d > 100).alias("over_100_miles"),
                   F.max(d).alias("max_distance"))


def negative_fares_by_payment(raw: DataFrame) -> DataFrame:
    """Negative-fare rows per payment type, most first."""
    return (raw.filter(F.col("fare_amount") < 0).groupBy("payment_type")
            .agg(F.count(F.lit(1)).alias("trips")).orderBy(F.desc("trips"), F.asc("payment_type")))


CO_NULL_COLUMNS = ["RatecodeID", "store_and_fwd_flag", "congestion_surcharge", "Airport_fee"]
CO_NULL_ALIASES = ["also_null_ratecode", "also_null_flag", "also_null_congestion", "also_null_airport"]


def co_null(raw: DataFrame, given: str = "passenger_count", columns=None, aliases=None) -> DataFrame:
    """Among rows where ``given`` is NULL, how many have each other column NULL too."""
    columns = columns or CO_NULL_COLUMNS
    aliases = aliases or CO_NULL_ALIASES
    return raw.filter(F.col(given).isNull()).agg(
        F.count(F.lit(1)).alias("null_passenger_rows"),
        *[F.count_if(F.col(c).isNull()).alias(a) for c, a in zip(columns, aliases)],
    )


def null_passengers_by_vendor(raw: DataFrame) -> DataFrame:
    """NULL passenger-count rows by vendor and payment type, most first."""
    return (raw.filter(F.col("passenger_count").isNull()).groupBy("VendorID", "payment_type")
            .agg(F.count(F.lit(1)).alias("trips"))
            .orderBy(F.desc("trips"), F.asc("VendorID"), F.asc("payment_type")))


def sample_rows(raw: DataFrame, n: int = 5, order_by=("tpep_pickup_datetime", "tpep_dropoff_datetime")) -> DataFrame:
    """First n rows in a deterministic order (G4); a top-n, not a full sort."""
    return raw.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)


def partition_counts(df: DataFrame, keys=("year", "month")) -> DataFrame:
    """Rows per partition, ordered by the keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).orderBy(*keys)


def rejected_breakdown(rejected: DataFrame) -> DataFrame:
    """Rejected rows by source month, disposition and reason."""
    return (rejected.groupBy("source_month", "disposition", "reject_reason")
            .agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.asc("source_month"), F.desc("rows"), F.asc("reject_reason")))


def clean_flag_sums(clean: DataFrame) -> DataFrame:
    """Flag counts in clean rows and the average duration rounded to 0.1."""
    return clean.agg(
        F.count_if(F.col("passenger_count_missing")).alias("passenger_missing"),
        F.count_if(F.col("zero_distance")).alias("zero_distance"),
        F.count_if(F.col("pickup_borough").isNull()).alias("no_zone_match"),
        F.round(F.avg(F.col("trip_duration_minutes").cast("double")), 1).alias("avg_minutes"),
    )


def _per_zone(raw: DataFrame) -> DataFrame:
    return raw.groupBy(F.col("PULocationID").alias("zone_id")).agg(F.count(F.lit(1)).alias("trips"))


def busiest_zones(raw: DataFrame, k: int = 5) -> DataFrame:
    """The k pickup locations with the most paid trips."""
    top = _per_zone(raw.filter("fare_amount > 0")).orderBy(F.col("trips").desc(), "zone_id").limit(k)
    return top.withColumnRenamed("zone_id", "PULocationID")


def borough_counts(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """Raw trips per pickup borough (D3, E17): counted per location, so that only as many rows as
    there are locations meet the (checked, broadcast) lookup."""
    names = checked_dimension(zones.select(F.expr("int(LocationID) AS zone_id"), "Borough"), "zone_id")
    return _most_first(_per_zone(raw).join(names, "zone_id"), F.sum("trips").cast("bigint"))


def borough_counts_shuffled(raw: DataFrame, zones: DataFrame) -> DataFrame:
    """The same by a shuffle join of all rows, for lookups too large to broadcast."""
    names = zones.select(F.expr("int(LocationID) AS zone_id"), "Borough").hint("merge")
    return _most_first(raw.select(F.col("PULocationID").alias("zone_id")).join(names, "zone_id"), F.count(F.lit(1)))


def _most_first(rows: DataFrame, trips) -> DataFrame:
    return rows.groupBy("Borough").agg(trips.alias("trips")).orderBy(F.col("trips").desc(), "Borough")
