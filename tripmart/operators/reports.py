"""Reporting datasets over the star schema.

Fact x dimension reports aggregate the fact by its foreign key FIRST (a
partial/final hash aggregate with at most #keys groups), then join the
resulting handful of rows to the dimension. The fact is never shuffled or
broadcast-joined row by row, and the inner-join semantics are unchanged
because the join key is the grouping key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.contracts import CLEAN_LABEL


def _r6(c):
    return F.round(c.cast("double"), 6)


def _mean_money(total, n):
    """An exact decimal sum over its count; cast last, so task order cannot change it."""
    return _r6(total.cast("double") / F.nullif(n, F.lit(0)).cast("double"))


def kpi(fact: DataFrame) -> DataFrame:
    """trips, revenue, average fare / distance / duration."""
    return fact.agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(F.coalesce(F.sum("total_amount"), F.lit(0)).cast("double"), 2).alias("revenue"),
        _mean_money(F.sum("fare_amount"), F.count("fare_amount")).alias("avg_fare"),
        _r6(F.avg(F.col("trip_distance").cast("double"))).alias("avg_distance"),
        _r6(F.avg(F.col("trip_duration_minutes").cast("double"))).alias("avg_duration_minutes"),
    )


def card_tip_rate(fact: DataFrame) -> DataFrame:
    """Σtip / Σfare over card trips with a positive fare; NULL when Σfare is 0."""
    card = fact.filter((F.col("payment_type_key") == 1) & (F.col("fare_amount") > 0))
    tips = F.sum("tip_amount").cast("double")
    fares = F.sum("fare_amount").cast("double")
    return card.agg(_r6(tips / F.nullif(fares, F.lit(0.0))).alias("card_tip_rate"))


def _by_key(fact: DataFrame, key: str, *extra) -> DataFrame:
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias("trips"), *extra)


def date_range(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """First / last calendar date with trips, through the date dimension."""
    return date_range_of(_by_key(fact, "pickup_date_key"), dim_date)


def date_range_of(days: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The same from trips per pickup_date_key."""
    joined = days.join(dim_date, days.pickup_date_key == dim_date.date_key, "inner")
    return joined.agg(F.min("full_date").alias("first_date"), F.max("full_date").alias("last_date"))


def trips_by_borough(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """Trips per pickup borough, most first."""
    return boroughs_of(_by_key(fact, "pickup_zone_key"), dim_zone)


def boroughs_of(per_zone: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """The same from trips per pickup_zone_key."""
    joined = per_zone.join(dim_zone, per_zone.pickup_zone_key == dim_zone.zone_key, "inner")
    return (joined.groupBy("borough").agg(F.sum("trips").cast("bigint").alias("trips"))
            .orderBy(F.desc("trips"), F.asc("borough")))


def top_zones(fact: DataFrame, dim_zone: DataFrame, k: int = 10) -> DataFrame:
    """Top-k pickup zone NAMES by trips; equal names merge, ties break by name."""
    return top_zones_of(_by_key(fact, "pickup_zone_key"), dim_zone, k)


def top_zones_of(per_zone: DataFrame, dim_zone: DataFrame, k: int = 10) -> DataFrame:
    """The same from trips per pickup_zone_key."""
    joined = per_zone.join(dim_zone, per_zone.pickup_zone_key == dim_zone.zone_key, "inner")
    return (joined.groupBy("zone_name").agg(F.sum("trips").cast("bigint").alias("trips"))
            .orderBy(F.desc("trips"), F.asc("zone_name")).limit(k))


def trips_by_hour(fact: DataFrame) -> DataFrame:
    """Trips per pickup hour, hours with trips only."""
    return fact.groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("trips")).orderBy("pickup_hour")


def trips_by_hour_dense(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """All 24 hours, zero where no trips.

    The per-hour counts hold at most 25 rows (hour() is 0-23 or NULL), a
    bound fixed by the expression's domain, so they are broadcast.
    """
    return dense_hours(spark, fact.groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("trips")))


def dense_hours(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """The same from trips per pickup_hour."""
    hours = spark.range(24).select(F.col("id").cast("int").alias("pickup_hour"))
    return (hours.join(F.broadcast(counts), "pickup_hour", "left")
            .select("pickup_hour", F.coalesce("trips", F.lit(0)).cast("bigint").alias("trips"))
            .orderBy("pickup_hour"))


def weekday_avg(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Average trips per calendar day by ISO weekday = trips / distinct dates.

    Counting per date first makes the distinct count exact and cheap: each
    date is one row after the first aggregate.
    """
    return weekday_avg_of(_by_key(fact, "pickup_date_key"), dim_date)


def weekday_avg_of(days: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The same from trips per pickup_date_key."""
    joined = days.join(dim_date, days.pickup_date_key == dim_date.date_key, "inner")
    return (joined.groupBy("day_of_week", "day_name")
            .agg(_r6(F.sum("trips").cast("double") / F.count_distinct("full_date")).alias("avg_trips_per_day"))
            .orderBy("day_of_week"))


def _per_payment(fact: DataFrame) -> DataFrame:
    """Per payment type: trips, exact money sums and counts, and the trips of the whole fact (one scan)."""
    per_key = fact.groupBy("payment_type_key").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("_st"), F.count("total_amount").alias("_nt"),
        F.sum("tip_amount").alias("_sp"), F.count("tip_amount").alias("_np"),
    )
    # a handful of keys: their total is taken before the inner join drops unknown ones
    return per_key.withColumn("_all", F.sum("trips").over(Window.partitionBy(F.lit(1))))


def _payment_names(per_key: DataFrame, dim_payment: DataFrame) -> DataFrame:
    return (per_key.join(dim_payment, "payment_type_key", "inner").groupBy("payment_type_name").agg(
        F.sum("trips").cast("bigint").alias("trips"),
        _mean_money(F.sum("_st"), F.sum("_nt")).alias("avg_total"),
        _mean_money(F.sum("_sp"), F.sum("_np")).alias("avg_tip"),
        F.max("_all").alias("_all")))


def payments(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Trips, average total and tip per payment name, most trips first."""
    return payments_of(_per_payment(fact), dim_payment)


def payments_of(per_key: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """The same from the sums per payment_type_key."""
    return _payment_names(per_key, dim_payment).drop("_all").orderBy(F.desc("trips"), F.asc("payment_type_name"))


def payment_share(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Payment rows with their share of ALL fact trips."""
    return payment_share_of(_per_payment(fact), dim_payment)


def payment_share_of(per_key: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """The same from the sums per payment_type_key."""
    return (_payment_names(per_key, dim_payment)
            .select("payment_type_name", "trips", "avg_total", "avg_tip",
                    _r6(F.lit(100.0) * F.col("trips") / F.col("_all")).alias("share_pct"))
            .orderBy(F.desc("trips"), F.asc("payment_type_name")))


def recent_loads(audit: DataFrame, k: int = 5) -> DataFrame:
    """Latest k load attempts, finish time as UTC text to the minute."""
    return (audit.orderBy(F.desc("load_id")).limit(k).select(
        "load_id", "source_month", "rows_in_parquet", "rows_loaded", "status",
        F.date_format(F.convert_timezone(None, F.lit("UTC"), F.col("finished_at")), "yyyy-MM-dd HH:mm").alias("finished_utc"),
    ))


def quality_by_month(runs: DataFrame, gates: DataFrame) -> DataFrame:
    """Run summaries with the gate status of the same month, 'n/a' without a report."""
    return (runs.join(gates.select("month", "status"), "month", "left")
            .select("month", "rows_in", "rows_clean", "rows_rejected_or_quarantined",
                    F.coalesce("status", F.lit("n/a")).alias("status"))
            .orderBy("month"))


def latest_reject_reasons(reasons: DataFrame) -> DataFrame:
    """Reasons of the latest month except 'clean', most rows first.

    ``reasons``: (month, reason, rows). The latest month is found by an
    aggregate joined back, not by collecting to the driver.
    """
    latest = reasons.agg(F.max("month").alias("month"))
    return (reasons.join(latest, "month").filter(F.col("reason") != CLEAN_LABEL)
            .select("month", "reason", "rows").orderBy(F.desc("rows"), F.asc("reason")))
