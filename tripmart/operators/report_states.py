"""Mergeable report states: the fact's partial sums per month, enough for every report over it.

``report_state`` takes one scan of a month's fact rows to a few hundred rows: counts, exact money sums and
value counts per pickup date, hour, zone and payment type. States of months add up, so a report over the whole
history merges the months' states and never reads the fact; when a month is replaced, so is its state.

Column ``kind`` says what ``key`` is. A NULL key (a trip without one) is a row of its own. The rows of
one kind add up to all trips; ``card_*`` hold card trips with a positive fare. An empty fact has no state: sums
over it are those of no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.operators import reports

DATE, HOUR, ZONE, PAYMENT = "date", "hour", "zone", "payment"
KEYS = {DATE: "pickup_date_key", HOUR: "pickup_hour", ZONE: "pickup_zone_key", PAYMENT: "payment_type_key"}
MEASURES = {"total": "total_amount", "fare": "fare_amount", "tip": "tip_amount", "distance": "trip_distance", "minutes": "trip_duration_minutes"}
SUMS = ["trips", *(f"{m}_{part}" for m in MEASURES for part in ("sum", "n")), "card_tips", "card_fares"]


def report_state(fact: DataFrame, by=("year", "month")) -> DataFrame:
    """One row per month (columns ``by``), kind and key with the partial sums."""
    card = (F.col("payment_type_key") == 1) & (F.col("fare_amount") > 0)
    keys = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("int").alias("key")) for kind, c in KEYS.items()]))
    rows = fact.select(*by, keys.alias("k"), *MEASURES.values(), F.when(card, F.col("tip_amount")).alias("_tip"),
                       F.when(card, F.col("fare_amount")).alias("_fare"))
    sums = [F.count(F.lit(1)).alias("trips")]
    for name, column in MEASURES.items():
        sums += [F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_n")]
    return rows.groupBy(*by, F.col("k.kind").alias("kind"), F.col("k.key").alias("key")).agg(
        *sums, F.sum("_tip").alias("card_tips"), F.sum("_fare").alias("card_fares"))


def merged(state: DataFrame, kind: str) -> DataFrame:
    """The months' states of one kind added up, the key under its name in the fact."""
    return (state.filter(F.col("kind") == kind).groupBy(F.col("key").alias(KEYS[kind]))
            .agg(*[F.sum(c).alias(c) for c in SUMS]))


def _mean(total: str, n: str):
    return F.round(F.sum(total).cast("double") / F.nullif(F.sum(n), F.lit(0)).cast("double"), 6)


def kpi(state: DataFrame) -> DataFrame:
    return merged(state, PAYMENT).agg(
        F.coalesce(F.sum("trips"), F.lit(0)).cast("bigint").alias("trips"),
        F.round(F.coalesce(F.sum("total_sum"), F.lit(0)).cast("double"), 2).alias("revenue"),
        _mean("fare_sum", "fare_n").alias("avg_fare"), _mean("distance_sum", "distance_n").alias("avg_distance"),
        _mean("minutes_sum", "minutes_n").alias("avg_duration_minutes"))


def card_tip_rate(state: DataFrame) -> DataFrame:
    return merged(state, PAYMENT).agg(F.round(
        F.sum("card_tips").cast("double") / F.nullif(F.sum("card_fares").cast("double"), F.lit(0.0)), 6).alias("card_tip_rate"))


def date_range(state: DataFrame, dim_date: DataFrame) -> DataFrame:
    return reports.date_range_of(merged(state, DATE), dim_date)


def weekday_avg(state: DataFrame, dim_date: DataFrame) -> DataFrame:
    return reports.weekday_avg_of(merged(state, DATE), dim_date)


def trips_by_borough(state: DataFrame, dim_zone: DataFrame) -> DataFrame:
    return reports.boroughs_of(merged(state, ZONE), dim_zone)


def top_zones(state: DataFrame, dim_zone: DataFrame, k: int = 10) -> DataFrame:
    return reports.top_zones_of(merged(state, ZONE), dim_zone, k)


def trips_by_hour(state: DataFrame) -> DataFrame:
    return merged(state, HOUR).select("pickup_hour", "trips").orderBy("pickup_hour")


def trips_by_hour_dense(spark: SparkSession, state: DataFrame) -> DataFrame:
    return reports.dense_hours(spark, merged(state, HOUR).select("pickup_hour", "trips"))


def _per_payment(state: DataFrame) -> DataFrame:
    own = merged(state, PAYMENT).select("payment_type_key", "trips", F.col("total_sum").alias("_st"), F.col("total_n").alias("_nt"),
                                        F.col("tip_sum").alias("_sp"), F.col("tip_n").alias("_np"))
    return own.withColumn("_all", F.sum("trips").over(Window.partitionBy(F.lit(1))))  # one row per payment type


def payments(state: DataFrame, dim_payment: DataFrame) -> DataFrame:
    return reports.payments_of(_per_payment(state), dim_payment)


def payment_share(state: DataFrame, dim_payment: DataFrame) -> DataFrame:
    return reports.payment_share_of(_per_payment(state), dim_payment)
