"""Materialise the star schema from the staging table and run its data tests (B11, L, K)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import DIM_DATE_END, DIM_DATE_START
from tripmart.operators import dq
from tripmart.operators.report_states import report_state
from tripmart.operators.marts import dim_date, dim_payment_type, dim_zone, fact_trips, stg_trips
from tripmart.functions.months import partition_filter, validate_months
from tripmart.plans.publish import clean_partition, commit, new_version, writing, written_partitions
from tripmart.plans.warehouse import read_staging_table
from tripmart.sources.lake import Lake, read_table

#: The fact's mergeable sums per month, which reports read instead of the fact.
STATE_NAME = "report_state"
MART_NAMES = ("dim_date", "dim_zone", "dim_payment_type", "fact_trips")


def staging_view(spark: SparkSession, lake: Lake) -> DataFrame:
    """The staging table with its contract types (partition columns come back as int)."""
    df = read_staging_table(spark, lake)
    return df.withColumn("year", F.col("year").cast("smallint")).withColumn("month", F.col("month").cast("smallint"))


def build_marts(spark: SparkSession, lake: Lake, zone_seed: DataFrame, payment_codes: DataFrame,
                start: str = DIM_DATE_START, end: str = DIM_DATE_END, months=None) -> dict[str, str]:
    """Write the dims and the fact; stg stays a view (temp view ``stg_yellow_trips``).

    The fact is stored partitioned by (year, month) like the staging table.
    With ``months`` only those months' fact partitions are rebuilt, so a monthly
    load does not rewrite the whole history; without it the fact is rebuilt in
    full. Dimensions and fact become current by one commit.
    """
    stg = stg_trips(staging_view(spark, lake))
    stg.createOrReplaceTempView("stg_yellow_trips")
    dims = {
        "dim_date": dim_date(spark, start, end),
        "dim_zone": dim_zone(zone_seed),
        "dim_payment_type": dim_payment_type(payment_codes),
    }
    fact = fact_trips(stg, keep=("year", "month"))
    version, target = new_version(), lake.mart("fact_trips")
    staged = f"{target}/{version}"
    with writing(spark, lake) as lease:
        try:
            for name, df in dims.items():
                df.write.parquet(f"{lake.mart(name)}/{version}")
            if months is not None:
                months = validate_months(months)
                fact = fact.filter(partition_filter(months))
            fact.write.partitionBy("year", "month").parquet(staged)
            written = written_partitions(lease.ops, staged)
            changes = {(lake.mart(name), ""): f"{lake.mart(name)}/{version}" for name in dims}
            changes |= {(target, p): f"{staged}/{p}" for p in written}
            state, sums = lake.mart(STATE_NAME), f"{lake.mart(STATE_NAME)}/{version}"
            if written:  # sums of what was written, a few hundred rows a month
                held = spark.read.parquet(staged)
                (report_state(held).repartition("year", "month").write.partitionBy("year", "month").parquet(sums))
                changes |= {(state, p): f"{sums}/{p}" for p in written}
            if months is not None:
                changes |= {(t, p): None for t in (target, state) for p in map(clean_partition, months) if p not in written}
            commit(lease, changes, whole=(target, state) if months is None else ())  # dimensions, fact and sums switch together
        except Exception:
            for name in (*MART_NAMES, STATE_NAME):
                lease.ops.delete(f"{lake.mart(name)}/{version}")
            raise
    return {name: lake.mart(name) for name in MART_NAMES}


def read_report_state(spark: SparkSession, lake: Lake) -> DataFrame:
    """The sums of every month of the fact."""
    return read_table(spark, lake, lake.mart(STATE_NAME))


def read_marts(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The marts as their models define them (the fact's storage partition columns dropped)."""
    out = {n: read_table(spark, lake, lake.mart(n)) for n in MART_NAMES}
    out["fact_trips"] = out["fact_trips"].drop("year", "month")
    return out


def run_data_tests(spark: SparkSession, lake: Lake, months=None) -> DataFrame:
    """All data tests in one report. With ``months`` the fact and staging tests
    read only those months' partitions (partition pruning); dimension tests
    always cover the whole (small) dimensions."""
    marts = read_marts(spark, lake)
    staging = staging_view(spark, lake)
    if months is not None:
        keep = partition_filter(months)
        fact = read_table(spark, lake, lake.mart("fact_trips")).filter(keep).drop("year", "month")
        marts = {**marts, "fact_trips": fact}
        staging = staging.filter(keep)
    return dq.dq_summary(staging, marts["fact_trips"], marts)
