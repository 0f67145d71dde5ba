"""Raw trips derived from the driver's ``events`` table.

The driver's tables hold no trips, so a raw month in the source layout
(original column names, mixed int widths, ``Airport_fee`` capitalised,
``cbd_congestion_fee`` absent) is derived row by row from ``events``. The
derivation is a pure projection, so its size grows with ``events`` and it
stays one narrow stage. The same derivation exists as DuckDB SQL in
``tripmart.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fixture month, and the shift that produces the second month.
FIXTURE_MONTH = "2024-01"
SECOND_MONTH = "2024-02"
SECOND_MONTH_SHIFT_DAYS = 31
MONTH_SHIFT = {FIXTURE_MONTH: 0, SECOND_MONTH: SECOND_MONTH_SHIFT_DAYS}


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The tables are read-only, so the relation (file listing
    and footer schema) is resolved once per session and reused by every query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def payment_code(i: Column) -> Column:
    r = i % 10
    return (
        F.when(r <= 1, F.lit(0))
        .when(r <= 6, F.lit(1))
        .when(r <= 8, F.lit(2))
        .otherwise(F.lit(3) + i % 3)
    ).cast("bigint")


def _days(n) -> Column:
    return F.make_dt_interval(F.lit(n), F.lit(0), F.lit(0), F.lit(0))


def _raw_columns(shift_days: int) -> dict[str, Column]:
    i, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
    ts = F.col("ts").cast("timestamp_ntz")
    if shift_days:
        ts = ts + _days(shift_days)
    base = F.when(i % 400 == 3, ts + _days(31)).otherwise(ts)
    pay = payment_code(i)
    no_pax = pay == 0  # payment type 0 leaves five columns NULL together

    def unless_no_pax(c):
        return F.when(no_pax, F.lit(None)).otherwise(c)

    dropoff = F.when(
        i % 300 == 11, base - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(10), F.lit(0))
    ).otherwise(base + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (u * 20 + 60).cast("int")))
    distance = (
        F.when(i % 250 == 13, F.lit(150.0))
        .when(i % 250 == 14, F.lit(100.0))
        .when(i % 40 == 5, F.lit(0.0))
        .otherwise(v / 10)
    )
    fare = F.when(i % 25 == 4, -v).otherwise(v)
    return {
        "VendorID": (i % 2 + 1).cast("int"),
        "tpep_pickup_datetime": F.when(i % 500 == 7, F.lit(None).cast("timestamp_ntz")).otherwise(base),
        "tpep_dropoff_datetime": dropoff,
        "passenger_count": unless_no_pax(i % 6 + 1).cast("bigint"),
        "trip_distance": distance.cast("double"),
        "RatecodeID": unless_no_pax(i % 5 + 1).cast("bigint"),
        "store_and_fwd_flag": unless_no_pax(F.when(i % 50 == 1, F.lit("Y")).otherwise(F.lit("N"))).cast("string"),
        "PULocationID": (u % 27).cast("int"),
        "DOLocationID": ((i * 7) % 27).cast("int"),
        "payment_type": pay,
        "fare_amount": fare.cast("double"),
        "extra": ((i % 3) * 0.5).cast("double"),
        "mta_tax": F.lit(0.5).cast("double"),
        "tip_amount": F.when(pay == 1, (i % 16) * 0.25).otherwise(F.lit(0.0)).cast("double"),
        "tolls_amount": F.when(i % 20 == 0, F.lit(6.5)).otherwise(F.lit(0.0)).cast("double"),
        "improvement_surcharge": F.lit(1.0).cast("double"),
        "total_amount": (fare + 5.0).cast("double"),
        "congestion_surcharge": unless_no_pax(F.lit(2.5)).cast("double"),
        "Airport_fee": unless_no_pax(F.when(u % 27 == 0, F.lit(1.75)).otherwise(F.lit(0.0))).cast("double"),
    }


def raw_trips_from_events(events: DataFrame, shift_days: int = 0) -> DataFrame:
    """Project ``events`` into raw trip records (source column names and types)."""
    return events.select(*[c.alias(n) for n, c in _raw_columns(shift_days).items()])


def raw_trips_drifted(events: DataFrame, shift_days: int = 0) -> DataFrame:
    """Same trips in the newer source schema: ``airport_fee`` lower-case,
    passenger_count INT, and ``cbd_congestion_fee`` present (0.75 on card trips)."""
    cols = _raw_columns(shift_days)
    cols["passenger_count"] = cols["passenger_count"].cast("int")
    cols["airport_fee"] = cols.pop("Airport_fee")
    cols["cbd_congestion_fee"] = F.when(payment_code(F.col("event_id")) == 1, F.lit(0.75)).otherwise(F.lit(0.0))
    return events.select(*[c.alias(n) for n, c in cols.items()])


def raw_month(spark: SparkSession, sf_dir: str, month: str = FIXTURE_MONTH) -> DataFrame:
    """Raw trips of one fixture month (2024-01, or 2024-02 = events shifted 31 days)."""
    return raw_trips_from_events(table(spark, sf_dir, "events"), MONTH_SHIFT[month])


def raw_month_drifted(spark: SparkSession, sf_dir: str, month: str = SECOND_MONTH) -> DataFrame:
    return raw_trips_drifted(table(spark, sf_dir, "events"), MONTH_SHIFT[month])


def raw_months(spark: SparkSession, sf_dir: str, months=(FIXTURE_MONTH,)) -> DataFrame:
    """Raw fixture trips for several months, tagged with ``source_month``."""
    parts = [raw_month(spark, sf_dir, m).withColumn("source_month", F.lit(m)) for m in months]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup as the original CSV presents it: all-string columns.

    LocationID = nation key, Zone = nation name, Borough = region name,
    service_zone = region name except region 1 (missing, to exercise N/A).
    Location ids 25 and 26 of the trips have no zone on purpose.
    """
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_regionkey") == 1, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("service_zone"),
    )
