"""Data tests: counts of failing rows per test, NULL handling, one report."""

import datetime as dt

from pyspark.sql import functions as F

from tripmart.operators import dq
from tripmart.operators.warehouse import contract_violations, extra_columns, status_domain_violations, to_staging


def dims(spark):
    return {
        "dim_date": spark.createDataFrame([(20240101, dt.date(2024, 1, 1)), (20240102, dt.date(2024, 1, 2)),
                                           (20240102, dt.date(2024, 1, 3))], "date_key int, full_date date"),
        "dim_zone": spark.createDataFrame([(1,), (2,), (None,)], "zone_key int"),
        "dim_payment_type": spark.createDataFrame([(1,), (2,)], "payment_type_key int"),
    }


def fact(spark):
    rows = [
        (20240101, 1, 2, 1, 5.0, 10.0, dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2)),
        (20240105, 1, 7, 1, 150.0, 10.0, dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2)),
        (None, 9, 7, None, 1.0, -1.0, dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 1, 2)),
    ]
    return spark.createDataFrame(rows, "pickup_date_key int, pickup_zone_key int, dropoff_zone_key int, "
                                       "payment_type_key int, trip_distance double, fare_amount double, "
                                       "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz")


def test_relationship_failures_count_rows_per_missing_key(spark):
    got = {r["dropoff_zone_key"]: r["failing_rows"] for r in
           dq.relationship_failures(fact(spark), "dropoff_zone_key", dims(spark)["dim_zone"], "zone_key").collect()}
    assert got == {7: 2}
    # NULL child keys are not relationship failures (not_null covers them)
    got = dq.relationship_failures(fact(spark), "pickup_date_key", dims(spark)["dim_date"], "date_key").collect()
    assert [(r[0], r[1]) for r in got] == [(20240105, 1)]


def test_summary_counts_every_test(spark):
    f = fact(spark)
    staging = spark.createDataFrame([(dt.datetime(2024, 1, 1), None)], "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz")
    report = {r["test_name"]: (r["failures"], r["passed"]) for r in dq.dq_summary(staging, f, dims(spark)).collect()}
    assert report["not_null:staging.yellow_trips.dropoff_datetime"] == (1, False)
    assert report["not_null:fact_trips.pickup_date_key"] == (1, False)
    assert report["relationships:fact_trips.pickup_zone_key->dim_zone.zone_key"] == (1, False)
    assert report["relationships:fact_trips.dropoff_zone_key->dim_zone.zone_key"] == (2, False)
    assert report["relationships:fact_trips.payment_type_key->dim_payment_type.payment_type_key"] == (0, True)
    assert report["fact_distance_within_limit"] == (1, False)
    assert report["fact_no_negative_fare"] == (1, False)
    assert report["fact_dropoff_not_before_pickup"] == (1, False)
    assert report["fact_row_count_matches_staging"] == (1, False)  # 3 fact rows vs 1 staging row
    assert report["unique:dim_date.date_key"] == (1, False)
    assert report["unique:dim_date.full_date"] == (0, True)
    assert report["not_null:dim_zone.zone_key"] == (1, False)
    assert report["unique:dim_zone.zone_key"] == (0, True)  # NULLs are ignored by unique
    assert len(report) == 22


def test_rowcount_matches(spark):
    r = dq.rowcount_matches(fact(spark), fact(spark)).first()
    assert (r["staging_rows"], r["fact_rows"], r["matches"]) == (3, 3, True)


def _clean_row(spark, distance):
    from tripmart.contracts import CLEAN_FILE_COLUMNS
    types = {"pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz", "store_and_fwd_flag": "string",
             "pickup_borough": "string", "pickup_zone": "string", "dropoff_borough": "string", "dropoff_zone": "string",
             "passenger_count_missing": "boolean", "zero_distance": "boolean", "trip_duration_minutes": "decimal(27,6)",
             "vendor_id": "int", "passenger_count": "int", "rate_code_id": "int", "pickup_location_id": "int",
             "dropoff_location_id": "int", "payment_type": "int"}
    df = spark.range(1).select(
        *[F.lit(None).cast(types.get(c, "double")).alias(c) for c in CLEAN_FILE_COLUMNS],
        F.lit(2024).alias("year"), F.lit(1).alias("month"))
    return (df.withColumn("pickup_datetime", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
            .withColumn("dropoff_datetime", F.lit(dt.datetime(2024, 1, 1, 0, 30)).cast("timestamp_ntz"))
            .withColumn("fare_amount", F.lit(1.005))
            .withColumn("trip_distance", F.lit(distance).cast("double"))
            .withColumn("passenger_count_missing", F.lit(True))
            .withColumn("zero_distance", F.col("trip_distance") == 0))


def test_staging_projection_and_contract(spark):
    st = to_staging(_clean_row(spark, 0.0))
    types = dict(st.dtypes)
    assert types["fare_amount"] == "decimal(12,2)" and types["year"] == "smallint" and types["loaded_at"] == "timestamp"
    assert str(st.first()["fare_amount"]) == "1.01"  # Spark rounds half up from the decimal text (T7)
    v = {r["column_name"]: r for r in contract_violations(st).collect()}
    assert all(r["ok"] for r in v.values()) and len(v) == 30
    bad = {r["column_name"]: r["null_violations"] for r in contract_violations(to_staging(_clean_row(spark, None))).collect()}
    assert bad["zero_distance"] == 1 and bad["passenger_count_missing"] == 0
    assert extra_columns(st.withColumn("junk", F.lit(1))) == ["junk"]


def test_audit_status_domain(spark):
    audit = spark.createDataFrame([("success",), ("failed",), ("running",), (None,)], "status string")
    assert status_domain_violations(audit).count() == 2
