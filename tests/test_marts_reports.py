"""Star-schema models and report semantics on small hand-made tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tripmart.operators import marts, reports
from tripmart.operators.marts import FACT_MEASURES, STG_COLUMNS
from tripmart.sources.reference import payment_type_codes

FACT_SCHEMA = ("pickup_date_key int, pickup_hour int, pickup_zone_key int, payment_type_key int, "
               "fare_amount decimal(12,2), tip_amount decimal(12,2), total_amount decimal(12,2), "
               "trip_distance double, trip_duration_minutes double")


def fact(spark, rows):
    return spark.createDataFrame(
        [(d, h, z, p, Decimal(str(f)), Decimal(str(t)), Decimal(str(tot)), dist, dur)
         for d, h, z, p, f, t, tot, dist, dur in rows], FACT_SCHEMA)


def dim_zone(spark):
    seed = spark.createDataFrame([(1, "East", "Riverside", "Boro"), (2, "East", "Riverside", "Boro"),
                                  (3, "West", "Allerton", None), (4, None, None, None)],
                                 "location_id int, borough string, zone string, service_zone string")
    return marts.dim_zone(seed)


def test_dim_date_values_and_iso_weekday(spark):
    d = {r["full_date"]: r for r in marts.dim_date(spark).collect()}
    assert len(d) == 1096
    jan1 = d[dt.date(2024, 1, 1)]
    assert (jan1["date_key"], jan1["year"], jan1["quarter"], jan1["month"], jan1["day_of_month"]) == (20240101, 2024, 1, 1, 1)
    assert (jan1["month_name"], jan1["day_name"], jan1["day_of_week"], jan1["is_weekend"]) == ("January", "Monday", 1, False)
    sun = d[dt.date(2025, 1, 5)]
    assert (sun["day_of_week"], sun["day_name"], sun["is_weekend"]) == (7, "Sunday", True)
    assert d[dt.date(2026, 12, 31)]["quarter"] == 4


def test_dim_date_covering_data_years(spark):
    ts = spark.createDataFrame([(dt.datetime(2024, 3, 5, 10),), (dt.datetime(2025, 7, 1),)], "ts timestamp_ntz")
    days = marts.dim_date_covering(ts, "ts").agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert tuple(days) == (dt.date(2024, 1, 1), dt.date(2025, 12, 31), 731)


def test_dim_zone_shows_missing_names_as_na(spark):
    z = {r["zone_key"]: r for r in dim_zone(spark).collect()}
    assert (z[4]["borough"], z[4]["zone_name"], z[3]["service_zone"]) == ("N/A", "N/A", "N/A")


def test_dim_payment_type_codes(spark):
    p = marts.dim_payment_type(payment_type_codes(spark)).orderBy("payment_type_key").collect()
    assert [r["payment_type_key"] for r in p] == list(range(7)) and p[1]["payment_type_name"] == "Credit card"


def test_stg_and_fact_shapes(spark):
    staging = spark.createDataFrame([(dt.datetime(2024, 1, 15, 23, 59, 59),)], "pickup_datetime timestamp_ntz")
    for c in STG_COLUMNS:
        if c not in ("pickup_datetime", "pickup_date", "pickup_hour"):
            staging = staging.withColumn(c, F.lit(None).cast("int"))
    stg = marts.stg_trips(staging)
    assert stg.columns == STG_COLUMNS and len(STG_COLUMNS) == 31
    row = stg.first()
    assert (row["pickup_date"], row["pickup_hour"]) == (dt.date(2024, 1, 15), 23)
    f = marts.fact_trips(stg)
    assert len(f.columns) == 24 and f.columns[:2] == ["pickup_date_key", "pickup_hour"]
    assert f.first()["pickup_date_key"] == 20240115 and f.columns[-len(FACT_MEASURES):] == FACT_MEASURES


def test_top_zones_merge_equal_names_and_break_ties_by_name(spark):
    f = fact(spark, [(20240101, 1, 1, 1, 10, 1, 15, 1.0, 5.0), (20240101, 1, 2, 1, 10, 1, 15, 1.0, 5.0),
                     (20240101, 1, 3, 2, 10, 0, 15, 1.0, 5.0), (20240101, 1, 3, 2, 10, 0, 15, 1.0, 5.0),
                     (20240101, 1, 99, 2, 10, 0, 15, 1.0, 5.0)])
    top = [(r["zone_name"], r["trips"]) for r in reports.top_zones(f, dim_zone(spark)).collect()]
    assert top == [("Allerton", 2), ("Riverside", 2)]  # two zones named Riverside merge; zone 99 has no row
    boroughs = [(r["borough"], r["trips"]) for r in reports.trips_by_borough(f, dim_zone(spark)).collect()]
    assert boroughs == [("East", 2), ("West", 2)]


def test_card_tip_rate_is_null_without_card_fares(spark):
    f = fact(spark, [(20240101, 1, 1, 2, 10, 1, 15, 1.0, 5.0), (20240101, 1, 1, 1, 0, 1, 15, 1.0, 5.0)])
    assert reports.card_tip_rate(f).first()["card_tip_rate"] is None
    f2 = fact(spark, [(20240101, 1, 1, 1, 10, 2.5, 15, 1.0, 5.0), (20240101, 1, 1, 1, -4, 9, 1, 1.0, 5.0)])
    assert reports.card_tip_rate(f2).first()["card_tip_rate"] == 0.25


def test_kpi_and_shares_on_empty_fact(spark):
    empty = fact(spark, [])
    k = reports.kpi(empty).first()
    assert (k["trips"], k["revenue"], k["avg_fare"]) == (0, 0.0, None)
    assert reports.payment_share(empty, marts.dim_payment_type(payment_type_codes(spark))).count() == 0
    dense = reports.trips_by_hour_dense(spark, empty).collect()
    assert len(dense) == 24 and all(r["trips"] == 0 for r in dense)


def test_payment_share_uses_all_fact_trips(spark):
    f = fact(spark, [(20240101, 1, 1, 1, 10, 1, 15, 1.0, 5.0), (20240101, 1, 1, 9, 10, 1, 15, 1.0, 5.0)])
    rows = reports.payment_share(f, marts.dim_payment_type(payment_type_codes(spark))).collect()
    assert [(r["payment_type_name"], r["trips"], r["share_pct"]) for r in rows] == [("Credit card", 1, 50.0)]


def test_weekday_average_counts_distinct_dates(spark):
    dd = marts.dim_date(spark, "2024-01-01", "2024-01-14")
    f = fact(spark, [(20240101, 1, 1, 1, 10, 1, 15, 1.0, 5.0)] * 3 + [(20240108, 1, 1, 1, 10, 1, 15, 1.0, 5.0)]
             + [(20300101, 1, 1, 1, 10, 1, 15, 1.0, 5.0)])
    rows = [(r["day_of_week"], r["day_name"], r["avg_trips_per_day"]) for r in reports.weekday_avg(f, dd).collect()]
    assert rows == [(1, "Monday", 2.0)]  # 4 trips over 2 Mondays; the 2030 trip has no calendar row
    rng = reports.date_range(f, dd).first()
    assert (rng["first_date"], rng["last_date"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 8))


def test_recent_loads_and_latest_reasons(spark):
    audit = spark.createDataFrame(
        [(i, "2024-01", 10, 10, "success", dt.datetime(2024, 2, 1, 12, i, tzinfo=dt.timezone.utc)) for i in range(1, 8)],
        "load_id bigint, source_month string, rows_in_parquet bigint, rows_loaded bigint, status string, finished_at timestamp")
    got = reports.recent_loads(audit).collect()
    assert [r["load_id"] for r in got] == [7, 6, 5, 4, 3] and got[0]["finished_utc"] == "2024-02-01 12:07"
    reasons = spark.createDataFrame([("2024-01", "clean", 9), ("2024-01", "negative_fare", 1),
                                     ("2024-02", "clean", 8), ("2024-02", "negative_fare", 1),
                                     ("2024-02", "pickup_outside_month", 1)], "month string, reason string, rows bigint")
    latest = [(r["reason"], r["rows"]) for r in reports.latest_reject_reasons(reasons).collect()]
    assert latest == [("negative_fare", 1), ("pickup_outside_month", 1)]


def test_quality_by_month_marks_missing_reports(spark):
    runs = spark.createDataFrame([("2024-01", 10, 9, 1), ("2024-02", 10, 10, 0)],
                                 "month string, rows_in bigint, rows_clean bigint, rows_rejected_or_quarantined bigint")
    gates = spark.createDataFrame([("2024-01", "passed")], "month string, status string")
    assert [r["status"] for r in reports.quality_by_month(runs, gates).collect()] == ["passed", "n/a"]
