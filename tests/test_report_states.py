"""Reports from merged monthly states equal those over the fact's rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripmart.operators import marts, report_states, reports
from tripmart.plans.marts import build_marts, read_marts, read_report_state
from tripmart.plans.monthly import run_months
from tripmart.plans.warehouse import load_months
from tripmart.sources import fixture
from tripmart.sources.reference import payment_type_codes, read_zones_csv

SF = "/root/testdata/sf0.001"
FACT = ("year int, month int, pickup_date_key int, pickup_hour int, pickup_zone_key int, payment_type_key int, total_amount decimal(12,2), "
        "fare_amount decimal(12,2), tip_amount decimal(12,2), trip_distance double, trip_duration_minutes double")


def rows(n):
    rng = random.Random(4)

    def maybe(x):
        return None if rng.random() < 0.1 else x
    out = []
    for _ in range(n):
        m, day = rng.choice((1, 2)), rng.randint(1, 28)
        money = [maybe(Decimal(rng.randint(-500, 9000)) / 100) for _ in range(3)]
        out.append((2024, m, 20240000 + m * 100 + day, maybe(rng.randint(0, 23)), maybe(rng.randint(1, 9)), maybe(rng.randint(0, 7)), *money,
                    maybe(rng.randint(0, 40) / 4), maybe(rng.randint(0, 90) / 2)))
    return out


def same(a, b):
    def plain(df):
        return sorted((tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)
    assert a.columns == b.columns and plain(a) == plain(b)


@pytest.mark.parametrize("n", [0, 1, 600])
def test_reports_from_states_are_those_over_the_rows(spark, n):
    fact = spark.createDataFrame(rows(n), FACT)
    # the states of months are built apart and put together
    state = report_states.report_state(fact.filter("month = 1")).unionByName(report_states.report_state(fact.filter("month = 2")))
    fact = fact.drop("year", "month")
    zones = spark.createDataFrame([(i, "EW"[i % 2], f"Z{i % 5}", "s") for i in range(1, 8)], "zone_key int, borough string, zone_name string, service_zone string")
    dates, codes = marts.dim_date(spark, "2024-01-01", "2024-02-20"), marts.dim_payment_type(payment_type_codes(spark))
    same(report_states.kpi(state), reports.kpi(fact))
    same(report_states.card_tip_rate(state), reports.card_tip_rate(fact))
    same(report_states.date_range(state, dates), reports.date_range(fact, dates))
    same(report_states.weekday_avg(state, dates), reports.weekday_avg(fact, dates))
    same(report_states.trips_by_borough(state, zones), reports.trips_by_borough(fact, zones))
    same(report_states.top_zones(state, zones, 3), reports.top_zones(fact, zones, 3))
    same(report_states.trips_by_hour(state), reports.trips_by_hour(fact))
    same(report_states.trips_by_hour_dense(spark, state), reports.trips_by_hour_dense(spark, fact))
    same(report_states.payments(state, codes), reports.payments(fact, codes))
    same(report_states.payment_share(state, codes), reports.payment_share(fact, codes))


def test_states_are_replaced_with_their_month(spark, lake):
    for m in ("2024-01", "2024-02"):
        (fixture.raw_month_drifted(spark, SF, m) if m == "2024-02" else fixture.raw_month(spark, SF, m)).write.parquet(lake.raw_month(m))
    fixture.zones(spark, SF).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    zones, codes = read_zones_csv(spark, lake.raw_zones), payment_type_codes(spark)
    run_months(spark, lake, ["2024-01", "2024-02"], zones)
    load_months(spark, lake, ["2024-01", "2024-02"])
    build_marts(spark, lake, zones, codes)
    same(report_states.kpi(read_report_state(spark, lake)), reports.kpi(read_marts(spark, lake)["fact_trips"]))
    fixture.raw_month(spark, SF).limit(100).write.mode("overwrite").parquet(lake.raw_month("2024-01"))
    run_months(spark, lake, ["2024-01"], zones)
    load_months(spark, lake, ["2024-01"])
    build_marts(spark, lake, zones, codes, months=["2024-01"])
    state, fact = read_report_state(spark, lake), read_marts(spark, lake)["fact_trips"]
    same(report_states.kpi(state), reports.kpi(fact))
    assert state.filter("month = 1 AND kind = 'hour'").agg(F.sum("trips")).first()[0] <= 100
    assert {r["kind"]: r["n"] for r in state.groupBy("kind").agg(F.sum("trips").alias("n")).collect()} == dict.fromkeys(report_states.KEYS, fact.count())
    assert dt.date(2024, 2, 1) <= report_states.date_range(state, read_marts(spark, lake)["dim_date"]).first()["last_date"]
