"""The documented expected values of the fixture month (FIXTURES.md §3), sf0.01."""

import datetime as dt

import pytest

from tripmart import catalog

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def chain(spark):
    return catalog.Chain(spark, SF)


def test_borough_counts_and_unmatched(spark, chain):
    got = {r["borough"]: r["trips"] for r in catalog.q_trips_by_borough(spark, SF).collect()}
    assert got == {"AFRICA": 1751, "AMERICA": 1760, "ASIA": 1748, "EUROPE": 1727, "MIDDLE EAST": 1844}
    flags = catalog.q_clean_flag_sums(spark, SF).first()
    assert flags["no_zone_match"] == 651 and flags["zero_distance"] == 250 and flags["passenger_missing"] == 1966


def test_card_payments(spark):
    pay = {r["payment_type_name"]: r for r in catalog.q_payments(spark, SF).collect()}
    card = pay["Credit card"]
    assert card["trips"] == 4735 and card["avg_tip"] == 1.858765
    assert round(card["avg_total"] * card["trips"], 2) == 261092.32
    rate = catalog.q_card_tip_rate(spark, SF).first()["card_tip_rate"]
    assert rate == round(8801.25 / 237417.32, 6)


def test_trips_per_weekday(spark):
    got = [r["avg_trips_per_day"] for r in catalog.q_weekday_avg(spark, SF).collect()]
    assert got == [317.2, 314.4, 311.75, 324.0, 322.0, 322.75, 300.25]


def test_kpi_and_clean_pickup_range(spark, chain):
    from pyspark.sql import functions as F
    k = catalog.q_kpi(spark, SF).first()
    assert (k["trips"], k["revenue"]) == (9481, 517829.66)
    r = chain.clean.agg(F.min("pickup_datetime").alias("lo"), F.max("pickup_datetime").alias("hi")).first()
    assert (r["lo"], r["hi"]) == (dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 1, 30, 23, 57, 12, 194062))


def test_duration_sum_and_gate(spark, chain):
    from pyspark.sql import functions as F
    total = chain.clean.agg(F.sum(F.expr("timestampdiff(SECOND, pickup_datetime, dropoff_datetime)"))).first()[0]
    assert total == 14681200
    checks = {r["check_name"]: r for r in catalog.q_gate_checks(spark, SF).collect()}
    assert checks["non_clean_rate"]["value"] == 0.0519 and checks["non_clean_rate"]["passed"]
    assert checks["hard_reject_rate"]["value"] == 0.0079 and not checks["hard_reject_rate"]["passed"]
