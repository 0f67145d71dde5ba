"""Quality gate over several months at once, its reports and exit codes."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tripmart.operators.quality import gate_checks, gate_report, gate_status
from tripmart.operators.reports import quality_by_month
from tripmart.plans.gate import evaluate_months, read_gate_reports
from tripmart.sources.lake import read_gate_documents, read_summary_documents

CHECKS = ["has_rows", "row_conservation", "reasons_add_up", "non_clean_rate", "hard_reject_rate"]
SCHEMA = ("month string, rows_in bigint, rows_clean bigint, rows_rejected_or_quarantined bigint, "
          "counts_by_reason map<string,bigint>")

# Published counts of one real month.
PUBLISHED = ("2025-01", 3475226, 3330824, 144402,
             {"clean": 3330824, "negative_fare": 144094, "distance_over_100_miles": 162, "dropoff_before_pickup": 124, "pickup_outside_month": 22})

# Months of 8,000 rows, each told by what it breaks: (month, rows in, clean, set aside, reasons) -> failing checks.
MONTHS = [
    (PUBLISHED, set()),
    (("2019-01", 8000, 8000, 0, {"clean": 8000}), set()),
    (("2019-02", 8000, 7199, 801, {"clean": 7199, "negative_fare": 801}), {"non_clean_rate"}),
    (("2019-03", 8000, 7200, 800, {"clean": 7200, "negative_fare": 800}), set()),  # a tenth is allowed
    (("2019-04", 8000, 7991, 9, {"clean": 7991, "missing_timestamp": 9}), {"hard_reject_rate"}),
    (("2019-05", 8000, 7992, 8, {"clean": 7992, "missing_timestamp": 3, "pickup_outside_month": 5}), set()),  # a thousandth is allowed
    (("2019-06", 8000, 7950, 40, {"clean": 7950, "distance_over_100_miles": 50}), {"row_conservation"}),
    (("2019-07", 8000, 7950, 50, {"clean": 7950, "distance_over_100_miles": 49}), {"reasons_add_up"}),
    (("2019-08", 0, 0, 0, {}), {"has_rows", "non_clean_rate", "hard_reject_rate"}),
    (("2019-09", 40, 0, 40, {"dropoff_before_pickup": 40}), {"has_rows", "non_clean_rate", "hard_reject_rate"}),
]


@pytest.fixture()
def summaries(spark):
    return spark.createDataFrame([m for m, _ in MONTHS], SCHEMA)


def persist(df, lake):
    (df.withColumn("finished_at_utc", F.lit("t")).withColumn("duration_seconds", F.lit(0.5))
     .write.mode("append").partitionBy("month").json(lake.runs))


def test_each_month_fails_what_it_breaks_and_nothing_else(summaries):
    failed = {}
    for r in gate_checks(summaries, 0.1, 0.001).collect():
        failed.setdefault(r["month"], set())
        if not r["passed"]:
            failed[r["month"]].add(r["check_name"])
    assert failed == {m[0]: broken for m, broken in MONTHS}


def test_values_are_rates_rounded_for_the_report_only(summaries):
    rows = {(r["month"], r["check_name"]): r for r in gate_checks(summaries, 0.1, 0.001).collect()}
    for m, _ in MONTHS:
        month, n, clean, aside, reasons = m
        hard = sum(reasons.get(k, 0) for k in ("missing_timestamp", "dropoff_before_pickup", "pickup_outside_month"))
        assert rows[month, "non_clean_rate"]["value"] == pytest.approx(aside / n if n else 1.0, abs=6e-6)
        assert rows[month, "hard_reject_rate"]["value"] == pytest.approx(hard / n if n else 1.0, abs=6e-7)
        assert rows[month, "row_conservation"]["value"] == clean + aside
        assert rows[month, "reasons_add_up"]["threshold"] == str(n)


def test_thresholds_are_the_callers(summaries):
    strict = {r["month"]: r["status"] for r in gate_status(gate_checks(summaries, 0.0, 0.0)).collect()}
    assert [m for m, s in strict.items() if s == "passed"] == ["2019-01"]
    loose = {r["month"]: r["status"] for r in gate_status(gate_checks(summaries, 1.0, 1.0)).collect()}
    assert {m for m, s in loose.items() if s == "failed"} == {"2019-06", "2019-07", "2019-08", "2019-09"}


def test_report_lists_the_checks_in_order(summaries):
    for r in gate_report(gate_checks(summaries)).collect():
        assert [c["check_name"] for c in r["checks"]] == CHECKS


def test_evaluation_covers_passing_failing_absent_and_broken_summaries(spark, lake, summaries):
    assert evaluate_months(spark, lake, ["2019-01"]) == {"2019-01": "missing"}  # nothing was ever cleaned
    persist(summaries.filter("month IN ('2019-01', '2019-02', '2019-08')"), lake)
    persist(summaries.filter("month = '2019-03'").drop("counts_by_reason"), lake)  # lacks a required key
    got = evaluate_months(spark, lake, ["2019-01", "2019-02", "2019-03", "2019-08", "2020-01"])
    assert got == {"2019-01": "passed", "2019-02": "failed", "2019-03": "invalid", "2019-08": "failed", "2020-01": "missing"}
    reports = {r["month"]: r["status"] for r in read_gate_reports(spark, lake).collect()}
    assert reports == {"2019-01": "passed", "2019-02": "failed", "2019-08": "failed"}
    evaluate_months(spark, lake, ["2019-02"], max_non_clean_rate=0.5)  # a later evaluation replaces its month only
    reports = {r["month"]: r["status"] for r in read_gate_reports(spark, lake).collect()}
    assert reports == {"2019-01": "passed", "2019-02": "passed", "2019-08": "failed"}


def test_documents_of_one_file_per_month(spark, lake):
    root = lake.root.removeprefix("file:")
    for folder in ("runs", "gates"):
        os.makedirs(f"{root}/{folder}")
    for m, _ in MONTHS[1:4]:
        doc = dict(zip(("month", "rows_in", "rows_clean", "rows_rejected_or_quarantined", "counts_by_reason"), m))
        with open(f"{root}/runs/clean_{m[0]}.json", "w") as f:
            json.dump({**doc, "finished_at_utc": "t", "duration_seconds": 3.0}, f, indent=1)
    for name in ("runs/readme.json", "gates/clean_2019-01.json"):
        with open(f"{root}/{name}", "w") as f:
            f.write("{}")
    with open(f"{root}/gates/quality_2019-02.json", "w") as f:
        json.dump({"month": "2019-02", "status": "failed", "evaluated_at_utc": "t", "checks": []}, f, indent=1)
    runs, gates = read_summary_documents(spark, f"{root}/runs"), read_gate_documents(spark, f"{root}/gates")
    got = [(r["month"], r["rows_clean"], r["status"]) for r in quality_by_month(runs, gates).collect()]
    assert got == [("2019-01", 8000, "n/a"), ("2019-02", 7199, "failed"), ("2019-03", 7200, "n/a")]
