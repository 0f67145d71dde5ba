"""Quality gate over persisted run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import DEFAULT_MAX_HARD_REJECT_RATE, DEFAULT_MAX_NON_CLEAN_RATE, SUMMARY_REQUIRED_KEYS
from tripmart.functions.months import validate_months
from tripmart.operators.quality import gate_checks, gate_report
from tripmart.plans.monthly import read_run_summaries
from tripmart.plans.publish import FileOps
from tripmart.sources.lake import Lake

GATE_REPORT_SCHEMA = ("status string, checks array<struct<check_order:int,check_name:string,passed:boolean,"
                      "value:double,threshold:string>>, evaluated_at_utc string, month string")


def evaluate_months(spark: SparkSession, lake: Lake, months,
                    max_non_clean_rate: float = DEFAULT_MAX_NON_CLEAN_RATE,
                    max_hard_reject_rate: float = DEFAULT_MAX_HARD_REJECT_RATE) -> dict[str, str]:
    """Evaluate and persist the gate for ``months`` (report written on pass AND fail).

    Returns {month: 'passed' | 'failed' | 'missing' | 'invalid'}: 'missing' without a run summary,
    'invalid' if it lacks a required key (J8). Neither keeps other months from their reports.
    """
    months = validate_months(months)
    if not FileOps(spark).exists(lake.runs):
        return {m: "missing" for m in months}
    runs = read_run_summaries(spark, lake).filter(F.col("month").isin(*months))
    # with a fixed read schema, a document that lacks a key shows it as NULL
    lacks = F.greatest(*[F.col(k).isNull() for k in SUMMARY_REQUIRED_KEYS])
    status = {r["month"]: "invalid" for r in runs.filter(lacks).select("month").collect()}
    report = gate_report(gate_checks(runs.filter(~lacks), max_non_clean_rate, max_hard_reject_rate))
    rows = report.collect()  # one row per month
    if rows:
        (spark.createDataFrame(rows, report.schema).coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("month").json(lake.quality))
    status |= {r["month"]: r["status"] for r in rows}
    return {m: status.get(m, "missing") for m in months}


def read_gate_reports(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(GATE_REPORT_SCHEMA).json(lake.quality)
