"""All report datasets over the materialised marts in one call.

The original renders these as an HTML page; here they are DataFrames, and
``publish_dashboard`` writes each (a handful of rows) as a JSON table under
``warehouse/reports/<name>/`` for any BI tool. An empty fact is an error, as
there is nothing to report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.operators import reports
from tripmart.operators.quality import reasons_long
from tripmart.plans.gate import read_gate_reports
from tripmart.plans.marts import read_marts
from tripmart.plans.monthly import read_run_summaries
from tripmart.plans.publish import FileOps
from tripmart.plans.warehouse import read_audit
from tripmart.sources.lake import Lake


class NothingToReport(RuntimeError):
    """The fact table has no rows."""


def dashboard_datasets(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    marts = read_marts(spark, lake)
    fact, dd, dz, dp = marts["fact_trips"], marts["dim_date"], marts["dim_zone"], marts["dim_payment_type"]
    out = {
        "kpi": reports.kpi(fact),
        "card_tip_rate": reports.card_tip_rate(fact),
        "date_range": reports.date_range(fact, dd),
        "trips_by_borough": reports.trips_by_borough(fact, dz),
        "top_zones": reports.top_zones(fact, dz),
        "trips_by_hour": reports.trips_by_hour_dense(spark, fact),
        "weekday_avg": reports.weekday_avg(fact, dd),
        "payments": reports.payment_share(fact, dp),
    }
    ops = FileOps(spark)
    if ops.exists(lake.audit_table):
        out["recent_loads"] = reports.recent_loads(read_audit(spark, lake))
    if ops.exists(lake.runs):
        runs = read_run_summaries(spark, lake)
        gates = (read_gate_reports(spark, lake) if ops.exists(lake.quality)
                 else spark.createDataFrame([], "month string, status string"))
        out["quality_by_month"] = reports.quality_by_month(runs, gates)
        out["latest_reject_reasons"] = reports.latest_reject_reasons(reasons_long(runs))
    return out


def publish_dashboard(spark: SparkSession, lake: Lake) -> dict[str, str]:
    """Write every dataset as a small JSON table; refuses an empty fact."""
    if read_marts(spark, lake)["fact_trips"].limit(1).count() == 0:
        raise NothingToReport("fact_trips is empty")
    paths = {}
    for name, df in dashboard_datasets(spark, lake).items():
        path = f"{lake.root.rstrip('/')}/warehouse/reports/{name}"
        df.coalesce(1).write.mode("overwrite").json(path)  # a few rows each
        paths[name] = path
    return paths


def read_dashboard(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    return spark.read.json(f"{lake.root.rstrip('/')}/warehouse/reports/{name}")


__all__ = ["dashboard_datasets", "publish_dashboard", "read_dashboard", "NothingToReport"]
