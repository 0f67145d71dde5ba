"""The month flow as one driver function (N1, N3): clean -> gate -> load -> marts -> tests.

Stages run in order over all requested months at once. A month that fails a
stage leaves the flow there (for one month: stop at the first failure); the
other months continue. The result carries a status per stage and per month
and the worst outcome code: 0 ok, 1 failed input, 2 invalid month, 3 mismatch
/ gate or test failure.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tripmart.contracts import AUDIT_ERROR_MAX_CHARS, DEFAULT_MAX_HARD_REJECT_RATE, DEFAULT_MAX_NON_CLEAN_RATE, DIM_DATE_END, DIM_DATE_START
from tripmart.functions.months import InvalidMonth, validate_months
from tripmart.plans.gate import evaluate_months
from tripmart.plans.marts import build_marts, run_data_tests
from tripmart.plans.monthly import FAILED_INPUT, INVALID_MONTH, MISMATCH, OK, run_months_batched
from tripmart.plans.publish import FileOps, LakeBusy, clean_partition, folder_of, partitions, writing
from tripmart.plans.warehouse import load_months
from tripmart.sources.lake import Lake, read_table
from tripmart.sources.reference import payment_type_codes, read_lake_zones


@dataclass
class FlowResult:
    months: list[str]
    stages: dict[str, str] = field(default_factory=dict)
    code: int = OK
    detail: dict = field(default_factory=dict)
    month_status: dict = field(default_factory=dict)


def run_flow(spark: SparkSession, lake: Lake, months, zone_seed: DataFrame | None = None,
             max_non_clean_rate: float = DEFAULT_MAX_NON_CLEAN_RATE,
             max_hard_reject_rate: float = DEFAULT_MAX_HARD_REJECT_RATE,
             dim_start: str = DIM_DATE_START, dim_end: str = DIM_DATE_END,
             staging_table_name: str | None = None) -> FlowResult:
    """Run the stages for ``months``; with ``staging_table_name`` the staging
    table is registered under that name and the loaded months' statistics
    are refreshed after the load."""
    try:
        months = validate_months(months)
    except InvalidMonth as exc:
        return FlowResult(months=[], stages={"validate": "failed"}, code=INVALID_MONTH, detail={"error": str(exc)})
    try:
        with writing(spark, lake):  # one lease from the first stage to the last
            return _run_flow(spark, lake, months, zone_seed, max_non_clean_rate, max_hard_reject_rate, dim_start, dim_end, staging_table_name)
    except LakeBusy as exc:  # nothing was begun
        return FlowResult(months=months, stages={"lease": "failed"}, code=FAILED_INPUT, detail={"error": str(exc)})


def _run_flow(spark: SparkSession, lake: Lake, months: list[str], zone_seed: DataFrame | None, max_non_clean_rate: float,
              max_hard_reject_rate: float, dim_start: str, dim_end: str, staging_table_name: str | None) -> FlowResult:
    res = FlowResult(months=months)
    if folder_of(FileOps(spark), lake, lake.raw_zones) is None:
        res.stages["clean"] = "failed"
        res.code = FAILED_INPUT
        res.detail["error"] = f"missing zone lookup under {lake.raw_zones}"
        return res
    zones = read_lake_zones(spark, lake)
    active = list(months)

    def drop(stage: str, failed: dict[str, int]) -> None:
        """Months failing ``stage`` leave the flow; the others continue."""
        nonlocal active
        for m, code in failed.items():
            res.month_status[m] = f"failed:{stage}"
            res.code = max(res.code, code)
        res.stages[stage] = "failed" if failed else "ok"
        active = [m for m in active if m not in failed]

    def ended(stage: str, exc: Exception) -> FlowResult:
        """A job of ``stage`` failed: its months end there with a status; what earlier stages published stays."""
        res.detail["error"] = f"{type(exc).__name__}: {exc}"[:AUDIT_ERROR_MAX_CHARS]
        drop(stage, dict.fromkeys(active, MISMATCH))
        return res

    try:
        run = run_months_batched(spark, lake, active, zones)
    except Exception as exc:
        return ended("clean", exc)
    res.detail["clean"] = run.outcomes
    drop("clean", {m: o.code for m, o in run.outcomes.items() if o.code != OK})
    if not active:
        return res

    status = evaluate_months(spark, lake, active, max_non_clean_rate, max_hard_reject_rate)
    res.detail["gate"] = status
    drop("gate", {m: MISMATCH if s == "failed" else INVALID_MONTH for m, s in status.items() if s != "passed"})
    if not active:
        return res

    try:
        loads = load_months(spark, lake, active)
    except Exception as exc:  # audited by the load
        return ended("load", exc)
    res.detail["load"] = loads
    drop("load", {m: (FAILED_INPUT if o.status == "missing" else MISMATCH)
                  for m, o in loads.items() if o.status != "success"})
    if not active:
        return res
    if staging_table_name:
        register_lake_table(spark, staging_table_name, lake, lake.staging_table, months=active)
        analyze_months(spark, staging_table_name, active)

    seed = zone_seed if zone_seed is not None else zones
    try:
        build_marts(spark, lake, seed, payment_type_codes(spark), dim_start, dim_end, months=active)
    except Exception as exc:  # the marts keep their last version
        return ended("marts", exc)
    res.stages["marts"] = "ok"
    tests = run_data_tests(spark, lake, months=active)
    failed = [r["test_name"] for r in tests.filter("NOT passed").collect()]
    res.detail["tests_failed"] = failed
    res.stages["tests"] = "failed" if failed else "ok"
    if failed:
        res.code = max(res.code, MISMATCH)
    for m in active:
        res.month_status[m] = "failed:tests" if failed else "ok"
    return res


def register_table(spark: SparkSession, name: str, path: str, partitioned: bool = False,
                   analyze: bool = False, months=None) -> None:
    """Expose a parquet folder as a named table.

    Created once (external table over ``path``); for partitioned tables the
    given ``months`` are added to the partition list, or, without them, the whole
    table is listed again.
    ``analyze`` computes whole-table statistics, a full scan: after a load,
    prefer :func:`analyze_months`.
    """
    new = not spark.catalog.tableExists(name)
    if new:
        spark.catalog.createTable(name, path=path, source="parquet")
    if partitioned and (months is None or new):
        spark.catalog.recoverPartitions(name)
    elif partitioned:
        parts = [tuple(int(x) for x in m.split("-")) for m in validate_months(months)]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION (year={y}, month={mm})" for y, mm in parts))
        spark.catalog.refreshTable(name)
    if analyze:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def register_lake_table(spark: SparkSession, name: str, lake: Lake, table: str, months=None, analyze: bool = False) -> None:
    """Expose the current version of a (year, month) lake table under a name.

    Every partition points at its current folder; run again after a publish, it moves the partitions
    whose folders changed and takes out those that are gone. With ``months`` only those are looked at.
    """
    held = partitions(FileOps(spark), lake, table)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read_table(spark, lake, table).schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (year, month) LOCATION '{table}/_named'")
        months = None
    wanted = held if months is None else {p: held.get(p) for p in map(clean_partition, validate_months(months))}
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    for part, folder in wanted.items():
        spec = "PARTITION (" + part.replace("/", ", ") + ")"
        if folder is not None:
            spark.sql(f"ALTER TABLE {name} " + (f"{spec} SET LOCATION '{folder}'" if part in known else f"ADD {spec} LOCATION '{folder}'"))
    for part in known - set(held):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (" + part.replace("/", ", ") + ")")
    spark.catalog.refreshTable(name)
    if analyze:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def analyze_months(spark: SparkSession, name: str, months) -> None:
    """Refresh statistics of the loaded months' partitions only (B10): each
    month's partition is scanned, the rest of the history is not."""
    for m in validate_months(months):
        y, mm = (int(x) for x in m.split("-"))
        spark.sql(f"ANALYZE TABLE {name} PARTITION (year={y}, month={mm}) COMPUTE STATISTICS")
