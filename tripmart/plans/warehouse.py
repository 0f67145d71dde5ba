"""Warehouse month replace with reconciliation and an audit trail.

The staging table is a parquet table partitioned by (year, month). For a
set of months, in one job:

* expected rows per month = rows in that month's clean partition (a
  column-free count, E4);
* rows are projected to the staging contract (money decimal(12,2), ...)
  and written to a new version folder of the table;
* staged rows are counted back per month together with the NOT NULL
  contract and a digest of all columns (one aggregation); months whose contract holds
  and whose counts match become current by one commit; the table keeps the old
  version of any other month;
* the digest of all rows read back must be that of the rows written (an observed metric of the write): else no
  month of the job is published;
* a source with columns or types outside the contract is refused whole;
* every attempt appends one audit row, whatever failed and wherever (success
  or failed, error text cut at 1000 characters).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import AUDIT_COLUMNS, AUDIT_ERROR_MAX_CHARS, AUDIT_STATUSES, DATASET_NAME, STAGING_CONTRACT, STAGING_FILE_COLUMNS
from tripmart.functions.digest import digest_of, row_hash
from tripmart.functions.months import validate_months
from tripmart.operators.warehouse import extra_columns, mistyped_columns, to_staging
from tripmart.plans.publish import FileOps, Lease, clean_partition, commit, new_version, partitions, writing
from tripmart.sources.lake import Lake, read_table

AUDIT_SCHEMA = ", ".join(f"{c} {t}" for c, t, _ in AUDIT_COLUMNS)
NOT_NULL = [c for c, _, nullable in STAGING_CONTRACT if not nullable and c != "loaded_at"]


class CountMismatch(RuntimeError):
    """A month's staged rows are not as many as its clean partition holds."""


class ContentMismatch(RuntimeError):
    """The staged rows are not those that were written."""


class ContractViolation(RuntimeError):
    """Columns, types or NULLs of a month break the staging table's contract."""


@dataclass
class LoadOutcome:
    month: str
    expected: int
    loaded: int | None
    status: str
    error: str | None


def _month_col() -> F.Column:
    return F.format_string("%04d-%02d", F.col("year"), F.col("month"))


def load_months(spark: SparkSession, lake: Lake, months, strict: bool = False) -> dict[str, LoadOutcome]:
    """Replace ``months`` in the staging table. Returns one outcome per month;
    with ``strict`` a failed month raises (after it is audited) and a month
    without files raises FileNotFoundError."""
    with writing(spark, lake) as lease:
        return _load_months(spark, lake, lease, validate_months(months), strict)


def _load_months(spark: SparkSession, lake: Lake, lease: Lease, months: list[str], strict: bool) -> dict[str, LoadOutcome]:
    ops = lease.ops
    started = dt.datetime.now(dt.timezone.utc)
    outcomes: dict[str, LoadOutcome] = {}

    held = partitions(ops, lake, lake.clean)
    present = [m for m in months if clean_partition(m) in held]
    for m in months:
        if m not in present:
            # Like the original loader: no files is an input error, raised before any audit.
            outcomes[m] = LoadOutcome(m, 0, None, "missing", f"no processed parquet files for {m}")
    if not present:
        if strict:
            _raise_first_failure(outcomes)
        return outcomes

    staged = f"{lake.staging_table}/{new_version()}"
    expected: dict[str, int] = {}
    try:
        clean = read_table(spark, lake, lake.clean, [clean_partition(m) for m in present])
        expected = {r["m"]: int(r["n"]) for r in
                    clean.groupBy(_month_col().alias("m")).agg(F.count(F.lit(1)).alias("n")).collect()}
        table = to_staging(clean)
        refused = {"columns": extra_columns(clean), "types": mistyped_columns(table)}
        if any(refused.values()):
            for m in present:
                outcomes[m] = LoadOutcome(m, expected.get(m, 0), None, "failed", f"ContractViolation: not in the contract: {refused}")
        else:
            written = Observation(f"staged_{staged.rsplit('=', 1)[-1]}")
            (table.withColumn("_row_hash", row_hash(STAGING_FILE_COLUMNS)).observe(written, digest_of(F.col("_row_hash")).alias("digest"))
             .drop("_row_hash").write.mode("overwrite").partitionBy("year", "month").parquet(staged))
            checked = _read_back(spark, staged) if ops.list_dirs(staged) else {}
            outcomes |= {m: _verified(m, expected.get(m, 0), checked.get(m)) for m in present}
            if sum(int(r["_digest"]) for r in checked.values()) != int(written.get["digest"]):
                for m in present:
                    if outcomes[m].status == "success":
                        outcomes[m] = LoadOutcome(m, expected.get(m, 0), None, "failed",
                                                  "ContentMismatch: the staged rows are not those that were written")
            _publish(lease, staged, outcomes)
    except Exception as exc:  # a failure of the job itself: audited for every month without an outcome, then raised
        for m in present:
            outcomes.setdefault(m, LoadOutcome(m, expected.get(m, 0), None, "failed", f"{type(exc).__name__}: {exc}"))
        raise
    finally:
        if not any(o.status == "success" for o in outcomes.values()):
            ops.delete(staged)
        append_audit(spark, lake, [(o.month, o.expected, o.loaded, o.status, o.error[:AUDIT_ERROR_MAX_CHARS] if o.error else None)
                                   for o in (outcomes[m] for m in present if m in outcomes)], started)
    if strict:
        _raise_first_failure(outcomes)
    return outcomes


def _read_back(spark: SparkSession, staged: str) -> dict:
    """Per month: row count, NULLs of the NOT NULL columns and the digest of all columns, in one aggregation."""
    back = spark.read.parquet(staged)
    return {r["m"]: r for r in back.groupBy(_month_col().alias("m")).agg(
        F.count(F.lit(1)).alias("n"), digest_of(row_hash(STAGING_FILE_COLUMNS)).alias("_digest"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL]).collect()}


def _verified(m: str, expected: int, row) -> LoadOutcome:
    """Whether a staged month holds its contract and all of its rows; a month that does not, fails alone."""
    got = int(row["n"]) if row else 0
    violations = {c: int(row[c]) for c in NOT_NULL if row and row[c]}
    if violations:
        return LoadOutcome(m, expected, None, "failed", f"ContractViolation: NOT NULL violated in {m}: {violations}")
    if got != expected:
        return LoadOutcome(m, expected, None, "failed", f"CountMismatch: staged {got} rows for {m}, clean partition holds {expected}")
    return LoadOutcome(m, expected, got, "success", None)


def _publish(lease: Lease, staged: str, outcomes: dict[str, LoadOutcome]) -> None:
    """Make all verified months current at once; the staged rows of the others go. If the commit fails, all fail."""
    ops, table = lease.ops, lease.lake.staging_table
    good = [m for m, o in outcomes.items() if o.status == "success"]
    for m, o in outcomes.items():
        if o.status == "failed":
            ops.delete(f"{staged}/{clean_partition(m)}")
    if not good:
        return
    try:
        commit(lease, {(table, clean_partition(m)): f"{staged}/{clean_partition(m)}" if ops.exists(f"{staged}/{clean_partition(m)}") else None
                       for m in good})
    except Exception as exc:
        for m in good:
            outcomes[m] = LoadOutcome(m, outcomes[m].expected, None, "failed", f"{type(exc).__name__}: {exc}")


def _raise_first_failure(outcomes: dict[str, LoadOutcome]) -> None:
    for o in outcomes.values():
        if o.status == "missing":
            raise FileNotFoundError(o.error)
        if o.status == "failed":
            kind = next((k for k in (ContractViolation, CountMismatch, ContentMismatch) if o.error.startswith(k.__name__)), RuntimeError)
            raise kind(o.error)


def append_audit(spark: SparkSession, lake: Lake, rows, started: dt.datetime) -> None:
    """Append audit rows; load_id continues the table's maximum."""
    if not rows:
        return
    unknown = {r[3] for r in rows} - set(AUDIT_STATUSES)
    if unknown:
        raise ValueError(f"audit status outside {AUDIT_STATUSES}: {sorted(unknown)}")
    ops = FileOps(spark)
    next_id = 1
    if ops.exists(lake.audit_table):
        cur = spark.read.schema(AUDIT_SCHEMA).parquet(lake.audit_table).agg(F.max("load_id")).first()[0]
        next_id = (cur or 0) + 1
    finished = dt.datetime.now(dt.timezone.utc)
    data = [(next_id + i, DATASET_NAME, m, exp, got, status, err, started, finished)
            for i, (m, exp, got, status, err) in enumerate(rows)]
    spark.createDataFrame(data, AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(lake.audit_table)


def read_audit(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(lake.audit_table)


def read_staging_table(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake, lake.staging_table)
