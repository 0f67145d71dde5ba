"""Clean any set of months in one job.

Flow per call, for all months together:

1. raw months -> standardize (one scan per month folder, each with its own
   footer schema and a literal ``source_month``);
2. clean (enriched, broadcast zone joins) and rejected rows, each written
   ONCE to a new version folder of its table (no cache: a lost executor recomputes
   its split from the immutable raw files); the count of every reason is an
   observed metric of the clean write; rows_in is counted on its own, from the
   raw files' footers;
3. read-back counts and content digests of the staged outputs (independent of the plan); the digests
   of the same rows as they were tagged are observed metrics of the clean write;
4. months whose counts and contents reconcile are published by one commit, clean and rejected
   rows together (a readable month of zero rows too: the gate refuses it); months
   that do not are left untouched and reported;
5. one run-summary row per month, persisted as JSON partitioned by month.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmart.contracts import CANONICAL_NAMES, CLEAN_LABEL, REASON_ORDER
from tripmart.functions.digest import digest_of, row_hash
from tripmart.functions.months import validate_months
from tripmart.operators.clean import enrich, split_clean, split_rejected, tag_rows
from tripmart.operators.quality import run_summary
from tripmart.plans.publish import FileOps, Lease, clean_partition, commit, new_version, rejected_partition, writing
from tripmart.sources.lake import Lake, raw_folder, raw_month_scan, raw_row_counts, read_table, union_by_name

OK, FAILED_INPUT, INVALID_MONTH, MISMATCH = 0, 1, 2, 3  # outcome codes (N3)


#: Columns that go through cleaning unchanged, and the reason; every other written column derives from them.
DIGEST_COLUMNS = [*CANONICAL_NAMES, "reject_reason"]
_HASH, _CLEAN_DIGEST, _REJECTED_DIGEST = "_row_hash", "_clean_digest", "_rejected_digest"


class CountMismatch(RuntimeError):
    """Written clean + rejected rows do not add up to the rows read, or are not the same rows."""


@dataclass
class MonthOutcome:
    month: str
    rows_in: int
    rows_clean: int
    rows_rejected: int
    reasons_total: int
    published: bool
    code: int
    content_ok: bool = True


@dataclass
class RunResult:
    months: list[str]
    outcomes: dict[str, MonthOutcome] = field(default_factory=dict)
    duration_seconds: float = 0.0

    @property
    def ok(self) -> bool:
        return all(o.code == OK for o in self.outcomes.values())


def clean_content(df: DataFrame) -> DataFrame:
    """(source_month, rows, digest) of clean rows as they are stored."""
    return (df.withColumn("reject_reason", F.lit(None).cast("string")).groupBy("year", "month")
            .agg(F.count(F.lit(1)).alias("rows"), digest_of(row_hash(DIGEST_COLUMNS)).alias("digest"))
            .select(F.format_string("%04d-%02d", F.col("year"), F.col("month")).alias("source_month"), "rows", "digest"))


def rejected_content(df: DataFrame) -> DataFrame:
    """(source_month, rows, digest) of rejected and quarantined rows as they are stored."""
    return df.groupBy("source_month").agg(F.count(F.lit(1)).alias("rows"), digest_of(row_hash(DIGEST_COLUMNS)).alias("digest"))


def _tag_metrics():
    reason = F.col("reject_reason")
    return [F.count_if(reason.isNull()).alias(CLEAN_LABEL),
            *[F.count_if(reason == r).alias(r) for r in REASON_ORDER],
            digest_of(F.when(reason.isNull(), F.col(_HASH))).alias(_CLEAN_DIGEST),
            digest_of(F.when(reason.isNotNull(), F.col(_HASH))).alias(_REJECTED_DIGEST)]


def run_months(spark: SparkSession, lake: Lake, months, zones: DataFrame,
               raw: dict[str, DataFrame] | None = None, strict: bool = False) -> RunResult:
    """Clean, verify and publish ``months``. ``raw`` ({month: standardized
    DataFrame}) overrides reading the ``lake.raw_month(m)`` folders. With
    ``strict`` a month that does not reconcile raises :class:`CountMismatch`
    (after the months that do reconcile are published)."""
    with writing(spark, lake) as lease:
        return _run_months(spark, lake, lease, validate_months(months), zones, raw, strict)


def _run_months(spark: SparkSession, lake: Lake, lease: Lease, months: list[str], zones: DataFrame,
                raw: dict[str, DataFrame] | None, strict: bool) -> RunResult:
    started = time.time()
    ops = lease.ops
    result = RunResult(months=months)
    if raw is None:
        missing = [m for m in months if not ops.has_files(raw_folder(spark, lake, m) or lake.raw_month(m), ".parquet")]
        for m in missing:  # no input files: failed input, nothing else runs for it
            result.outcomes[m] = MonthOutcome(m, 0, 0, 0, 0, False, FAILED_INPUT)
        scans = {m: raw_month_scan(spark, lake, m) for m in months if m not in missing}
    else:
        scans = {m: raw[m] for m in months}
    if not scans:
        _check(result, strict)
        return result

    run_id = uuid.uuid4().hex[:12]
    version = new_version()  # folders that no reader sees before the commit
    clean_stage, rejected_stage = f"{lake.clean}/{version}", f"{lake.rejected}/{version}"

    # Tag each month with its literal bounds (constant-folded), then union. Each
    # month's branch is observed BEFORE the clean filter, so the clean write
    # (a map-only result stage: metrics of retried tasks count once) also
    # yields rows_in and every reason count without another scan of the raw data.
    observations: dict[str, Observation] = {}
    observed, plain = [], []
    for m, df in scans.items():
        t = tag_rows(df, m)
        observations[m] = Observation(f"tag_{m.replace('-', '_')}_{run_id}")
        observed.append(t.withColumn(_HASH, row_hash(DIGEST_COLUMNS)).observe(observations[m], *_tag_metrics()).drop(_HASH))
        plain.append(t)

    try:
        clean = enrich(split_clean(union_by_name(observed)), zones)
        # Clean rows of a month all fall inside it, so a raw split (one month) writes
        # to one partition folder: no shuffle is needed before the write.
        clean.write.mode("overwrite").partitionBy("year", "month").parquet(clean_stage)
        rejected = split_rejected(union_by_name(plain))
        # Rejected rows are a few percent: rebalance them into fewer, larger files
        # (AQE splits a hot month instead of sending it to one task).
        (rejected.hint("rebalance", "source_month").write.mode("overwrite")
         .partitionBy("source_month").parquet(rejected_stage))
    except Exception:
        _drop(ops, clean_stage, rejected_stage)  # nothing was published; leave no partial version behind
        raise

    metrics = [(m, o.get) for m, o in observations.items()]
    tagged = {m: (v[_CLEAN_DIGEST], v[_REJECTED_DIGEST]) for m, v in metrics}
    counted = (raw_row_counts(spark, lake, list(scans)) if raw is None else
               union_by_name(df.select(F.lit(m).alias("source_month")) for m, df in scans.items())
               .groupBy("source_month").agg(F.count(F.lit(1)).alias("rows_in")))
    rows_in = spark.createDataFrame([(m,) for m in scans], "source_month string").join(counted, "source_month", "left").select(
        "source_month", F.coalesce("rows_in", F.lit(0)).alias("rows_in"))
    reasons = spark.createDataFrame(
        [(m, reason, int(v[reason])) for m, v in metrics for reason in [CLEAN_LABEL, *REASON_ORDER] if v[reason]],
        "source_month string, reason string, rows bigint")

    # Read back what was written (independent of the plan). A write with zero
    # rows leaves no partition folder (and no schema to read). One row per month each.
    clean_back, clean_found = _contents(spark, ops, clean_stage, clean_content)
    rejected_back, rejected_found = _contents(spark, ops, rejected_stage, rejected_content)
    summary = run_summary(rows_in, clean_back, rejected_back, reasons)
    collected = summary.collect()  # one small row per month
    rows = {r["month"]: r for r in collected}

    changes: dict[tuple[str, str], str | None] = {}
    for m in scans:
        r = rows.get(m)
        rows_in_m = int(r["rows_in"]) if r else 0
        clean_m = int(r["rows_clean"]) if r else 0
        rej_m = int(r["rows_rejected_or_quarantined"]) if r else 0
        reasons_m = int(sum((r["counts_by_reason"] or {}).values())) if r else 0
        same = (clean_found.get(m, 0), rejected_found.get(m, 0)) == tagged[m]
        good = clean_m + rej_m == rows_in_m and reasons_m == rows_in_m and same
        for table, staged, part in ((lake.clean, clean_stage, clean_partition(m)), (lake.rejected, rejected_stage, rejected_partition(m))):
            written = ops.exists(f"{staged}/{part}")
            if good:  # a month without such rows has no folder, and its earlier one goes
                changes[(table, part)] = f"{staged}/{part}" if written else None
            elif written:
                ops.delete(f"{staged}/{part}")
        code = OK if good else MISMATCH
        result.outcomes[m] = MonthOutcome(m, rows_in_m, clean_m, rej_m, reasons_m, good, code, same)

    duration = round(time.time() - started, 1)
    result.duration_seconds = duration
    published = [r for r in collected if result.outcomes.get(r["month"]) and result.outcomes[r["month"]].published]
    if not published:
        _drop(ops, clean_stage, rejected_stage)
        _check(result, strict)
        return result
    try:
        commit(lease, changes)  # clean and rejected rows of all these months, at once
    except Exception:
        _drop(ops, clean_stage, rejected_stage)
        raise
    persisted = spark.createDataFrame(published, summary.schema)
    digests = spark.createDataFrame([(m, str(c), str(r)) for m, (c, r) in tagged.items()],
                                    "month string, clean_digest string, rejected_digest string")
    (persisted.join(digests, "month").withColumn("finished_at_utc",
                          F.date_format(F.convert_timezone(None, F.lit("UTC"), F.current_timestamp()),
                                        "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
     .withColumn("duration_seconds", F.lit(duration))
     .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").json(lake.runs))
    _check(result, strict)
    return result


def _contents(spark: SparkSession, ops: FileOps, staged: str, content) -> tuple[DataFrame, dict]:
    """(source_month, rows) of a staged table read back, and {month: digest}; one aggregation, one row a month."""
    got = content(spark.read.parquet(staged)).collect() if ops.list_dirs(staged) else []
    return (spark.createDataFrame([(r["source_month"], r["rows"]) for r in got], "source_month string, rows bigint"),
            {r["source_month"]: r["digest"] for r in got})


def _drop(ops: FileOps, *folders: str) -> None:
    for folder in folders:
        ops.delete(folder)


def _check(result: RunResult, strict: bool) -> None:
    if strict:
        bad = [o for o in result.outcomes.values() if o.code != OK]
        if bad:
            raise CountMismatch(f"months not reconciled (clean + rejected != rows in, or other contents): {bad}")


def run_months_batched(spark: SparkSession, lake: Lake, months, zones: DataFrame, batch: int = 24,
                       strict: bool = False) -> RunResult:
    """Backfill many months as consecutive jobs of ``batch`` months each.

    One job's plan holds one scan branch per month; chunking keeps planning
    time bounded for multi-year backfills while each job still processes its
    months together. Outcomes of all chunks are merged.
    """
    months = validate_months(months)
    merged = RunResult(months=months)
    started = time.time()
    for i in range(0, len(months), batch):
        part = run_months(spark, lake, months[i:i + batch], zones, strict=strict)
        merged.outcomes.update(part.outcomes)
    merged.duration_seconds = round(time.time() - started, 1)
    return merged


RUN_SUMMARY_SCHEMA = ("rows_in bigint, rows_clean bigint, rows_rejected_or_quarantined bigint, "
                      "counts_by_reason map<string,bigint>, finished_at_utc string, duration_seconds double, "
                      "month string")


def read_run_summaries(spark: SparkSession, lake: Lake) -> DataFrame:
    """Persisted run summaries, one row per month; month from the folder name."""
    return spark.read.schema(RUN_SUMMARY_SCHEMA).json(lake.runs)


def read_run_digests(spark: SparkSession, lake: Lake) -> DataFrame:
    """(month, clean_digest, rejected_digest) that the published runs stored; text, NULL for runs without digests."""
    schema = "clean_digest string, rejected_digest string, month string"
    return spark.read.schema(schema).json(lake.runs).select("month", "clean_digest", "rejected_digest")


def content_audit(spark: SparkSession, lake: Lake) -> DataFrame:
    """(month, kind, rows, content_ok) for every published month: whether the stored rows are still those that the run tagged (K6)."""
    now = (clean_content(read_table(spark, lake, lake.clean)).withColumn("kind", F.lit("clean"))
           .unionByName(rejected_content(read_table(spark, lake, lake.rejected)).withColumn("kind", F.lit("rejected"))))
    then = read_run_digests(spark, lake).select(
        "month", F.explode(F.create_map(F.lit("clean"), "clean_digest", F.lit("rejected"), "rejected_digest")).alias("kind", "stored"))
    return then.join(now.withColumnRenamed("source_month", "month"), ["month", "kind"], "left").select(
        "month", "kind", F.coalesce("rows", F.lit(0)).alias("rows"),
        (F.col("stored") == F.coalesce(F.col("digest"), F.lit(0).cast("decimal(38,0)")).cast("string")).alias("content_ok"))
