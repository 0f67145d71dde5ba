"""Run metrics, reason shares and the quality gate.

Metrics are long/wide DataFrames keyed by month, so a gate over many months
is one small aggregation instead of a loop over summary files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import (
    CLEAN_LABEL, DEFAULT_MAX_HARD_REJECT_RATE, DEFAULT_MAX_NON_CLEAN_RATE, HARD_REASONS,
)


def counts_by_reason(tagged: DataFrame, by_month: bool = True) -> DataFrame:
    """Rows per (source_month, reason) with 'clean' for untagged rows."""
    keys = ["source_month"] if by_month else []
    return tagged.groupBy(
        *keys, F.coalesce(F.col("reject_reason"), F.lit(CLEAN_LABEL)).alias("reason")
    ).agg(F.count(F.lit(1)).alias("rows"))


def reason_share(reason_counts: DataFrame, by_month: bool = True) -> DataFrame:
    """Each reason's share of rows in, in percent.

    The per-month total is joined back from a grouped sum of the (tiny)
    reason-count table, not computed with a global window.
    """
    keys = ["source_month"] if by_month else []
    if keys:
        totals = reason_counts.groupBy(*keys).agg(F.sum("rows").alias("_total"))
        joined = reason_counts.join(totals, keys)
    else:
        totals = reason_counts.agg(F.sum("rows").alias("_total"))
        joined = reason_counts.crossJoin(totals)  # 1-row side
    return joined.select(
        *keys, "reason", "rows",
        F.round(F.lit(100.0) * F.col("rows") / F.col("_total"), 6).alias("pct_of_rows_in"),
    )


def run_metrics_from_tagged(tagged: DataFrame) -> DataFrame:
    """rows_in, rows_clean, rows_rejected_or_quarantined per source_month in ONE aggregation (E5)."""
    is_clean = F.col("reject_reason").isNull()
    return tagged.groupBy("source_month").agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(is_clean).alias("rows_clean"),
        F.count_if(~is_clean).alias("rows_rejected_or_quarantined"),
    )


def run_summary(rows_in: DataFrame, clean_out: DataFrame, rejected_out: DataFrame,
                reason_counts: DataFrame) -> DataFrame:
    """Join independently counted parts into one summary row per month.

    rows_in: (source_month, rows_in) from the raw scan;
    clean_out / rejected_out: (source_month, rows) read back from written outputs;
    reason_counts: (source_month, reason, rows) from the tagging plan.
    The reason counts ride along as a map (the summary file's shape).
    """
    reasons = reason_counts.groupBy("source_month").agg(
        F.map_from_entries(F.collect_list(F.struct("reason", F.col("rows").cast("bigint")))).alias("counts_by_reason")
    )
    return (
        rows_in.join(clean_out.withColumnRenamed("rows", "rows_clean"), "source_month", "left")
        .join(rejected_out.withColumnRenamed("rows", "rows_rejected_or_quarantined"), "source_month", "left")
        .join(reasons, "source_month", "left")
        .select(
            F.col("source_month").alias("month"),
            F.col("rows_in").cast("bigint").alias("rows_in"),
            F.coalesce(F.col("rows_clean"), F.lit(0)).cast("bigint").alias("rows_clean"),
            F.coalesce(F.col("rows_rejected_or_quarantined"), F.lit(0)).cast("bigint").alias("rows_rejected_or_quarantined"),
            F.coalesce(F.col("counts_by_reason"), F.create_map().cast("map<string,bigint>")).alias("counts_by_reason"),
        )
    )


def reasons_long(summary: DataFrame) -> DataFrame:
    """Normalise the counts_by_reason map to (month, reason, rows) rows."""
    return summary.select("month", F.explode("counts_by_reason").alias("reason", "rows"))


def gate_checks(summary: DataFrame, max_non_clean_rate: float = DEFAULT_MAX_NON_CLEAN_RATE,
                max_hard_reject_rate: float = DEFAULT_MAX_HARD_REJECT_RATE) -> DataFrame:
    """One row per (month, check): passed, value, threshold.

    Rates default to 1.0 when a month has no rows; pass/fail compares the
    unrounded rate, only the reported value is rounded (5 / 6 digits).
    """
    reasons = reasons_long(summary).groupBy("month").agg(
        F.sum("rows").alias("reason_total"),
        F.sum(F.when(F.col("reason").isin(*HARD_REASONS), F.col("rows")).otherwise(F.lit(0))).alias("hard"),
    )
    w = summary.join(reasons, "month", "left").select(
        "month", "rows_in", "rows_clean", "rows_rejected_or_quarantined",
        F.coalesce("reason_total", F.lit(0)).alias("reason_total"),
        F.coalesce("hard", F.lit(0)).alias("hard"),
    )
    has_rows = F.col("rows_in") > 0
    non_clean = F.when(has_rows, F.col("rows_rejected_or_quarantined") / F.col("rows_in")).otherwise(F.lit(1.0))
    hard_rate = F.when(has_rows, F.col("hard") / F.col("rows_in")).otherwise(F.lit(1.0))
    conserved = F.col("rows_clean") + F.col("rows_rejected_or_quarantined")
    rows_in_txt = F.col("rows_in").cast("string")

    def check(order, name, passed, value, threshold):
        return F.struct(F.lit(order).alias("check_order"), F.lit(name).alias("check_name"),
                        passed.alias("passed"), value.cast("double").alias("value"),
                        threshold.cast("string").alias("threshold"))

    checks = F.array(
        check(1, "has_rows", has_rows & (F.col("rows_clean") > 0), F.col("rows_in"), F.lit("> 0")),
        check(2, "row_conservation", conserved == F.col("rows_in"), conserved, rows_in_txt),
        check(3, "reasons_add_up", F.col("reason_total") == F.col("rows_in"), F.col("reason_total"), rows_in_txt),
        check(4, "non_clean_rate", non_clean <= F.lit(max_non_clean_rate), F.round(non_clean, 5),
              F.lit(repr(float(max_non_clean_rate)))),
        check(5, "hard_reject_rate", hard_rate <= F.lit(max_hard_reject_rate), F.round(hard_rate, 6),
              F.lit(repr(float(max_hard_reject_rate)))),
    )
    return w.select("month", F.inline(checks))


def gate_status(checks: DataFrame) -> DataFrame:
    """Month status: passed when every check passed."""
    return checks.groupBy("month").agg(
        F.when(F.bool_and("passed"), F.lit("passed")).otherwise(F.lit("failed")).alias("status")
    )


def gate_report(checks: DataFrame) -> DataFrame:
    """Report rows as persisted: month, status, checks[], evaluated_at_utc."""
    return checks.groupBy("month").agg(
        F.when(F.bool_and("passed"), F.lit("passed")).otherwise(F.lit("failed")).alias("status"),
        F.array_sort(F.collect_list(F.struct("check_order", "check_name", "passed", "value", "threshold"))).alias("checks"),
        F.date_format(F.convert_timezone(None, F.lit("UTC"), F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
        .alias("evaluated_at_utc"),
    )

