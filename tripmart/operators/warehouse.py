"""Warehouse-boundary operators: staging projection and the table contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import AUDIT_STATUSES, MONEY_COLUMNS, STAGING_CONTRACT, STAGING_FILE_COLUMNS
from tripmart.functions.money import to_money


def to_staging(clean: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Clean lake rows -> staging rows: money to decimal(12,2), duration to double,
    year/month as smallint, plus loaded_at (B8, C19, T2)."""
    cols = []
    for name, dtype, _ in STAGING_CONTRACT:
        if name == "loaded_at":
            cols.append((loaded_at if loaded_at is not None else F.current_timestamp()).alias(name))
        elif name in MONEY_COLUMNS:
            cols.append(to_money(name).alias(name))
        elif name in ("trip_duration_minutes", "year", "month"):
            cols.append(F.col(name).cast(dtype).alias(name))
        else:
            cols.append(F.col(name))
    return clean.select(*cols)


def contract_violations(staging: DataFrame) -> DataFrame:
    """Per contract column: rows violating NOT NULL, plus columns missing or mistyped (K8).

    One aggregation pass computes every column's NULL count; the schema part
    is metadata. Output: column_name, expected_type, actual_type, null_violations, ok.
    """
    actual = dict(staging.dtypes)
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c, _, nullable in STAGING_CONTRACT
            if not nullable and c in actual]
    counts = staging.agg(*aggs) if aggs else None
    rows = []
    for c, dtype, nullable in STAGING_CONTRACT:
        nulls = F.col(c) if (not nullable and c in actual) else F.lit(0)
        rows.append(F.struct(
            F.lit(c).alias("column_name"),
            F.lit(dtype).alias("expected_type"),
            F.lit(actual.get(c)).cast("string").alias("actual_type"),
            nulls.cast("bigint").alias("null_violations"),
        ))
    base = counts if counts is not None else staging.sparkSession.range(1)
    out = base.select(F.inline(F.array(*rows)))
    return out.withColumn(
        "ok", (F.col("null_violations") == 0) & F.col("actual_type").eqNullSafe(F.col("expected_type"))
    )


def extra_columns(staging: DataFrame) -> list[str]:
    """Columns present in the data but not in the table (the load refuses them)."""
    allowed = {c for c, _, _ in STAGING_CONTRACT}
    return [c for c in staging.columns if c not in allowed]


def mistyped_columns(staging: DataFrame) -> dict[str, str]:
    """Columns whose type is not the table's (the load refuses them)."""
    actual = dict(staging.dtypes)
    return {c: actual[c] for c, dtype, _ in STAGING_CONTRACT
            if c in actual and c != "loaded_at" and actual[c] != dtype}


def status_domain_violations(audit: DataFrame) -> DataFrame:
    """Audit rows whose status is outside the allowed domain."""
    return audit.filter(~F.col("status").isin(*AUDIT_STATUSES) | F.col("status").isNull())


__all__ = ["to_staging", "contract_violations", "extra_columns", "status_domain_violations",
           "STAGING_FILE_COLUMNS"]
