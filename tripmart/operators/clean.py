"""Cleaning operators: standardize -> tag -> split -> disposition -> enrich.

All are narrow projections/filters (no shuffle) except ``enrich``, whose two
zone joins broadcast the size-checked zone dimension.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contracts import (
    CANONICAL_COLUMNS, CLEAN_FILE_COLUMNS, DISPOSITION_QUARANTINED, DISPOSITION_REJECTED, MAX_TRIP_MILES,
    QUARANTINE_REASONS, REASON_DISTANCE_OVER_100, REASON_DROPOFF_BEFORE_PICKUP, REASON_MISSING_TIMESTAMP,
    REASON_NEGATIVE_FARE, REASON_PICKUP_OUTSIDE_MONTH,
)
from tripmart.functions.months import month_bounds
from tripmart.operators.joins import checked_dimension

log = logging.getLogger("tripmart.clean")


def resolve_source_columns(columns: Iterable[str]) -> dict[str, str | None]:
    """Canonical name -> the source column that feeds it (names compared
    case-insensitively), or None when the month's file lacks it."""
    by_lower = {c.lower(): c for c in columns}
    return {name: by_lower.get(src) for name, src, _ in CANONICAL_COLUMNS}


def standardize(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Map a raw month to the 20 canonical columns.

    Every column is cast to its contract type (ANSI: malformed values raise);
    a column missing from the source (schema drift) becomes a typed NULL;
    extra source columns are dropped. Columns in ``keep`` (e.g.
    ``source_month``) pass through after the canonical ones.
    """
    sources = resolve_source_columns(df.columns)
    missing = [src for (name, src, _) in CANONICAL_COLUMNS if sources[name] is None]
    if missing:
        log.warning("schema drift: %s missing, filled with NULL", ", ".join(missing))
    projected = [
        (F.col(f"`{sources[name]}`") if sources[name] is not None else F.lit(None)).cast(dtype).alias(name)
        for name, _, dtype in CANONICAL_COLUMNS
    ]
    return df.select(*projected, *[F.col(k) for k in keep])


# Rules in evaluation order; each maps (pickup, dropoff, month_start, month_end) to a predicate.
def _rules(start: Column, end: Column) -> list[tuple[str, Column]]:
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return [
        (REASON_MISSING_TIMESTAMP, pickup.isNull() | dropoff.isNull()),
        (REASON_DROPOFF_BEFORE_PICKUP, dropoff < pickup),
        (REASON_PICKUP_OUTSIDE_MONTH, (pickup < start) | (pickup >= end)),
        (REASON_DISTANCE_OVER_100, F.col("trip_distance") > MAX_TRIP_MILES),
        (REASON_NEGATIVE_FARE, F.col("fare_amount") < 0),
    ]


def rule_predicate(reason: str, month: str | Column = None) -> Column:
    """The stand-alone predicate of one rule (C6-C10), counted independently of order."""
    start, end = month_bounds(month if month is not None else F.col("source_month"))
    return dict(_rules(start, end))[reason]


def reject_reason(month: str | Column | None = None) -> Column:
    """First matching rule's name, NULL when the row is clean.

    ``month`` is a 'YYYY-MM' literal or a column; by default the row's
    ``source_month`` column, so one plan tags many months.
    """
    start, end = month_bounds(month if month is not None else F.col("source_month"))
    expr = None
    for reason, pred in _rules(start, end):
        expr = F.when(pred, F.lit(reason)) if expr is None else expr.when(pred, F.lit(reason))
    return expr


def tag_rows(df: DataFrame, month: str | None = None) -> DataFrame:
    """Add ``reject_reason`` (NULL = clean). Never changes the row count."""
    return df.withColumn("reject_reason", reject_reason(month))


def split_clean(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def disposition() -> Column:
    """quarantined for reviewable reasons, rejected for invalid rows."""
    return (
        F.when(F.col("reject_reason").isin(*QUARANTINE_REASONS), F.lit(DISPOSITION_QUARANTINED))
        .otherwise(F.lit(DISPOSITION_REJECTED))
    )


def split_rejected(tagged: DataFrame, month: str | None = None) -> DataFrame:
    """Rejected and quarantined rows with disposition and source_month."""
    out = tagged.filter(F.col("reject_reason").isNotNull()).withColumn("disposition", disposition())
    if month is not None:
        out = out.withColumn("source_month", F.lit(month))
    return out


def zone_dimension(zones: DataFrame) -> DataFrame:
    """Zone lookup with an integer key (ANSI cast: a malformed id raises)."""
    return zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
    )


def trip_duration_minutes() -> Column:
    """Whole elapsed seconds / 60.0, a decimal as in the lake files."""
    return F.expr("timestampdiff(SECOND, pickup_datetime, dropoff_datetime) / 60.0")


def checked_zone_dimension(zones: DataFrame) -> DataFrame:
    """The zone lookup as an int-keyed dimension, size-measured and key-checked
    once (see :func:`tripmart.operators.joins.checked_dimension`); reusable
    across many :func:`enrich` calls of one job."""
    return checked_dimension(zone_dimension(zones), "location_id")


def enrich(clean: DataFrame, zones: DataFrame | None = None, keep: Iterable[str] = (),
           zone_dim: DataFrame | None = None) -> DataFrame:
    """Zone names by pickup and dropoff id (left joins), flags, duration, year/month.

    The zone dimension is checked for a unique key (fan-out guard) and its
    size before it is broadcast; the fact side is never shuffled.
    """
    dim = zone_dim if zone_dim is not None else checked_zone_dimension(zones)
    # The same dimension plan on both sides, so Spark broadcasts it once and
    # reuses the exchange for the second join.
    pu, do = dim.alias("pu"), dim.alias("do")
    joined = (
        clean.join(pu, clean["pickup_location_id"] == F.col("pu.location_id"), "left")
        .join(do, F.col("dropoff_location_id") == F.col("do.location_id"), "left")
        .select(clean["*"],
                F.col("pu.borough").alias("pickup_borough"), F.col("pu.zone").alias("pickup_zone"),
                F.col("do.borough").alias("dropoff_borough"), F.col("do.zone").alias("dropoff_zone"))
    )
    return joined.select(
        *[F.col(c) for c in CLEAN_FILE_COLUMNS if c not in ("passenger_count_missing", "zero_distance",
                                                           "trip_duration_minutes")],
        F.col("passenger_count").isNull().alias("passenger_count_missing"),
        (F.col("trip_distance") == 0).alias("zero_distance"),
        trip_duration_minutes().alias("trip_duration_minutes"),
        F.year("pickup_datetime").alias("year"),
        F.month("pickup_datetime").alias("month"),
        *[F.col(k) for k in keep],
    )


def clean_month(raw: DataFrame, zones: DataFrame, month: str | None = None) -> tuple[DataFrame, DataFrame]:
    """standardize -> tag -> (enriched clean, rejected). ``raw`` must carry source_month unless month is given."""
    keep = ("source_month",) if "source_month" in raw.columns else ()
    tagged = tag_rows(standardize(raw, keep=keep), month)
    clean = enrich(split_clean(tagged), zones)
    rejected = split_rejected(tagged, month)
    return clean, rejected
