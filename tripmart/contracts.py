"""Column contracts, rule table and code lists.

Everything in the "fixed values" blocks must equal the values the original
pipeline uses, because downstream data (reason names, disposition names,
payment names, thresholds) is compared across systems.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Canonical trip columns in output order.
# canonical name, lower-cased source name, Spark type
# ---------------------------------------------------------------------------
CANONICAL_COLUMNS: list[tuple[str, str, str]] = [
    ("vendor_id", "vendorid", "int"),
    ("pickup_datetime", "tpep_pickup_datetime", "timestamp_ntz"),
    ("dropoff_datetime", "tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "double"),
    ("rate_code_id", "ratecodeid", "int"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("pickup_location_id", "pulocationid", "int"),
    ("dropoff_location_id", "dolocationid", "int"),
    ("payment_type", "payment_type", "int"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("airport_fee", "airport_fee", "double"),
    ("cbd_congestion_fee", "cbd_congestion_fee", "double"),
]
CANONICAL_NAMES = [c[0] for c in CANONICAL_COLUMNS]

# ---------------------------------------------------------------------------
# Reject reasons in rule order (first match wins), which of
# them are quarantined for review, and which count as hard rejects.
# ---------------------------------------------------------------------------
REASON_MISSING_TIMESTAMP = "missing_timestamp"
REASON_DROPOFF_BEFORE_PICKUP = "dropoff_before_pickup"
REASON_PICKUP_OUTSIDE_MONTH = "pickup_outside_month"
REASON_DISTANCE_OVER_100 = "distance_over_100_miles"
REASON_NEGATIVE_FARE = "negative_fare"
REASON_ORDER = [
    REASON_MISSING_TIMESTAMP,
    REASON_DROPOFF_BEFORE_PICKUP,
    REASON_PICKUP_OUTSIDE_MONTH,
    REASON_DISTANCE_OVER_100,
    REASON_NEGATIVE_FARE,
]
QUARANTINE_REASONS = ("negative_fare", "distance_over_100_miles")
HARD_REASONS = ("missing_timestamp", "dropoff_before_pickup", "pickup_outside_month")
CLEAN_LABEL = "clean"
DISPOSITION_QUARANTINED = "quarantined"
DISPOSITION_REJECTED = "rejected"
MAX_TRIP_MILES = 100

# ---------------------------------------------------------------------------
# Quality gate defaults and the run-summary keys it requires.
# ---------------------------------------------------------------------------
DEFAULT_MAX_NON_CLEAN_RATE = 0.10
DEFAULT_MAX_HARD_REJECT_RATE = 0.001
GATE_CHECK_ORDER = ["has_rows", "row_conservation", "reasons_add_up", "non_clean_rate", "hard_reject_rate"]
SUMMARY_REQUIRED_KEYS = ("rows_in", "rows_clean", "rows_rejected_or_quarantined", "counts_by_reason")

# ---------------------------------------------------------------------------
# Payment type codes (seed).
# ---------------------------------------------------------------------------
PAYMENT_TYPE_CODES: list[tuple[int, str]] = [
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# ---------------------------------------------------------------------------
# Enriched (clean lake) columns appended after the canonical ones.
# ---------------------------------------------------------------------------
ZONE_NAME_COLUMNS = ["pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone"]
FLAG_COLUMNS = ["passenger_count_missing", "zero_distance", "trip_duration_minutes"]
CLEAN_FILE_COLUMNS = CANONICAL_NAMES + ZONE_NAME_COLUMNS + FLAG_COLUMNS  # 27 columns inside the files
CLEAN_PARTITION_COLUMNS = ["year", "month"]
REJECTED_EXTRA_COLUMNS = ["reject_reason", "disposition"]
REJECTED_PARTITION_COLUMN = "source_month"

# ---------------------------------------------------------------------------
# Warehouse staging table contract
# (column, Spark type, nullable). money is decimal(12,2).
# ---------------------------------------------------------------------------
MONEY = "decimal(12,2)"
MONEY_COLUMNS = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge",
    "airport_fee", "cbd_congestion_fee",
]
STAGING_CONTRACT: list[tuple[str, str, bool]] = [
    ("vendor_id", "int", True),
    ("pickup_datetime", "timestamp_ntz", False),
    ("dropoff_datetime", "timestamp_ntz", False),
    ("passenger_count", "int", True),
    ("trip_distance", "double", True),
    ("rate_code_id", "int", True),
    ("store_and_fwd_flag", "string", True),
    ("pickup_location_id", "int", True),
    ("dropoff_location_id", "int", True),
    ("payment_type", "int", True),
    ("fare_amount", MONEY, True),
    ("extra", MONEY, True),
    ("mta_tax", MONEY, True),
    ("tip_amount", MONEY, True),
    ("tolls_amount", MONEY, True),
    ("improvement_surcharge", MONEY, True),
    ("total_amount", MONEY, True),
    ("congestion_surcharge", MONEY, True),
    ("airport_fee", MONEY, True),
    ("cbd_congestion_fee", MONEY, True),
    ("pickup_borough", "string", True),
    ("pickup_zone", "string", True),
    ("dropoff_borough", "string", True),
    ("dropoff_zone", "string", True),
    ("passenger_count_missing", "boolean", False),
    ("zero_distance", "boolean", False),
    ("trip_duration_minutes", "double", True),
    ("year", "smallint", False),
    ("month", "smallint", False),
    ("loaded_at", "timestamp", False),
]
STAGING_FILE_COLUMNS = [c for c, _, _ in STAGING_CONTRACT if c not in ("year", "month", "loaded_at")]

# Load audit table and its status domain; error text limit.
AUDIT_COLUMNS: list[tuple[str, str, bool]] = [
    ("load_id", "bigint", False),
    ("dataset", "string", False),
    ("source_month", "string", False),
    ("rows_in_parquet", "bigint", True),
    ("rows_loaded", "bigint", True),
    ("status", "string", False),
    ("error_message", "string", True),
    ("started_at", "timestamp", False),
    ("finished_at", "timestamp", False),
]
AUDIT_STATUSES = ("success", "failed")
AUDIT_ERROR_MAX_CHARS = 1000
DATASET_NAME = "yellow_trips"

# Calendar of the date dimension.
DIM_DATE_START = "2024-01-01"
DIM_DATE_END = "2026-12-31"

# Zone reference-file validation.
ZONE_KEY_HEADER = "LocationID"
ZONE_MIN_ROWS = 200
NOT_AVAILABLE = "N/A"
