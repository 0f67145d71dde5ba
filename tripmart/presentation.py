"""How registered query outputs are presented for the cross-engine check (shared by both engines)."""

# Integer columns that hold NULLs in the fixture, per registered key. For the
# cross-engine check they are presented as DOUBLE by both engines: row objects,
# Arrow and pandas conversions then all agree (pandas turns Spark's nullable
# ints into float64 but DuckDB's into a nullable Int dtype). The operators keep
# their contract types (see tests).
NULLABLE_INT_OUTPUTS = {
    "scan_raw_month": ("passenger_count", "RatecodeID"),
    "sample_rows": ("passenger_count", "RatecodeID"),
    "write_static_readback": ("year", "month"),
    **{k: ("passenger_count", "rate_code_id") for k in (
        "scan_partition_filtered", "write_clean_readback", "write_rejected_readback", "load_month_replace",
        "standardize", "tag_rows", "split_clean", "split_rejected", "stg_trips", "fact_trips")},
}
