"""DuckDB oracle SQL for every registered query (cross-engine correctness gate).

The fixture derivation (raw trips from ``events``) and every model is written
once more in plain SQL, as common table expressions prepended to each query;
DuckDB ignores the ones a query does not reference. Names and rounding follow
``tripmart.catalog``.
"""

from __future__ import annotations

MONEY = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
         "total_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee"]
STD = ["vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "rate_code_id",
       "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id", "payment_type"] + MONEY
CLEAN = STD + ["pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone", "passenger_count_missing",
               "zero_distance", "trip_duration_minutes", "year", "month"]
STG = ["vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_date", "pickup_hour", "pickup_location_id",
       "dropoff_location_id", "payment_type", "rate_code_id", "store_and_fwd_flag", "passenger_count",
       "passenger_count_missing", "zero_distance", "trip_distance", "trip_duration_minutes", "fare_amount", "extra",
       "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee",
       "cbd_congestion_fee", "total_amount", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone",
       "year", "month"]
FACT_MEASURES = ["vendor_id", "rate_code_id", "passenger_count", "passenger_count_missing", "zero_distance",
                 "trip_distance", "trip_duration_minutes", "fare_amount", "extra", "mta_tax", "tip_amount",
                 "tolls_amount", "improvement_surcharge", "congestion_surcharge", "airport_fee",
                 "cbd_congestion_fee", "total_amount"]


def _raw(name: str, shift: int, drift: bool) -> str:
    pax_t = "INTEGER" if drift else "BIGINT"
    airport = "airport_fee" if drift else "Airport_fee"
    cbd = ",\n    CAST(CASE WHEN pay = 1 THEN 0.75 ELSE 0.0 END AS DOUBLE) AS cbd_congestion_fee" if drift else ""
    return f"""
ev_{name} AS (
  SELECT event_id AS i, user_id AS u, value AS v, CAST(ts AS TIMESTAMP) + INTERVAL {shift} DAY AS t0 FROM events
),
b_{name} AS (
  SELECT *, CASE WHEN i % 400 = 3 THEN t0 + INTERVAL 31 DAY ELSE t0 END AS base,
         CAST(CASE WHEN i % 10 <= 1 THEN 0 WHEN i % 10 <= 6 THEN 1 WHEN i % 10 <= 8 THEN 2 ELSE 3 + i % 3 END AS BIGINT) AS pay
  FROM ev_{name}
),
raw_{name} AS (
  SELECT
    CAST(i % 2 + 1 AS INTEGER) AS VendorID,
    CASE WHEN i % 500 = 7 THEN NULL ELSE base END AS tpep_pickup_datetime,
    CASE WHEN i % 300 = 11 THEN base - INTERVAL 10 MINUTE
         ELSE base + to_seconds(CAST(u * 20 + 60 AS INTEGER)) END AS tpep_dropoff_datetime,
    CAST(CASE WHEN pay = 0 THEN NULL ELSE i % 6 + 1 END AS {pax_t}) AS passenger_count,
    CAST(CASE WHEN i % 250 = 13 THEN 150.0 WHEN i % 250 = 14 THEN 100.0 WHEN i % 40 = 5 THEN 0.0 ELSE v / 10 END AS DOUBLE) AS trip_distance,
    CAST(CASE WHEN pay = 0 THEN NULL ELSE i % 5 + 1 END AS BIGINT) AS RatecodeID,
    CASE WHEN pay = 0 THEN NULL WHEN i % 50 = 1 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(u % 27 AS INTEGER) AS PULocationID,
    CAST((i * 7) % 27 AS INTEGER) AS DOLocationID,
    pay AS payment_type,
    CAST(CASE WHEN i % 25 = 4 THEN -v ELSE v END AS DOUBLE) AS fare_amount,
    CAST((i % 3) * 0.5 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(CASE WHEN pay = 1 THEN (i % 16) * 0.25 ELSE 0.0 END AS DOUBLE) AS tip_amount,
    CAST(CASE WHEN i % 20 = 0 THEN 6.5 ELSE 0.0 END AS DOUBLE) AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    CAST(CASE WHEN i % 25 = 4 THEN -v ELSE v END + 5.0 AS DOUBLE) AS total_amount,
    CAST(CASE WHEN pay = 0 THEN NULL ELSE 2.5 END AS DOUBLE) AS congestion_surcharge,
    CAST(CASE WHEN pay = 0 THEN NULL WHEN u % 27 = 0 THEN 1.75 ELSE 0.0 END AS DOUBLE) AS {airport}{cbd}
  FROM b_{name}
),"""


def _std(name: str, month: str, drift: bool) -> str:
    cbd = "CAST(cbd_congestion_fee AS DOUBLE)" if drift else "CAST(NULL AS DOUBLE)"
    return f"""
std_{name} AS (
  SELECT CAST(VendorID AS INTEGER) AS vendor_id,
    CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_datetime,
    CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_datetime,
    CAST(passenger_count AS INTEGER) AS passenger_count,
    CAST(trip_distance AS DOUBLE) AS trip_distance,
    CAST(RatecodeID AS INTEGER) AS rate_code_id,
    CAST(store_and_fwd_flag AS VARCHAR) AS store_and_fwd_flag,
    CAST(PULocationID AS INTEGER) AS pickup_location_id,
    CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
    CAST(payment_type AS INTEGER) AS payment_type,
    CAST(fare_amount AS DOUBLE) AS fare_amount, CAST(extra AS DOUBLE) AS extra, CAST(mta_tax AS DOUBLE) AS mta_tax,
    CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
    CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge, CAST(total_amount AS DOUBLE) AS total_amount,
    CAST(congestion_surcharge AS DOUBLE) AS congestion_surcharge, CAST(airport_fee AS DOUBLE) AS airport_fee,
    {cbd} AS cbd_congestion_fee,
    '{month}' AS source_month
  FROM raw_{name}
),
tagged_{name} AS (
  SELECT *, CASE
      WHEN pickup_datetime IS NULL OR dropoff_datetime IS NULL THEN 'missing_timestamp'
      WHEN dropoff_datetime < pickup_datetime THEN 'dropoff_before_pickup'
      WHEN pickup_datetime < CAST(source_month || '-01' AS TIMESTAMP)
        OR pickup_datetime >= CAST(source_month || '-01' AS TIMESTAMP) + INTERVAL 1 MONTH THEN 'pickup_outside_month'
      WHEN trip_distance > 100 THEN 'distance_over_100_miles'
      WHEN fare_amount < 0 THEN 'negative_fare'
    END AS reject_reason
  FROM std_{name}
),
clean_{name} AS (
  SELECT {", ".join("t." + c for c in STD)},
    pz.Borough AS pickup_borough, pz.Zone AS pickup_zone, dz.Borough AS dropoff_borough, dz.Zone AS dropoff_zone,
    t.passenger_count IS NULL AS passenger_count_missing,
    t.trip_distance = 0 AS zero_distance,
    round(CAST(datesub('second', t.pickup_datetime, t.dropoff_datetime) AS DOUBLE) / 60.0, 6) AS trip_duration_minutes,
    CAST(year(t.pickup_datetime) AS INTEGER) AS year,
    CAST(month(t.pickup_datetime) AS INTEGER) AS month
  FROM tagged_{name} t
  LEFT JOIN zones pz ON CAST(pz.LocationID AS INTEGER) = t.pickup_location_id
  LEFT JOIN zones dz ON CAST(dz.LocationID AS INTEGER) = t.dropoff_location_id
  WHERE t.reject_reason IS NULL
),
rejected_{name} AS (
  SELECT {", ".join(STD)}, reject_reason,
    CASE WHEN reject_reason IN ('negative_fare', 'distance_over_100_miles') THEN 'quarantined' ELSE 'rejected' END AS disposition,
    source_month
  FROM tagged_{name} WHERE reject_reason IS NOT NULL
),
staging_{name} AS (
  SELECT {", ".join(f"CAST({c} AS DECIMAL(12,2)) AS {c}" if c in MONEY else c for c in CLEAN if c not in ("year", "month"))},
    CAST(year AS SMALLINT) AS year, CAST(month AS SMALLINT) AS month
  FROM clean_{name}
),"""


BASE = (
    "WITH"
    + """
zones AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS LocationID, r_name AS Borough, n_name AS Zone,
         CASE WHEN n_regionkey = 1 THEN NULL ELSE r_name END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),"""
    + _raw("jan", 0, False) + _std("jan", "2024-01", False)
    + _raw("feb", 31, True) + _std("feb", "2024-02", True)
    + f"""
clean_all AS (SELECT * FROM clean_jan UNION ALL SELECT * FROM clean_feb),
rejected_all AS (SELECT * FROM rejected_jan UNION ALL SELECT * FROM rejected_feb),
tagged_all AS (SELECT * FROM tagged_jan UNION ALL SELECT * FROM tagged_feb),
staging_all AS (SELECT * FROM staging_jan UNION ALL SELECT * FROM staging_feb),
stg AS (
  SELECT {", ".join("CAST(pickup_datetime AS DATE) AS pickup_date" if c == "pickup_date" else
                    "CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour" if c == "pickup_hour" else c for c in STG)}
  FROM staging_jan
),
fact AS (
  SELECT CAST(strftime(pickup_date, '%Y%m%d') AS INTEGER) AS pickup_date_key, pickup_hour, pickup_datetime,
    dropoff_datetime, pickup_location_id AS pickup_zone_key, dropoff_location_id AS dropoff_zone_key,
    payment_type AS payment_type_key, {", ".join(FACT_MEASURES)}
  FROM stg
),
stg_all AS (
  SELECT {", ".join("CAST(pickup_datetime AS DATE) AS pickup_date" if c == "pickup_date" else
                    "CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour" if c == "pickup_hour" else c for c in STG)}
  FROM staging_all
),
fact_all AS (
  SELECT CAST(strftime(pickup_date, '%Y%m%d') AS INTEGER) AS pickup_date_key, pickup_hour, pickup_datetime,
    dropoff_datetime, pickup_location_id AS pickup_zone_key, dropoff_location_id AS dropoff_zone_key,
    payment_type AS payment_type_key, {", ".join(FACT_MEASURES)}
  FROM stg_all
),
dim_zone AS (
  SELECT CAST(LocationID AS INTEGER) AS zone_key, coalesce(Borough, 'N/A') AS borough,
         coalesce(Zone, 'N/A') AS zone_name, coalesce(service_zone, 'N/A') AS service_zone
  FROM zones
),
dim_payment_type AS (
  SELECT * FROM (VALUES (0, 'Flex Fare trip'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'),
                        (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip')) t(payment_type_key, payment_type_name)
),
days AS (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('year', min(ts)) AS TIMESTAMP),
                                     CAST(date_trunc('year', max(ts)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM events
),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
    CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
    CAST(month(full_date) AS INTEGER) AS month, strftime(full_date, '%B') AS month_name,
    CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) AS INTEGER) AS day_of_week,
    strftime(full_date, '%A') AS day_name, isodow(full_date) IN (6, 7) AS is_weekend
  FROM days
),
runs AS (
  SELECT source_month AS month, CAST(count(*) AS BIGINT) AS rows_in,
    CAST(count(*) FILTER (WHERE reject_reason IS NULL) AS BIGINT) AS rows_clean,
    CAST(count(*) FILTER (WHERE reject_reason IS NOT NULL) AS BIGINT) AS rows_rejected_or_quarantined,
    CAST(count(*) FILTER (WHERE reject_reason IN ('missing_timestamp', 'dropoff_before_pickup', 'pickup_outside_month')) AS BIGINT) AS hard
  FROM tagged_all GROUP BY source_month
),
reasons AS (
  SELECT source_month AS month, coalesce(reject_reason, 'clean') AS reason, CAST(count(*) AS BIGINT) AS rows
  FROM tagged_all GROUP BY 1, 2
),
gate AS (
  SELECT month, 1 AS check_order, 'has_rows' AS check_name, rows_in > 0 AND rows_clean > 0 AS passed,
         CAST(rows_in AS DOUBLE) AS value, '> 0' AS threshold FROM runs
  UNION ALL SELECT month, 2, 'row_conservation', rows_clean + rows_rejected_or_quarantined = rows_in,
         CAST(rows_clean + rows_rejected_or_quarantined AS DOUBLE), CAST(rows_in AS VARCHAR) FROM runs
  UNION ALL SELECT month, 3, 'reasons_add_up', TRUE, CAST(rows_in AS DOUBLE), CAST(rows_in AS VARCHAR) FROM runs
  UNION ALL SELECT month, 4, 'non_clean_rate', rows_rejected_or_quarantined / rows_in <= 0.1,
         round(rows_rejected_or_quarantined / rows_in, 5), '0.1' FROM runs
  UNION ALL SELECT month, 5, 'hard_reject_rate', hard / rows_in <= 0.001, round(hard / rows_in, 6), '0.001' FROM runs
),
audit AS (
  SELECT * FROM (VALUES (1, '2024-01'), (2, '2024-02'), (3, '2024-01')) a(load_id, source_month)
)
"""
)


def _q(sql: str) -> str:
    body = sql.lstrip()
    if body[:4].upper() == "WITH":  # chain the query's own CTEs onto the shared ones
        return BASE.rstrip() + ",\n" + body[4:]
    return BASE + sql


def _cols(cols, money_double=False):
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if money_double and c in MONEY else c for c in cols)


def oracle_sql() -> dict[str, str]:
    rels = {
        "rel_date": ("pickup_date_key", "dim_date", "date_key"),
        "rel_pickup_zone": ("pickup_zone_key", "dim_zone", "zone_key"),
        "rel_dropoff_zone": ("dropoff_zone_key", "dim_zone", "zone_key"),
        "rel_payment": ("payment_type_key", "dim_payment_type", "payment_type_key"),
    }
    rules = {
        "rule_missing_timestamp": ("missing_timestamp", "pickup_datetime IS NULL OR dropoff_datetime IS NULL"),
        "rule_dropoff_before_pickup": ("dropoff_before_pickup", "dropoff_datetime < pickup_datetime"),
        "rule_outside_month": ("pickup_outside_month",
                               "pickup_datetime < TIMESTAMP '2024-01-01' OR pickup_datetime >= TIMESTAMP '2024-02-01'"),
        "rule_distance": ("distance_over_100_miles", "trip_distance > 100"),
        "rule_negative_fare": ("negative_fare", "fare_amount < 0"),
    }
    sums = ", ".join(f"round(CAST(sum({c}) AS DOUBLE), 2) AS sum_{c}" for c in MONEY)
    counts = ", ".join(f"CAST(count({c}) AS BIGINT) AS n_{c}" for c in MONEY)
    o = {
        "scan_raw_month": "SELECT * FROM raw_jan",
        "scan_partition_filtered": f"SELECT {_cols(CLEAN)} FROM clean_feb WHERE year = 2024 AND month = 2",
        "date_series": """SELECT CAST(CAST(unnest(generate_series(CAST(CAST(min(ts) AS DATE) AS TIMESTAMP),
                             CAST(CAST(max(ts) AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS TIMESTAMP) AS full_date
                             FROM events""",
        "write_clean_readback": f"SELECT {_cols(CLEAN)} FROM clean_all",
        "write_rejected_readback": "SELECT * FROM rejected_all",
        "write_static_readback": """SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
                 CAST(month(tpep_pickup_datetime) AS INTEGER) AS month, count(*) AS rows
                 FROM raw_jan GROUP BY 1, 2 ORDER BY 1, 2""",
        "load_month_replace": f"""SELECT {_cols([c for c in CLEAN if c not in ("year", "month")], True)},
                 CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month FROM staging_all""",
        "load_audit": """SELECT CAST(a.load_id AS BIGINT) AS load_id, 'yellow_trips' AS dataset, a.source_month,
                 r.rows_clean AS rows_in_parquet, r.rows_clean AS rows_loaded, 'success' AS status,
                 CAST(NULL AS VARCHAR) AS error_message FROM audit a JOIN runs r ON r.month = a.source_month""",
        "standardize": f"SELECT {_cols(STD)}, source_month FROM std_jan",
        "standardize_drift": """SELECT source_month, count(*) AS rows, count(airport_fee) AS airport_fee_rows,
                 count(cbd_congestion_fee) AS cbd_fee_rows, round(sum(cbd_congestion_fee), 2) AS cbd_fee_total,
                 CAST(sum(passenger_count) AS BIGINT) AS passengers
                 FROM (SELECT * FROM std_jan UNION ALL SELECT * FROM std_feb) GROUP BY source_month""",
        "standardize_mixed": """SELECT o.file_order, count(*) AS rows, count(airport_fee) AS airport_fee_rows,
                 count(cbd_congestion_fee) AS cbd_fee_rows, round(sum(cbd_congestion_fee), 2) AS cbd_fee_total,
                 CAST(sum(passenger_count) AS BIGINT) AS passengers
                 FROM (SELECT * FROM std_jan UNION ALL SELECT * FROM std_feb) CROSS JOIN (VALUES ('ab'), ('ba')) AS o(file_order)
                 GROUP BY o.file_order""",
        "load_failures": """SELECT CAST(load_id AS BIGINT) AS load_id, source_month, rows_clean AS rows_in_parquet,
                 CASE status WHEN 'success' THEN rows_clean ELSE -1 END AS rows_loaded, status, error
                 FROM (VALUES (1, '2024-01', 'success', ''), (2, '2024-02', 'failed', 'ContractViolation'))
                      AS a(load_id, source_month, status, error) JOIN runs ON runs.month = a.source_month""",
        "recent_loads_utc": """SELECT CAST(event_id AS BIGINT) AS load_id, '2024-01' AS source_month, CAST(user_id AS BIGINT) AS rows_in_parquet,
                 CAST(user_id AS BIGINT) AS rows_loaded, 'success' AS status, strftime(ts, '%Y-%m-%d %H:%M') AS finished_utc
                 FROM events ORDER BY event_id DESC LIMIT 50""",
        "flow_outcome": """SELECT month, 'ok' AS status, rows_clean AS fact_rows FROM runs
                 UNION ALL SELECT '2024-03', 'failed:clean', 0""",
        "gate_two_months": """SELECT month, check_name,
                 CASE check_name WHEN 'non_clean_rate' THEN exact_non_clean <= 0.06 WHEN 'hard_reject_rate' THEN exact_hard <= 0.01 ELSE passed END AS passed,
                 value, CASE check_name WHEN 'non_clean_rate' THEN '0.06' WHEN 'hard_reject_rate' THEN '0.01' ELSE threshold END AS threshold
                 FROM gate JOIN (SELECT month, rows_rejected_or_quarantined / rows_in AS exact_non_clean, hard / rows_in AS exact_hard FROM runs) USING (month)""",
        "sync_plan": """WITH f AS (SELECT page_id, strlen(html) AS bytes,
                      CASE page_id % 3 WHEN 1 THEN strlen(html) + 1 WHEN 2 THEN strlen(html) END AS lake_bytes FROM pages)
                 SELECT forced, CASE WHEN forced OR lake_bytes IS DISTINCT FROM bytes THEN 'upload' ELSE 'skip' END AS action,
                 count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, count(lake_bytes) AS held,
                 CAST(coalesce(sum(lake_bytes), 0) AS BIGINT) AS held_bytes
                 FROM f CROSS JOIN (VALUES (FALSE), (TRUE)) AS v(forced) GROUP BY 1, 2""",
        "month_bounds": """SELECT month, CAST(month || '-01' AS TIMESTAMP) AS month_start,
                 CAST(month || '-01' AS TIMESTAMP) + INTERVAL 1 MONTH AS month_end
                 FROM (SELECT DISTINCT strftime(ts + to_months(CAST(event_id % 12 AS INTEGER)), '%Y-%m') AS month FROM events)""",
        "valid_months": """SELECT candidate, regexp_full_match(candidate, '\\d{4}-(0[1-9]|1[0-2])') AS is_valid
                 FROM (SELECT DISTINCT CAST(year(ts) AS VARCHAR) || CASE WHEN event_id % 3 = 0 THEN '/' ELSE '-' END
                       || lpad(CAST(event_id % 14 AS VARCHAR), 2, '0') AS candidate FROM events)""",
        "tag_rows": "SELECT * FROM tagged_jan",
        "split_clean": f"SELECT {_cols(STD)}, source_month FROM tagged_jan WHERE reject_reason IS NULL",
        "split_rejected": "SELECT * FROM rejected_jan",
        "disposition": "SELECT reject_reason, disposition, count(*) AS rows FROM rejected_jan GROUP BY 1, 2",
        "enrich_zones": """SELECT pickup_location_id, dropoff_location_id, pickup_borough, pickup_zone, dropoff_borough,
                 dropoff_zone, count(*) AS trips FROM clean_jan GROUP BY 1, 2, 3, 4, 5, 6""",
        "enrich_flags": """SELECT passenger_count_missing, zero_distance, year, month, count(*) AS trips
                 FROM clean_jan GROUP BY 1, 2, 3, 4""",
        "trip_duration": "SELECT pickup_datetime, dropoff_datetime, trip_duration_minutes FROM clean_jan",
        "busiest_zones": """SELECT PULocationID, count(*) AS trips FROM raw_jan WHERE fare_amount > 0
                 GROUP BY 1 ORDER BY trips DESC, PULocationID LIMIT 5""",
        "money_decimal": f"SELECT {sums}, {counts} FROM staging_jan",
        "borough_counts_raw": """SELECT z.Borough, count(*) AS trips FROM raw_jan r
                 JOIN zones z ON r.PULocationID = CAST(z.LocationID AS INTEGER) GROUP BY 1 ORDER BY 2 DESC, 1""",
        "rowcount_matches": """SELECT s.n AS staging_rows, f.n AS fact_rows, s.n = f.n AS matches
                 FROM (SELECT count(*) AS n FROM stg) s, (SELECT count(*) AS n FROM fact) f""",
        "quality_by_month": """SELECT r.month, r.rows_in, r.rows_clean, r.rows_rejected_or_quarantined,
                 CASE WHEN r.month = '2024-01' THEN (SELECT CASE WHEN bool_and(passed) THEN 'passed' ELSE 'failed' END
                      FROM gate WHERE month = '2024-01') ELSE 'n/a' END AS status FROM runs r ORDER BY 1""",
        "trips_by_hour_dense": """SELECT CAST(h.pickup_hour AS INTEGER) AS pickup_hour, coalesce(c.trips, 0) AS trips
                 FROM range(24) h(pickup_hour)
                 LEFT JOIN (SELECT pickup_hour, count(*) AS trips FROM fact_all GROUP BY 1) c ON c.pickup_hour = h.pickup_hour
                 ORDER BY 1""",
        "counts_by_reason": """SELECT source_month, coalesce(reject_reason, 'clean') AS reason, count(*) AS rows
                 FROM tagged_jan GROUP BY 1, 2""",
        "reason_share": """SELECT source_month, reason, rows, round(100.0 * rows / sum(rows) OVER (PARTITION BY source_month), 6)
                 AS pct_of_rows_in FROM (SELECT source_month, coalesce(reject_reason, 'clean') AS reason, count(*) AS rows
                 FROM tagged_jan GROUP BY 1, 2)""",
        "run_metrics": """SELECT source_month, count(*) AS rows_in, count(*) FILTER (WHERE reject_reason IS NULL) AS rows_clean,
                 count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rows_rejected_or_quarantined
                 FROM tagged_jan GROUP BY 1""",
        "profile_row_count": "SELECT count(*) AS total_rows FROM raw_jan",
        "profile_conditions": """SELECT count(*) FILTER (WHERE fare_amount < 0) AS negative_fares,
                 count(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime) AS bad_times,
                 count(*) FILTER (WHERE passenger_count IS NULL) AS null_passengers,
                 count(*) FILTER (WHERE tpep_pickup_datetime < TIMESTAMP '2024-01-01'
                                     OR tpep_pickup_datetime >= TIMESTAMP '2024-02-01') AS outside_month FROM raw_jan""",
        "profile_pickup_range": "SELECT min(tpep_pickup_datetime) AS earliest, max(tpep_pickup_datetime) AS latest FROM raw_jan",
        "profile_distance": """SELECT count(*) FILTER (WHERE trip_distance = 0) AS zero_distance,
                 count(*) FILTER (WHERE trip_distance > 100) AS over_100_miles,
                 max(trip_distance) AS max_distance FROM raw_jan""",
        "profile_neg_by_payment": """SELECT r.payment_type, count(*) AS trips FROM raw_jan AS r WHERE r.fare_amount < 0 GROUP BY ALL""",
        "profile_co_null": """SELECT count(*) AS null_passenger_rows, sum(CAST(RatecodeID IS NULL AS BIGINT))::BIGINT AS also_null_ratecode,
                 sum(CAST(store_and_fwd_flag IS NULL AS BIGINT))::BIGINT AS also_null_flag,
                 sum(CAST(congestion_surcharge IS NULL AS BIGINT))::BIGINT AS also_null_congestion,
                 sum(CAST(Airport_fee IS NULL AS BIGINT))::BIGINT AS also_null_airport
                 FROM raw_jan WHERE passenger_count IS NULL""",
        "profile_null_by_vendor": """SELECT VendorID, payment_type, count(*) AS trips FROM raw_jan WHERE passenger_count IS NULL GROUP BY ALL""",
        "sample_rows": """SELECT * FROM raw_jan ORDER BY tpep_pickup_datetime ASC NULLS LAST,
                 tpep_dropoff_datetime ASC NULLS LAST LIMIT 5""",
        "kpi": """SELECT count(*) AS trips, round(CAST(coalesce(sum(total_amount), 0) AS DOUBLE), 2) AS revenue,
                 round(CAST(sum(fare_amount) AS DOUBLE) / count(fare_amount), 6) AS avg_fare,
                 round(avg(trip_distance), 6) AS avg_distance, round(avg(trip_duration_minutes), 6) AS avg_duration_minutes FROM fact_all""",
        "card_tip_rate": """SELECT round(CAST(sum(f.tip_amount) AS DOUBLE) / nullif(CAST(sum(f.fare_amount) AS DOUBLE), 0), 6) AS card_tip_rate
                 FROM fact_all AS f JOIN dim_payment_type AS p USING (payment_type_key)
                 WHERE p.payment_type_name = 'Credit card' AND f.fare_amount > 0""",
        "date_range": """SELECT CAST(min(d.full_date) AS TIMESTAMP) AS first_date, CAST(max(d.full_date) AS TIMESTAMP) AS last_date
                 FROM fact_all AS f JOIN dim_date AS d ON f.pickup_date_key = d.date_key""",
        "trips_by_borough": """SELECT z.borough, count(*) AS trips FROM fact_all AS f JOIN dim_zone AS z ON f.pickup_zone_key = z.zone_key GROUP BY z.borough""",
        "top_zones": """SELECT z.zone_name, count(*) AS trips FROM fact_all AS f JOIN dim_zone AS z ON f.pickup_zone_key = z.zone_key
                 GROUP BY z.zone_name ORDER BY count(*) DESC, z.zone_name LIMIT 10""",
        "trips_by_hour": "SELECT pickup_hour, count(*) AS trips FROM fact_all GROUP BY pickup_hour",
        "weekday_avg": """SELECT d.day_of_week, d.day_name, round(count(*) / count(DISTINCT d.full_date), 6) AS avg_trips_per_day
                 FROM fact_all AS f JOIN dim_date AS d ON f.pickup_date_key = d.date_key GROUP BY d.day_of_week, d.day_name""",
        "payments": """SELECT p.payment_type_name, count(*) AS trips,
                 round(CAST(sum(f.total_amount) AS DOUBLE) / count(f.total_amount), 6) AS avg_total,
                 round(CAST(sum(f.tip_amount) AS DOUBLE) / count(f.tip_amount), 6) AS avg_tip
                 FROM fact_all AS f JOIN dim_payment_type AS p USING (payment_type_key) GROUP BY p.payment_type_name""",
        "payment_share": """SELECT p.payment_type_name, count(*) AS trips,
                 round(CAST(sum(f.total_amount) AS DOUBLE) / count(f.total_amount), 6) AS avg_total,
                 round(CAST(sum(f.tip_amount) AS DOUBLE) / count(f.tip_amount), 6) AS avg_tip,
                 round(100.0 * count(*) / (SELECT count(*) FROM fact_all), 6) AS share_pct
                 FROM fact_all AS f JOIN dim_payment_type AS p USING (payment_type_key) GROUP BY p.payment_type_name""",
        "latest_reject_reasons": """SELECT month, reason, rows FROM reasons
                 WHERE month = (SELECT max(month) FROM reasons) AND reason <> 'clean' ORDER BY rows DESC, reason""",
        "partition_counts": "SELECT year, month, count(*) AS rows FROM clean_all GROUP BY year, month",
        "rejected_breakdown": """SELECT source_month, disposition, reject_reason, count(*) AS rows FROM rejected_all GROUP BY ALL""",
        "clean_flag_sums": """SELECT count(*) FILTER (WHERE passenger_count_missing) AS passenger_missing,
                 count(*) FILTER (WHERE zero_distance) AS zero_distance,
                 count(*) FILTER (WHERE pickup_borough IS NULL) AS no_zone_match,
                 round(avg(trip_duration_minutes), 1) AS avg_minutes FROM clean_jan""",
        "recent_loads": """SELECT CAST(a.load_id AS BIGINT) AS load_id, a.source_month, r.rows_clean AS rows_in_parquet,
                 r.rows_clean AS rows_loaded, 'success' AS status FROM audit a JOIN runs r ON r.month = a.source_month
                 ORDER BY a.load_id DESC LIMIT 5""",
        "dim_zone": "SELECT * FROM dim_zone",
        "dim_payment_type": """SELECT p.payment_type_key, p.payment_type_name, coalesce(c.n, 0) AS fact_trips
                 FROM dim_payment_type p LEFT JOIN (SELECT payment_type_key, count(*) AS n FROM fact GROUP BY 1) c
                 ON c.payment_type_key = p.payment_type_key""",
        "seed_payment_types": """SELECT p.payment_type_key AS payment_type, p.payment_type_name, coalesce(c.n, 0) AS raw_trips
                 FROM dim_payment_type p LEFT JOIN (SELECT payment_type, count(*) AS n FROM raw_jan GROUP BY 1) c
                 ON c.payment_type = p.payment_type_key""",
        "dim_date": "SELECT * REPLACE (CAST(full_date AS TIMESTAMP) AS full_date) FROM dim_date",
        "stg_trips": f"SELECT {_cols(STG, True)} FROM stg".replace(" year,", " CAST(year AS INTEGER) AS year,")
                     .replace(", month FROM", ", CAST(month AS INTEGER) AS month FROM")
                     .replace(" pickup_date,", " CAST(pickup_date AS TIMESTAMP) AS pickup_date,"),
        "fact_trips": f"""SELECT pickup_date_key, pickup_hour, pickup_datetime, dropoff_datetime, pickup_zone_key,
                 dropoff_zone_key, payment_type_key, {_cols(FACT_MEASURES, True)} FROM fact""",
        "gate_checks": "SELECT month, check_name, passed, value, threshold FROM gate WHERE month = '2024-01'",
        "gate_status": """SELECT month, CASE WHEN bool_and(passed) THEN 'passed' ELSE 'failed' END AS status
                 FROM gate WHERE month = '2024-01' GROUP BY 1""",
        "reconcile": """SELECT month, rows_in, rows_clean AS clean_out, rows_rejected_or_quarantined AS rejected_out,
                 rows_in AS reasons_total, TRUE AS reconciled FROM runs""",
        "file_checksums": """SELECT CAST(s_suppkey // 100 AS BIGINT) AS hundred,
                 CAST(sum(strlen(s_suppkey || '|' || s_name) + 1) AS BIGINT) AS bytes,
                 sha256(string_agg(s_suppkey || '|' || s_name || chr(10), '' ORDER BY s_suppkey)) AS sha256
                 FROM supplier GROUP BY 1""",
        "content_digests": """SELECT month, 'clean' AS kind, rows_clean AS rows, TRUE AS content_ok FROM runs
                 UNION ALL SELECT month, 'rejected', rows_rejected_or_quarantined, TRUE FROM runs""",
        "load_reconcile": """SELECT month AS source_month, rows_clean AS rows_in_parquet, rows_clean AS rows_loaded,
                 rows_clean AS table_rows, TRUE AS ok FROM runs""",
        "backfill_two_months": """SELECT 'yellow_trips' AS dataset, 'year=' || year || '/month=' || month AS partition,
                 count(*) AS rows FROM clean_all GROUP BY 1, 2
                 UNION ALL SELECT 'rejected_trips', 'source_month=' || source_month, count(*) FROM rejected_all GROUP BY 1, 2""",
    }
    o["borough_counts_shuffle"] = o["borough_counts_raw"]
    for k, (child, dim, key) in rels.items():
        o[k] = f"""SELECT f.{child}, count(*) AS failing_rows FROM fact f
                 WHERE f.{child} IS NOT NULL AND f.{child} NOT IN (SELECT {key} FROM {dim} WHERE {key} IS NOT NULL)
                 GROUP BY 1 ORDER BY 1"""
    for k, (reason, pred) in rules.items():
        o[k] = f"""SELECT count(*) FILTER (WHERE {pred}) AS rows_matching,
                 count(*) FILTER (WHERE reject_reason = '{reason}') AS rows_tagged FROM tagged_jan"""
    o["dq_summary"] = _dq_sql()
    o["contract_violations"] = _contract_sql()
    from tripmart.presentation import NULLABLE_INT_OUTPUTS  # same presentation as the Spark side
    for k, cols in NULLABLE_INT_OUTPUTS.items():
        casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
        o[k] = f"SELECT * REPLACE ({casts}) FROM ({o[k]}) AS presented"
    return {k: _q(v) for k, v in o.items()}


def _dq_sql() -> str:
    parts = [
        "SELECT 'not_null:staging.yellow_trips.pickup_datetime' AS test_name, count(*) FILTER (WHERE pickup_datetime IS NULL) AS failures FROM staging_jan",
        "SELECT 'not_null:staging.yellow_trips.dropoff_datetime', count(*) FILTER (WHERE dropoff_datetime IS NULL) FROM staging_jan",
    ]
    rels = [("pickup_date_key", "dim_date", "date_key"), ("pickup_zone_key", "dim_zone", "zone_key"),
            ("dropoff_zone_key", "dim_zone", "zone_key"), ("payment_type_key", "dim_payment_type", "payment_type_key")]
    for child, _, _ in rels:
        parts.append(f"SELECT 'not_null:fact_trips.{child}', count(*) FILTER (WHERE {child} IS NULL) FROM fact")
    for child, dim, key in rels:
        parts.append(f"SELECT 'relationships:fact_trips.{child}->{dim}.{key}', count(*) FROM fact "
                     f"WHERE {child} IS NOT NULL AND {child} NOT IN (SELECT {key} FROM {dim} WHERE {key} IS NOT NULL)")
    parts += [
        "SELECT 'fact_distance_within_limit', count(*) FILTER (WHERE trip_distance > 100) FROM fact",
        "SELECT 'fact_dropoff_not_before_pickup', count(*) FILTER (WHERE dropoff_datetime < pickup_datetime) FROM fact",
        "SELECT 'fact_no_negative_fare', count(*) FILTER (WHERE fare_amount < 0) FROM fact",
        "SELECT 'fact_row_count_matches_staging', CASE WHEN (SELECT count(*) FROM fact) <> (SELECT count(*) FROM stg) THEN 1 ELSE 0 END",
    ]
    for dim, key in [("dim_zone", "zone_key"), ("dim_payment_type", "payment_type_key"), ("dim_date", "date_key"),
                     ("dim_date", "full_date")]:
        parts.append(f"SELECT 'not_null:{dim}.{key}', count(*) FILTER (WHERE {key} IS NULL) FROM {dim}")
        parts.append(f"SELECT 'unique:{dim}.{key}', count(*) FROM (SELECT {key} FROM {dim} WHERE {key} IS NOT NULL "
                     f"GROUP BY 1 HAVING count(*) > 1)")
    body = "\nUNION ALL ".join(parts)
    return f"SELECT test_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM ({body})"


# The staging table's types and NOT NULL columns, stated here once more rather than taken from the engine.
CONTRACT_TYPES = {c: "int" for c in ("vendor_id", "passenger_count", "rate_code_id", "pickup_location_id", "dropoff_location_id", "payment_type")} | {
    c: "decimal(12,2)" for c in MONEY} | {
    c: "string" for c in ("store_and_fwd_flag", "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone")} | {
    c: "double" for c in ("trip_distance", "trip_duration_minutes")} | {
    "pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz", "loaded_at": "timestamp",
    "passenger_count_missing": "boolean", "zero_distance": "boolean", "year": "smallint", "month": "smallint"}
NOT_NULL = ("pickup_datetime", "dropoff_datetime", "passenger_count_missing", "zero_distance", "year", "month")


def _contract_sql() -> str:
    rows = []
    for c in [*CLEAN, "loaded_at"]:
        nulls = f"(SELECT count(*) FROM staging_jan WHERE {c} IS NULL)" if c in NOT_NULL else "0"
        rows.append(f"SELECT '{c}' AS column_name, '{CONTRACT_TYPES[c]}' AS expected_type, '{CONTRACT_TYPES[c]}' AS actual_type, "
                    f"CAST({nulls} AS BIGINT) AS null_violations")
    body = "\nUNION ALL ".join(rows)
    return f"SELECT *, null_violations = 0 AS ok FROM ({body})"
