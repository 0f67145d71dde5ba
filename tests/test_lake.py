"""Sinks, verify-then-publish, reruns, multi-month runs, warehouse loads and audit."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripmart.plans import monthly
from tripmart.plans.flow import run_flow
from tripmart.plans.marts import build_marts, run_data_tests, staging_view
from tripmart.plans.monthly import MISMATCH, OK, read_run_summaries, run_months
from tripmart.plans import publish
from tripmart.plans.publish import FileOps, partitions
from tripmart.plans.warehouse import load_months, read_audit
from tripmart.sources import fixture
from tripmart.sources.lake import read_month_partition, read_raw_months, read_table
from tripmart.sources.reference import payment_type_codes, read_zones_csv

SF = "/root/testdata/sf0.001"


def land(spark, lake, months=("2024-01",), drift_second=True):
    for m in months:
        df = fixture.raw_month_drifted(spark, SF, m) if (drift_second and m == "2024-02") else fixture.raw_month(spark, SF, m)
        df.write.mode("overwrite").parquet(lake.raw_month(m))
    fixture.zones(spark, SF).coalesce(1).write.mode("overwrite").option("header", True).csv(lake.raw_zones)
    return read_zones_csv(spark, lake.raw_zones)


def counts(spark, lake):
    c = {(r["year"], r["month"]): r["count"] for r in read_table(spark, lake, lake.clean).groupBy("year", "month").count().collect()}
    r = {r["source_month"]: r["count"] for r in read_table(spark, lake, lake.rejected).groupBy("source_month").count().collect()}
    return c, r


def test_two_months_with_drifted_schemas_in_one_job(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    res = run_months(spark, lake, ["2024-01", "2024-02"], zones)
    assert res.ok
    c, r = counts(spark, lake)
    assert c == {(2024, 1): 947, (2024, 2): res.outcomes["2024-02"].rows_clean}
    assert r["2024-01"] == 53
    for m, o in res.outcomes.items():
        assert o.rows_clean + o.rows_rejected == o.rows_in == 1000 and o.published
    std = read_raw_months(spark, lake, ["2024-01", "2024-02"])
    assert std.filter("source_month = '2024-02' AND cbd_congestion_fee IS NOT NULL").count() == 1000
    assert std.filter("source_month = '2024-01' AND cbd_congestion_fee IS NOT NULL").count() == 0
    runs = {r["month"]: r for r in read_run_summaries(spark, lake).collect()}
    assert runs["2024-01"]["counts_by_reason"]["clean"] == 947


def test_rerun_is_idempotent(spark, lake):
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    first = counts(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    assert counts(spark, lake) == first


def test_rerun_with_zero_rejected_rows_removes_stale_partition_t11(spark, lake):
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    assert list(partitions(FileOps(spark), lake, lake.rejected)) == ["source_month=2024-01"]
    # The corrected month has only clean rows now.
    std = read_raw_months(spark, lake, ["2024-01"])
    from tripmart.operators.clean import tag_rows
    good_only = tag_rows(std, "2024-01").filter("reject_reason IS NULL").drop("reject_reason")
    res = run_months(spark, lake, ["2024-01"], zones, raw={"2024-01": good_only})
    assert res.ok and res.outcomes["2024-01"].rows_rejected == 0
    assert not partitions(FileOps(spark), lake, lake.rejected)
    assert read_table(spark, lake, lake.clean).count() == 947


def test_mismatch_publishes_nothing(spark, lake, monkeypatch):
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    before = counts(spark, lake)
    real = monthly.split_rejected
    monkeypatch.setattr(monthly, "split_rejected", lambda t: real(t).filter("reject_reason <> 'negative_fare'"))
    res = run_months(spark, lake, ["2024-01"], zones)
    assert res.outcomes["2024-01"].code == MISMATCH and not res.outcomes["2024-01"].published
    assert counts(spark, lake) == before


def test_month_without_rows_reaches_the_gate(spark, lake):
    from tripmart.plans.gate import evaluate_months
    zones = land(spark, lake)
    fixture.raw_month(spark, SF).limit(0).write.mode("overwrite").parquet(lake.raw_month("2024-03"))
    res = run_months(spark, lake, ["2024-01", "2024-03"], zones)
    assert res.outcomes["2024-03"].code == OK and res.outcomes["2024-03"].rows_in == 0
    assert evaluate_months(spark, lake, ["2024-01", "2024-03"], max_hard_reject_rate=0.01) == {"2024-01": "passed", "2024-03": "failed"}


def test_one_month_folder_may_hold_both_schemas(spark, lake):
    """Old and new files side by side, whichever comes first in the listing."""
    zones = land(spark, lake)
    ops = FileOps(spark)
    for first, second in (("a", "b"), ("b", "a")):
        folder = lake.raw_month("2024-02")
        ops.delete(folder)
        fixture.raw_month(spark, SF, "2024-02").coalesce(1).write.parquet(lake.work("old"))
        fixture.raw_month_drifted(spark, SF, "2024-02").coalesce(1).write.parquet(lake.work("new"))
        for part, name in (("old", first), ("new", second)):
            ops.rename(ops.list_files(lake.work(part), ".parquet")[0], f"{folder}/{name}.parquet")
            ops.delete(lake.work(part))
        std = read_raw_months(spark, lake, ["2024-02"])
        assert std.agg(F.count("*"), F.count("cbd_congestion_fee"), F.count("airport_fee")).first()[:2] == (2000, 1000)
        res = run_months(spark, lake, ["2024-02"], zones)
        assert res.ok and res.outcomes["2024-02"].rows_in == 2000
        assert read_table(spark, lake, lake.clean).filter("month = 2 AND cbd_congestion_fee IS NOT NULL").count() > 900


def test_single_partition_selection_a5(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    run_months(spark, lake, ["2024-01", "2024-02"], zones)
    df = read_month_partition(spark, lake, lake.clean, 2024, 1)
    assert df.count() == 947 and {"year", "month"} <= set(df.columns)
    assert read_month_partition(spark, lake, lake.clean, 2030, 1).count() == 0


def test_load_is_idempotent_and_audited(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    run_months(spark, lake, ["2024-01", "2024-02"], zones)
    out = load_months(spark, lake, ["2024-01", "2024-02"])
    assert {m: o.status for m, o in out.items()} == {"2024-01": "success", "2024-02": "success"}
    load_months(spark, lake, ["2024-01"])
    st = staging_view(spark, lake)
    assert st.filter("year = 2024 AND month = 1").count() == 947
    types = dict(st.dtypes)
    assert types["fare_amount"] == "decimal(12,2)" and types["trip_duration_minutes"] == "double"
    assert types["year"] == "smallint"
    audit = read_audit(spark, lake).orderBy("load_id").collect()
    assert [(a["load_id"], a["source_month"], a["status"]) for a in audit] == [
        (1, "2024-01", "success"), (2, "2024-02", "success"), (3, "2024-01", "success")]
    assert all(a["rows_loaded"] == a["rows_in_parquet"] for a in audit)


def test_missing_month_is_not_audited(spark, lake):
    land(spark, lake)
    out = load_months(spark, lake, ["2030-01"])
    assert out["2030-01"].status == "missing"
    assert not FileOps(spark).exists(lake.audit_table)


def test_null_distance_fails_the_load_contract_and_keeps_old_month_t1(spark, lake):
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    load_months(spark, lake, ["2024-01"])
    # Rerun the month with one NULL-distance row: it is clean, but zero_distance is NULL.
    std = read_raw_months(spark, lake, ["2024-01"])
    bad = std.withColumn("trip_distance", F.when(F.col("vendor_id") == 1, F.lit(None)).otherwise(F.col("trip_distance")))
    run_months(spark, lake, ["2024-01"], zones, raw={"2024-01": bad})
    out = load_months(spark, lake, ["2024-01"])
    assert out["2024-01"].status == "failed" and "zero_distance" in out["2024-01"].error
    last = read_audit(spark, lake).orderBy(F.desc("load_id")).first()
    assert last["status"] == "failed" and len(last["error_message"]) <= 1000 and last["rows_loaded"] is None
    assert staging_view(spark, lake).filter("zero_distance IS NULL").count() == 0  # old month kept


def test_marts_and_data_tests_over_the_lake(spark, lake):
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    load_months(spark, lake, ["2024-01"])
    build_marts(spark, lake, zones, payment_type_codes(spark))
    res = {r["test_name"]: r["failures"] for r in run_data_tests(spark, lake).collect()}
    assert res["fact_row_count_matches_staging"] == 0
    assert res["unique:dim_date.date_key"] == 0
    assert res["relationships:fact_trips.payment_type_key->dim_payment_type.payment_type_key"] == 0
    # fixture trips use zone ids 25/26 that the zone lookup lacks (inner joins would drop them)
    assert res["relationships:fact_trips.dropoff_zone_key->dim_zone.zone_key"] > 0
    assert len(res) == 22


def test_flow_stops_at_gate_with_default_thresholds(spark, lake):
    land(spark, lake)
    res = run_flow(spark, lake, ["2024-01"])
    assert res.stages == {"clean": "ok", "gate": "failed"} and res.code == 3
    assert run_flow(spark, lake, ["2024-13"]).code == 2


def test_static_overwrite_replaces_the_whole_directory_t12(spark, lake):
    out = lake.work("static")
    df = spark.createDataFrame([(2024, 1, 1), (2024, 2, 2)], "year int, month int, v int")
    df.write.partitionBy("year", "month").parquet(out)
    spark.createDataFrame([(2024, 1, 3)], "year int, month int, v int").write.mode("overwrite") \
        .option("partitionOverwriteMode", "static").partitionBy("year", "month").parquet(out)
    assert [tuple(r) for r in spark.read.parquet(out).select("v", "year", "month").collect()] == [(3, 2024, 1)]


def test_timestamps_stay_ntz(spark, lake):
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    types = dict(read_table(spark, lake, lake.clean).dtypes)
    assert types["pickup_datetime"] == "timestamp_ntz"
    first = read_table(spark, lake, lake.clean).agg(F.min("pickup_datetime")).first()[0]
    assert isinstance(first, datetime) and first.tzinfo is None


def test_incremental_fact_rebuild_touches_only_given_months(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    run_months(spark, lake, ["2024-01", "2024-02"], zones)
    load_months(spark, lake, ["2024-01", "2024-02"])
    build_marts(spark, lake, zones, payment_type_codes(spark))
    from tripmart.plans.marts import read_marts
    full = read_marts(spark, lake)["fact_trips"]
    assert len(full.columns) == 24
    n_full = full.count()
    feb = partitions(FileOps(spark), lake, lake.mart("fact_trips"))["year=2024/month=2"]
    feb_files = sorted(FileOps(spark).list_files(feb, ".parquet"))
    build_marts(spark, lake, zones, payment_type_codes(spark), months=["2024-01"])
    assert read_marts(spark, lake)["fact_trips"].count() == n_full
    assert partitions(FileOps(spark), lake, lake.mart("fact_trips"))["year=2024/month=2"] == feb
    assert feb_files and sorted(FileOps(spark).list_files(feb, ".parquet")) == feb_files


def test_data_tests_scoped_to_months(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    run_months(spark, lake, ["2024-01", "2024-02"], zones)
    load_months(spark, lake, ["2024-01", "2024-02"])
    build_marts(spark, lake, zones, payment_type_codes(spark))
    full = {r["test_name"]: r["failures"] for r in run_data_tests(spark, lake).collect()}
    jan = {r["test_name"]: r["failures"] for r in run_data_tests(spark, lake, months=["2024-01"]).collect()}
    feb = {r["test_name"]: r["failures"] for r in run_data_tests(spark, lake, months=["2024-02"]).collect()}
    k = "relationships:fact_trips.dropoff_zone_key->dim_zone.zone_key"
    assert jan[k] + feb[k] == full[k] and jan["fact_row_count_matches_staging"] == 0


def test_register_table_refreshes_statistics_b10(spark, lake):
    from tripmart.plans.flow import register_lake_table
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    load_months(spark, lake, ["2024-01"])
    from tripmart.plans.flow import analyze_months
    register_lake_table(spark, "t_staging_yellow_trips", lake, lake.staging_table, analyze=True)
    stats = spark.sql("DESCRIBE TABLE EXTENDED t_staging_yellow_trips").filter("col_name = 'Statistics'").first()
    assert stats is not None and "947 rows" in stats["data_type"]
    assert spark.table("t_staging_yellow_trips").filter("year = 2024 AND month = 1").count() == 947
    analyze_months(spark, "t_staging_yellow_trips", ["2024-01"])
    part = spark.sql("DESCRIBE TABLE EXTENDED t_staging_yellow_trips PARTITION (year=2024, month=1)") \
        .filter("col_name = 'Partition Statistics'").first()
    assert "947 rows" in part["data_type"]


def test_flow_succeeds_end_to_end_with_complete_zones(spark, lake):
    zones = land(spark, lake)
    extra = spark.createDataFrame([("25", "NONE", "ZONE_25", None), ("26", "NONE", "ZONE_26", None)],
                                  "LocationID string, Borough string, Zone string, service_zone string")
    res = run_flow(spark, lake, ["2024-01"], zone_seed=zones.unionByName(extra), max_hard_reject_rate=0.01,
                   staging_table_name="flow_staging_trips")
    assert res.code == 0, res.detail
    part = spark.sql("DESCRIBE TABLE EXTENDED flow_staging_trips PARTITION (year=2024, month=1)") \
        .filter("col_name = 'Partition Statistics'").first()
    assert "947 rows" in part["data_type"]
    assert res.stages == {"clean": "ok", "gate": "ok", "load": "ok", "marts": "ok", "tests": "ok"}


def test_strict_modes_raise_typed_errors(spark, lake, monkeypatch):
    from tripmart.plans.warehouse import ContractViolation
    zones = land(spark, lake)
    with pytest.raises(FileNotFoundError):
        load_months(spark, lake, ["2024-01"], strict=True)
    real = monthly.split_rejected
    monkeypatch.setattr(monthly, "split_rejected", lambda t: real(t).filter("reject_reason <> 'negative_fare'"))
    with pytest.raises(monthly.CountMismatch):
        run_months(spark, lake, ["2024-01"], zones, strict=True)
    monkeypatch.setattr(monthly, "split_rejected", real)
    std = read_raw_months(spark, lake, ["2024-01"])
    bad = std.withColumn("trip_distance", F.lit(None).cast("double"))
    run_months(spark, lake, ["2024-01"], zones, raw={"2024-01": bad}, strict=True)
    with pytest.raises(ContractViolation):
        load_months(spark, lake, ["2024-01"], strict=True)
    assert read_audit(spark, lake).filter("status = 'failed'").count() == 1


def test_missing_inputs_are_failed_input(spark, lake):
    zones = land(spark, lake)
    res = run_months(spark, lake, ["2024-01", "2024-05"], zones)
    assert res.outcomes["2024-05"].code == monthly.FAILED_INPUT and res.outcomes["2024-01"].code == OK
    assert not res.ok and res.outcomes["2024-01"].published
    flow = run_flow(spark, lake, ["2024-05"])
    assert flow.code == 1 and flow.stages == {"clean": "failed"}
    from tripmart.sources.lake import Lake
    empty = Lake(lake.root + "-nozones")
    assert run_flow(spark, empty, ["2024-01"]).code == 1


def test_failing_load_job_is_audited_and_raised(spark, lake):
    zones = land(spark, lake)
    std = read_raw_months(spark, lake, ["2024-01"])
    huge = std.withColumn("fare_amount", F.when(F.col("fare_amount") >= 0, F.lit(1e12)).otherwise(F.col("fare_amount")))
    run_months(spark, lake, ["2024-01"], zones, raw={"2024-01": huge})
    with pytest.raises(Exception):  # 1e12 does not fit decimal(12,2): ANSI raises
        load_months(spark, lake, ["2024-01"])
    last = read_audit(spark, lake).orderBy(F.desc("load_id")).first()
    assert last["status"] == "failed" and last["rows_loaded"] is None and len(last["error_message"]) <= 1000
    assert not partitions(FileOps(spark), lake, lake.staging_table)


def test_contract_failure_of_one_month_does_not_block_another(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    std1 = read_raw_months(spark, lake, ["2024-01"])
    bad = std1.withColumn("trip_distance", F.when(F.col("vendor_id") == 1, F.lit(None)).otherwise(F.col("trip_distance")))
    run_months(spark, lake, ["2024-01", "2024-02"], zones,
               raw={"2024-01": bad, "2024-02": read_raw_months(spark, lake, ["2024-02"])})
    out = load_months(spark, lake, ["2024-01", "2024-02"])
    assert out["2024-01"].status == "failed" and "2024-01" in out["2024-01"].error
    assert out["2024-02"].status == "success"


def test_flow_months_progress_independently(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    extra = spark.createDataFrame([("25", "NONE", "ZONE_25", None), ("26", "NONE", "ZONE_26", None)],
                                  "LocationID string, Borough string, Zone string, service_zone string")
    run = run_months(spark, lake, ["2024-01", "2024-02"], zones)
    hard = {}
    for m, o in run.outcomes.items():
        rs = {r["month"]: r for r in read_run_summaries(spark, lake).collect()}[m]["counts_by_reason"]
        hard[m] = sum(rs.get(k, 0) for k in ("missing_timestamp", "dropoff_before_pickup", "pickup_outside_month")) / o.rows_in
    assert hard["2024-02"] > hard["2024-01"]
    res = run_flow(spark, lake, ["2024-01", "2024-02"], zone_seed=zones.unionByName(extra),
                   max_hard_reject_rate=hard["2024-01"])
    assert res.month_status == {"2024-02": "failed:gate", "2024-01": "ok"}
    assert res.code == 3 and res.stages["gate"] == "failed" and res.stages["load"] == "ok"
    loaded = {r["source_month"] for r in read_audit(spark, lake).collect()}
    assert loaded == {"2024-01"}


def test_forced_ingest_keeps_the_old_month_when_the_publish_fails(spark, lake, monkeypatch):
    from tripmart.plans import ingest
    from tripmart.sources.lake import raw_folder
    landed = lake.work("landed")
    fixture.raw_month(spark, SF).write.parquet(landed)
    assert ingest.ingest_month(spark, lake, "2024-01", landed) == "published"
    assert ingest.ingest_month(spark, lake, "2024-01", landed) == "skipped"
    before = raw_folder(spark, lake, "2024-01")

    def refuses(*_):
        raise OSError("simulated failure")
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "commit", refuses)
        with pytest.raises(OSError):
            ingest.ingest_month(spark, lake, "2024-01", landed, force=True)
    assert raw_folder(spark, lake, "2024-01") == before and spark.read.parquet(before).count() == 1000
    assert len(FileOps(spark).list_dirs(lake.raw_month("2024-01"))) == 1  # nothing of the failed one is left
    assert ingest.ingest_month(spark, lake, "2024-01", landed, force=True) == "published"
    assert raw_folder(spark, lake, "2024-01") != before
    fixture.zones(spark, SF).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    assert run_months(spark, lake, ["2024-01"], read_zones_csv(spark, lake.raw_zones)).outcomes["2024-01"].rows_in == 1000


def test_every_failure_of_a_load_is_audited(spark, lake, monkeypatch):
    from tripmart.plans import warehouse
    zones = land(spark, lake, ("2024-01", "2024-02"))
    run_months(spark, lake, ["2024-01", "2024-02"], zones)

    def refuses(*_):
        raise OSError("simulated failure of the commit")
    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "commit", refuses)
        assert {m: o.status for m, o in load_months(spark, lake, ["2024-01", "2024-02"]).items()} == {"2024-01": "failed", "2024-02": "failed"}
    assert not partitions(FileOps(spark), lake, lake.staging_table)
    assert load_months(spark, lake, ["2024-01"])["2024-01"].status == "success"

    def unreadable(*_):
        raise RuntimeError("simulated read-back failure")
    monkeypatch.setattr(warehouse, "_read_back", unreadable)
    with pytest.raises(RuntimeError):
        load_months(spark, lake, ["2024-01", "2024-02"])
    audit = [(r["source_month"], r["status"], (r["error_message"] or "").split(":")[0])
             for r in read_audit(spark, lake).orderBy("load_id").collect()]
    assert audit == [("2024-01", "failed", "OSError"), ("2024-02", "failed", "OSError"), ("2024-01", "success", ""),
                     ("2024-01", "failed", "RuntimeError"), ("2024-02", "failed", "RuntimeError")]
    assert len(FileOps(spark).list_dirs(lake.staging_table)) == 1  # no folder of a failed load is left
    assert staging_view(spark, lake).count() == 947


def test_load_refuses_columns_outside_the_contract(spark, lake):
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    extra = read_table(spark, lake, lake.clean).withColumn("surprise", F.lit(1))
    extra.write.partitionBy("year", "month").parquet(lake.work("extra"))
    with publish.writing(spark, lake) as lease:
        FileOps(spark).rename(f"{lake.work('extra')}/year=2024/month=1", f"{lake.clean}/version=vextra/year=2024/month=1")
        publish.commit(lease, {(lake.clean, "year=2024/month=1"): f"{lake.clean}/version=vextra/year=2024/month=1"})
    out = load_months(spark, lake, ["2024-01"])
    assert out["2024-01"].status == "failed" and "surprise" in out["2024-01"].error
    assert read_audit(spark, lake).first()["status"] == "failed"


def test_full_fact_rebuild_drops_months_gone_from_staging(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    run_months(spark, lake, ["2024-01", "2024-02"], zones)
    load_months(spark, lake, ["2024-01", "2024-02"])
    build_marts(spark, lake, zones, payment_type_codes(spark))
    with publish.writing(spark, lake) as lease:
        publish.commit(lease, {(lake.staging_table, "year=2024/month=2"): None})
    build_marts(spark, lake, zones, payment_type_codes(spark))
    assert read_table(spark, lake, lake.mart("fact_trips")).count() == staging_view(spark, lake).count() == 947


def test_batched_backfill_equals_one_job(spark, lake):
    from tripmart.plans.monthly import run_months_batched
    zones = land(spark, lake, ("2024-01", "2024-02"))
    res = run_months_batched(spark, lake, ["2024-02", "2024-01"], zones, batch=1)
    assert res.ok and sorted(res.outcomes) == ["2024-01", "2024-02"]
    c, r = counts(spark, lake)
    assert c[(2024, 1)] == 947 and r["2024-01"] == 53


def test_dashboard_datasets_published(spark, lake):
    from tripmart.plans.dashboard import publish_dashboard, read_dashboard
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    load_months(spark, lake, ["2024-01"])
    build_marts(spark, lake, zones, payment_type_codes(spark))
    paths = publish_dashboard(spark, lake)
    assert {"kpi", "trips_by_borough", "top_zones", "payments", "recent_loads", "quality_by_month"} <= set(paths)
    assert read_dashboard(spark, lake, "kpi").first()["trips"] == 947
    assert read_dashboard(spark, lake, "trips_by_hour").count() == 24


def test_existing_lake_with_earlier_summary_documents(spark, lake):
    import json
    import os
    from tripmart.sources.lake import read_summary_documents
    zones = land(spark, lake)
    root = lake.root[len("file:"):] if lake.root.startswith("file:") else lake.root
    os.makedirs(f"{root}/processed/_runs", exist_ok=True)
    open(f"{root}/processed/_runs/clean_2023-12.json", "w").write(json.dumps(
        {"month": "2023-12", "rows_in": 5, "rows_clean": 5, "rows_rejected_or_quarantined": 0,
         "counts_by_reason": {"clean": 5}}, indent=2))
    res = run_flow(spark, lake, ["2024-01"], max_hard_reject_rate=0.01)
    assert res.stages["gate"] == "ok" and res.stages["load"] == "ok"
    assert [r["month"] for r in read_summary_documents(spark, lake.legacy_runs).collect()] == ["2023-12"]
    assert [r["month"] for r in read_run_summaries(spark, lake).collect()] == ["2024-01"]
