"""Reconciliation by content: rows that change without changing any count are refused or reported."""
import pytest
from pyspark.sql import functions as F
from test_lake import land

from tripmart.functions.digest import digest_of, row_hash
from tripmart.plans import monthly, warehouse
from tripmart.plans.monthly import MISMATCH, content_audit, run_months
from tripmart.plans.publish import FileOps, partitions
from tripmart.plans.warehouse import ContentMismatch, load_months, read_audit, read_staging_table
from tripmart.sources.lake import read_table


def digest(df, columns):
    return int(df.agg(digest_of(row_hash(columns)).alias("d")).first()["d"])


def test_digest_ignores_order_and_sees_values_places_and_repeats(spark):
    rows = [(1, None, "a"), (2, 3, "b"), (2, 3, "b"), (None, None, None)]
    of = lambda r: digest(spark.createDataFrame(r, "x long, y long, z string"), ["x", "y", "z"])
    whole = of(rows)
    assert of(rows[::-1]) == whole and of(rows[:2]) + of(rows[2:]) == whole
    assert of([(None, 1, "a"), *rows[1:]]) != whole  # the same value in the next column
    assert of([rows[0], *rows[2:]]) != whole and of([(1, None, "A"), *rows[1:]]) != whole
    assert of([]) == 0


@pytest.mark.parametrize("part", ["split_clean", "split_rejected"])
def test_a_month_with_one_altered_value_is_not_published(spark, lake, monkeypatch, part):
    zones = land(spark, lake)
    assert run_months(spark, lake, ["2024-01"], zones).ok
    before = {t: partitions(FileOps(spark), lake, t) for t in (lake.clean, lake.rejected)}
    real = getattr(monthly, part)
    worst = real(monthly.tag_rows(monthly.raw_month_scan(spark, lake, "2024-01"), "2024-01")).agg(F.max("trip_distance")).first()[0]
    monkeypatch.setattr(monthly, part, lambda t: real(t).withColumn(
        "trip_distance", F.when(F.col("trip_distance") == worst, worst - 0.01).otherwise(F.col("trip_distance"))))
    got = run_months(spark, lake, ["2024-01"], zones).outcomes["2024-01"]
    assert got.rows_clean + got.rows_rejected == got.rows_in == got.reasons_total  # counts alone would let it pass
    assert got.code == MISMATCH and not got.content_ok and not got.published
    assert {t: partitions(FileOps(spark), lake, t) for t in before} == before


def test_audit_finds_rows_changed_after_their_run(spark, lake):
    zones = land(spark, lake, ("2024-01", "2024-02"))
    run_months(spark, lake, ["2024-01", "2024-02"], zones)
    audit = lambda: {(r["month"], r["kind"]): (r["rows"], r["content_ok"]) for r in content_audit(spark, lake).collect()}
    before = audit()
    assert set(before) == {(m, k) for m in ("2024-01", "2024-02") for k in ("clean", "rejected")}
    assert all(ok for _, ok in before.values()) and before["2024-01", "clean"][0] == 947
    folder = partitions(FileOps(spark), lake, lake.clean)["year=2024/month=2"]
    held = spark.createDataFrame(spark.read.parquet(folder).collect(), spark.read.parquet(folder).schema)
    held.withColumn("tip_amount", F.col("tip_amount") + 1).write.mode("overwrite").parquet(folder)
    after = audit()
    assert after.pop(("2024-02", "clean")) == (before["2024-02", "clean"][0], False)
    assert all(ok for _, ok in after.values())


def test_a_load_whose_rows_change_on_the_way_is_refused_and_audited(spark, lake, monkeypatch):
    zones = land(spark, lake)
    run_months(spark, lake, ["2024-01"], zones)
    assert load_months(spark, lake, ["2024-01"])["2024-01"].status == "success"
    held = partitions(FileOps(spark), lake, lake.staging_table)
    real = warehouse._read_back

    def altered(spark, staged):
        other = lake.work("altered")
        rows = spark.read.parquet(staged)
        rows.withColumn("total_amount", (F.col("total_amount") + F.lit(0.01).cast("decimal(12,2)")).cast("decimal(12,2)")).write.parquet(other)
        return real(spark, other)

    monkeypatch.setattr(warehouse, "_read_back", altered)
    with pytest.raises(ContentMismatch):
        load_months(spark, lake, ["2024-01"], strict=True)
    assert partitions(FileOps(spark), lake, lake.staging_table) == held
    last = read_audit(spark, lake).orderBy(F.desc("load_id")).first()
    assert last["status"] == "failed" and last["error_message"].startswith("ContentMismatch")
    assert read_staging_table(spark, lake).count() == read_table(spark, lake, lake.clean).count()
