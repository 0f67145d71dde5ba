"""File manifest, checksums, sync plan, validators, validated publish and ingestion log."""

import hashlib
import os

import pytest

from tripmart.operators.manifest import file_checksums, file_manifest, lake_listing, lake_object_count, sync_counts, sync_plan
from tripmart.plans.ingest import ingest_month, ingest_zones, publish_validated, read_ingestion_log
from tripmart.plans.publish import FileOps
from tripmart.sources import fixture
from tripmart.sources.lake import raw_folder
from tripmart.sources.reference import (
    ValidationError, read_csv_inferred, read_zone_seed, schema_rows, validate_parquet_file, validate_zones_file,
)

SF = "/root/testdata/sf0.001"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def make_tree(root):
    """raw/yellow/2025-01/a.parquet (4 bytes), a.parquet.part, raw/zones/z.csv, raw/_metadata/log.jsonl"""
    os.makedirs(f"{root}/raw/yellow/2025-01", exist_ok=True)
    os.makedirs(f"{root}/raw/zones", exist_ok=True)
    os.makedirs(f"{root}/raw/_metadata", exist_ok=True)
    open(f"{root}/raw/yellow/2025-01/a.parquet", "wb").write(b"PAR1")
    open(f"{root}/raw/yellow/2025-01/a.parquet.part", "wb").write(b"partial")
    open(f"{root}/raw/zones/z.csv", "w").write("LocationID,Borough\n1,EWR\n")
    open(f"{root}/raw/_metadata/ingestion_log.jsonl", "w").write("{}\n")


def test_manifest_keeps_only_lake_suffixes(spark, lake):
    root = _local(lake.root)
    make_tree(root)
    m = {r["key"]: r["bytes"] for r in file_manifest(spark, root + "/raw").collect()}
    assert m == {"raw/yellow/2025-01/a.parquet": 4, "raw/zones/z.csv": 25}
    assert lake_object_count(file_manifest(spark, root + "/raw")).first()["objects"] == 2
    assert [r["size_mb"] for r in lake_listing(file_manifest(spark, root + "/raw")).collect()] == [0.0, 0.0]


def test_checksums_match_hashlib(spark, lake):
    root = _local(lake.root)
    make_tree(root)
    got = {os.path.basename(r["path"]): (r["bytes"], r["sha256"]) for r in file_checksums(spark, root + "/raw").collect()}
    assert got["a.parquet"] == (4, hashlib.sha256(b"PAR1").hexdigest())


def test_large_files_are_streamed_and_other_names_left_out(spark, lake):
    root = _local(lake.root)
    make_tree(root)
    os.makedirs(f"{root}/raw/yellow/2025 02", exist_ok=True)
    open(f"{root}/raw/yellow/2025 02/b 1.parquet", "wb").write(b"x" * 5000)
    want = {"a.parquet": (4, hashlib.sha256(b"PAR1").hexdigest()), "b 1.parquet": (5000, hashlib.sha256(b"x" * 5000).hexdigest())}
    for most in (1, 100, 10**6):  # all streamed, the larger one streamed, none
        got = file_checksums(spark, root + "/raw", ("parquet",), most).collect()
        assert {os.path.basename(r["path"]).replace("%20", " "): (r["bytes"], r["sha256"]) for r in got} == want
    one = file_checksums(spark, f"{root}/raw/yellow/2025-01/a.parquet.part", None).collect()
    assert [(r["bytes"], r["sha256"]) for r in one] == [(7, hashlib.sha256(b"partial").hexdigest())]


def test_landing_of_many_files_is_one_append(spark, lake):
    landed = lake.work("landed-many")
    fixture.raw_month(spark, SF).repartition(40).write.parquet(landed)
    assert ingest_month(spark, lake, "2024-01", landed) == "published"
    log = read_ingestion_log(spark, lake)
    assert log.count() == 40 and log.select("file").distinct().count() == 40
    assert len(FileOps(spark).list_files(lake.ingestion_log, ".json")) <= 8


def test_sync_plan_is_idempotent_and_detects_size_changes(spark):
    local = spark.createDataFrame([("raw/a", "/x/a", 10), ("raw/b", "/x/b", 20), ("raw/c", "/x/c", 30)],
                                  "key string, path string, bytes bigint")
    lake = spark.createDataFrame([("raw/a", "s3/a", 10), ("raw/b", "s3/b", 21)], "key string, path string, bytes bigint")
    plan = {r["key"]: r["action"] for r in sync_plan(local, lake).collect()}
    assert plan == {"raw/a": "skip", "raw/b": "upload", "raw/c": "upload"}
    assert {r["action"]: r["files"] for r in sync_counts(sync_plan(local, lake, force=True)).collect()} == {"upload": 3}
    same = spark.createDataFrame([(k, p, b) for k, p, b in local.collect()], lake.schema)
    assert {r["action"] for r in sync_plan(local, same).collect()} == {"skip"}


def test_validators(spark, lake):
    root = _local(lake.root)
    os.makedirs(root, exist_ok=True)
    good = f"{root}/zones.csv"
    open(good, "w").write("LocationID,Borough,Zone,service_zone\n" + "".join(f"{i},B,Z{i},S\n" for i in range(1, 266)))
    assert validate_zones_file(spark, good) == 265
    short = f"{root}/short.csv"
    open(short, "w").write("LocationID,Borough\n1,B\n")
    with pytest.raises(ValidationError):
        validate_zones_file(spark, short)
    nohdr = f"{root}/nohdr.csv"
    open(nohdr, "w").write("id,Borough\n" + "".join(f"{i},B\n" for i in range(300)))
    with pytest.raises(ValidationError):
        validate_zones_file(spark, nohdr)
    bad = f"{root}/bad.parquet"
    open(bad, "wb").write(b"not parquet at all")
    with pytest.raises(ValidationError):
        validate_parquet_file(spark, bad)


def test_ingest_publishes_once_and_logs(spark, lake):
    landed = lake.work("landed")
    fixture.raw_month(spark, SF).write.parquet(landed)
    assert ingest_month(spark, lake, "2024-01", landed, "https://example.invalid/m.parquet") == "published"
    assert ingest_month(spark, lake, "2024-01", landed) == "skipped"
    assert ingest_month(spark, lake, "2024-01", landed, force=True) == "published"
    assert spark.read.parquet(raw_folder(spark, lake, "2024-01")).count() == 1000
    log = read_ingestion_log(spark, lake).collect()
    landed_files = {r["path"]: (r["bytes"], r["sha256"]) for r in file_checksums(spark, landed).collect()}
    assert all(r["rows"] == 1000 for r in log) and len(log) == 2 * len(landed_files)
    name = lambda p: p.rsplit("/", 1)[1]
    assert {(name(r["file"]), r["bytes"], r["sha256"]) for r in log} == {(name(p), *v) for p, v in landed_files.items()}


def test_failed_validation_leaves_nothing(spark, lake):
    df = fixture.raw_month(spark, SF)
    with pytest.raises(ValidationError):
        publish_validated(spark, df, lake, lake.raw_month("2024-01"), expected_rows=5)
    assert raw_folder(spark, lake, "2024-01") is None and FileOps(spark).list_dirs(lake.raw_month("2024-01")) == []


def test_ingest_zones_and_typed_seed_reads(spark, lake):
    root = _local(lake.root)
    os.makedirs(root, exist_ok=True)
    src = f"{root}/lookup.csv"
    open(src, "w").write("LocationID,Borough,Zone,service_zone\n" +
                         "".join(f"{i},B{i % 3},Z{i},N/A\n" for i in range(1, 266)))
    assert ingest_zones(spark, lake, src) == "published"
    assert read_csv_inferred(spark, lake.raw_zones).dtypes[0] == ("LocationID", "int")
    seed = read_zone_seed(spark, src)
    assert seed.filter("service_zone IS NULL").count() == 265  # N/A read as NULL
    assert schema_rows(spark, seed).count() == 4
