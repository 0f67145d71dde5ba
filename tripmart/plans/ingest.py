"""Validated publish of landed files into the raw zone, with an ingestion log.

A landed month (any readable parquet) is copied by Spark into
``raw/yellow/<month>/version=<run>/``: validate, write, verify the row count, then
make it current. On failure the old month stays and nothing is left behind; an
existing month is skipped unless ``force``. The log
holds size and SHA-256 of the landed file itself, to compare with its source.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.months import validate_month
from tripmart.operators.manifest import file_checksums
from tripmart.plans.publish import FileOps, commit, folder_of, new_version, writing
from tripmart.sources.lake import Lake
from tripmart.sources.reference import ValidationError, validate_parquet_file, validate_zones_file

INGESTION_LOG_SCHEMA = ("dataset string, source_url string, file string, bytes bigint, sha256 string, rows bigint, "
                        "downloaded_at_utc string, duration_seconds double")


def publish_validated(spark: SparkSession, df: DataFrame, lake: Lake, dest: str, expected_rows: int | None = None,
                      force: bool = False, fmt: str = "parquet") -> str:
    """Make ``df`` the current version of the folder ``dest`` once its rows are counted. Returns 'skipped' or 'published'."""
    with writing(spark, lake) as lease:
        if folder_of(lease.ops, lake, dest) is not None and not force:
            return "skipped"
        new = f"{dest}/{new_version()}"
        try:
            (df.write.option("header", True).csv(new) if fmt == "csv" else df.write.parquet(new))
            got = (spark.read.option("header", True).csv(new).count() if fmt == "csv" else spark.read.parquet(new).count())
            if expected_rows is not None and got != expected_rows:
                raise ValidationError(f"wrote {got} rows, expected {expected_rows}")
            commit(lease, {(dest, ""): new})
        except Exception:
            lease.ops.delete(new)
            raise
    return "published"


def ingest_month(spark: SparkSession, lake: Lake, month: str, landed_path: str, source_url: str = "",
                 force: bool = False) -> str:
    """Validate a landed month (a file or a folder of files) and publish it as ``raw/yellow/<month>/`` (B12, K10), logging it."""
    validate_month(month)
    started = time.time()
    rows = validate_parquet_file(spark, landed_path)
    outcome = publish_validated(spark, spark.read.parquet(landed_path), lake, lake.raw_month(month), rows, force)
    if outcome == "published":
        log_landed(spark, lake, f"yellow_trips_{month}", source_url, landed_path, ".parquet", rows, round(time.time() - started, 1))
    return outcome


def ingest_zones(spark: SparkSession, lake: Lake, landed_csv: str, source_url: str = "", force: bool = False) -> str:
    """Validate the zone lookup (header, >= 200 rows; K9) and publish it to ``raw/zones``."""
    started = time.time()
    rows = validate_zones_file(spark, landed_csv)
    df = spark.read.option("header", True).csv(landed_csv)
    outcome = publish_validated(spark, df.coalesce(1), lake, lake.raw_zones, rows, force, fmt="csv")
    if outcome == "published":
        log_landed(spark, lake, "zone_lookup", source_url, landed_csv, ".csv", rows, round(time.time() - started, 1))
    return outcome


def log_landed(spark: SparkSession, lake: Lake, dataset: str, source_url: str, landed: str, suffix: str, rows: int,
               duration: float) -> None:
    """One record per landed file: its name, size and SHA-256; rows are those of the whole landing.

    Files are hashed by Spark's tasks and the records of a landing are one append of bounded files, whatever their number.
    """
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
    suffixes = (suffix.lstrip("."),) if FileOps(spark).has_files(landed, suffix) else None  # a single file may have any name
    (file_checksums(spark, landed, suffixes).select(
        F.lit(dataset).alias("dataset"), F.lit(source_url).alias("source_url"), F.col("path").alias("file"), "bytes", "sha256",
        F.lit(rows).cast("bigint").alias("rows"), F.lit(now).alias("downloaded_at_utc"), F.lit(duration).cast("double").alias("duration_seconds"))
     .hint("rebalance").write.mode("append").json(lake.ingestion_log))


def append_ingestion_log(spark: SparkSession, lake: Lake, dataset: str, source_url: str, file: str, size: int,
                         sha256: str, rows: int, duration: float) -> None:
    """Append one JSON record."""
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="seconds")
    rec = [(dataset, source_url, file, size, sha256, rows, now, duration)]
    spark.createDataFrame(rec, INGESTION_LOG_SCHEMA).coalesce(1).write.mode("append").json(lake.ingestion_log)


def read_ingestion_log(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.read.schema(INGESTION_LOG_SCHEMA).json(lake.ingestion_log)
