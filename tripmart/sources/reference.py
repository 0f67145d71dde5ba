"""Reference data: zone lookup CSV, seeds, and generated calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.contracts import NOT_AVAILABLE, PAYMENT_TYPE_CODES, ZONE_KEY_HEADER, ZONE_MIN_ROWS

ZONE_CSV_SCHEMA = T.StructType([
    T.StructField("LocationID", T.StringType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])

ZONE_SEED_SCHEMA = T.StructType([
    T.StructField("location_id", T.IntegerType()),
    T.StructField("borough", T.StringType()),
    T.StructField("zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])


class ValidationError(ValueError):
    """A landed reference or raw file is not usable."""


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup as the cleaning step reads it: header, every column a string (A2)."""
    return spark.read.csv(path, header=True, schema=ZONE_CSV_SCHEMA, enforceSchema=False)


def read_lake_zones(spark: SparkSession, lake) -> DataFrame:
    """The lake's current zone lookup."""
    from tripmart.plans.publish import FileOps, folder_of

    return read_zones_csv(spark, folder_of(FileOps(spark), lake, lake.raw_zones) or lake.raw_zones)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and type inference (A3). Inference costs an extra pass: use for exploration only."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_zone_seed(spark: SparkSession, path: str) -> DataFrame:
    """Typed zone seed with the text N/A read as NULL."""
    return spark.read.csv(path, header=True, schema=ZONE_SEED_SCHEMA, nullValue=NOT_AVAILABLE,
                          enforceSchema=False)


def payment_type_codes(spark: SparkSession) -> DataFrame:
    """The seven payment codes as a typed seed."""
    schema = "payment_type int, payment_type_name string"
    return spark.createDataFrame(PAYMENT_TYPE_CODES, schema)


def date_series(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day in [start, end] (A8), generated on executors."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 DAY"))).alias("full_date")
    )


def validate_zones_file(spark: SparkSession, path: str) -> int:
    """Header has LocationID and at least 200 data rows (K9). Returns the row count."""
    df = spark.read.csv(path, header=True)
    if ZONE_KEY_HEADER not in df.columns:
        raise ValidationError(f"zone lookup lacks the {ZONE_KEY_HEADER} column")
    rows = df.count()
    if rows < ZONE_MIN_ROWS:
        raise ValidationError(f"zone lookup holds {rows} zones, fewer than {ZONE_MIN_ROWS}")
    return rows


def validate_parquet_file(spark: SparkSession, path: str) -> int:
    """Readable parquet; returns its row count from a metadata-only scan."""
    try:
        return spark.read.parquet(path).count()
    except Exception as exc:  # noqa: BLE001 - any read failure is a validation failure
        raise ValidationError(f"parquet unreadable at {path}: {exc}") from exc


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Schema description, one row per column."""
    return spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(df.dtypes)],
                                 "position int, column_name string, column_type string")
