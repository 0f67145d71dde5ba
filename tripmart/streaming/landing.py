"""Clean raw months as their files land (file-source stream + foreachBatch)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripmart.functions.months import month_of_path, valid_month_col
from tripmart.plans.monthly import run_months
from tripmart.sources.lake import Lake
from tripmart.sources.reference import read_lake_zones


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def landed_months(spark: SparkSession, lake: Lake) -> DataFrame:
    """Streaming DataFrame of (path, month) for every new raw parquet file.

    ``binaryFile`` has a fixed schema, so drifting month schemas do not
    matter here; only the path is selected, file bytes are never read.
    """
    files = (spark.readStream.format("binaryFile")
             .schema(BINARY_FILE_SCHEMA)
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet")
             .load(lake.raw_trips))
    return (files.select("path", month_of_path(F.col("path")).alias("month"))
            .filter(valid_month_col("month")))


def start_landing_stream(spark: SparkSession, lake: Lake, checkpoint: str | None = None,
                         available_now: bool = True, on_result=None) -> StreamingQuery:
    """Start the stream; each micro-batch re-runs ``run_months`` for its months.

    The file source's checkpoint (under the lake's shared work folder by
    default) records which files were seen, so a restart resumes; the month
    run is idempotent, so a replayed batch republishes the same result.
    """
    checkpoint = checkpoint or lake.work("landing-stream-checkpoint")

    def process(batch: DataFrame, batch_id: int) -> None:
        months = sorted(r["month"] for r in batch.select("month").distinct().collect())  # months in this batch
        if not months:
            return
        zones = read_lake_zones(spark, lake)
        result = run_months(spark, lake, months, zones)
        if on_result is not None:
            on_result(batch_id, result)

    writer = landed_months(spark, lake).writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
