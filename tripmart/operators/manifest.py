"""File manifests, checksums and the lake sync plan.

Listings come from Spark's ``binaryFile`` source with recursive lookup; the
``content`` column is never selected unless a checksum is asked for, so a
listing reads no file bytes (the source only opens files whose content is
required).
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.plans.publish import FileOps

#: Largest file whose bytes are held by one task; larger ones are streamed.
WHOLE_FILE_BYTES = 256 * 2**20

# File suffixes the lake holds.
LAKE_SUFFIXES = ("parquet", "csv")


def _files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)


def file_manifest(spark: SparkSession, root: str, prefix: str = "raw", suffixes=LAKE_SUFFIXES) -> DataFrame:
    """(key, path, bytes) of every file under ``root`` whose suffix is in ``suffixes``.

    Partial downloads (``x.parquet.part``) and metadata files (``.jsonl``) have
    another suffix and drop out; names starting with ``_`` or ``.`` are hidden
    from Spark listings. ``key`` = ``prefix/`` + path relative to ``root``.
    """
    base = root.rstrip("/")
    rel = F.regexp_extract(F.col("path"), r"^.*?" + _tail_pattern(base) + r"/(.*)$", 1)
    pattern = r"\.(" + "|".join(suffixes) + r")$"
    return (_files(spark, root).select("path", "length")
            .filter(F.col("path").rlike(pattern))
            .select(F.concat(F.lit(prefix + "/"), rel).alias("key"), "path", F.col("length").alias("bytes")))


def _tail_pattern(base: str) -> str:
    # Match the root by its last two path components so file:/ vs plain paths agree.
    import re
    parts = [p for p in base.split("/") if p][-2:]
    return "/".join(re.escape(p) for p in parts)


def lake_listing(manifest: DataFrame) -> DataFrame:
    """Size in MB per key, ordered by key."""
    return manifest.select("key", F.round(F.col("bytes") / F.lit(1048576.0), 1).alias("size_mb")).orderBy("key")


def lake_object_count(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count(F.lit(1)).alias("objects"))


def file_checksums(spark: SparkSession, root: str, suffixes=LAKE_SUFFIXES, most: int = WHOLE_FILE_BYTES) -> DataFrame:
    """(path, bytes, sha256) of every file under ``root`` (a folder or one file), hashed by the tasks that read them (I16).

    A task hashes its files one by one: a file is one row with its bytes meanwhile, so only files of at
    most ``most`` bytes go that way. Larger ones, if any, are streamed one after another
    (``FileOps.size_and_sha256``), in constant memory. ``suffixes`` None takes files of any name.
    """
    glob = "*" if suffixes is None else "*.{" + ",".join(suffixes) + "}"  # other files are not even listed, so never read
    named = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    large = [r["path"] for r in named.filter(F.col("length") > most).select("path").collect()]
    hashed = named.filter(F.col("length") <= most).select(
        "path", F.col("length").alias("bytes"), F.sha2(F.col("content"), 256).alias("sha256"))
    if not large:
        return hashed
    ops = FileOps(spark)
    return hashed.unionByName(spark.createDataFrame([(p, *ops.size_and_sha256(_decoded(p))) for p in large],
                                                    "path string, bytes bigint, sha256 string"))


def _decoded(path: str) -> str:
    """The ``path`` column is a URI with its escapes; file calls take it without."""
    return unquote(path)


def sync_plan(local: DataFrame, lake: DataFrame, force: bool = False) -> DataFrame:
    """Upload when the key is absent from the lake or its size differs (or force); else skip."""
    remote = lake.select("key", F.col("bytes").alias("lake_bytes"))
    joined = local.join(remote, "key", "left")
    upload = F.lit(True) if force else (F.col("lake_bytes").isNull() | (F.col("lake_bytes") != F.col("bytes")))
    return joined.select("key", "path", "bytes", "lake_bytes",
                         F.when(upload, F.lit("upload")).otherwise(F.lit("skip")).alias("action"))


def sync_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("files"))
