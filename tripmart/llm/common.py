"""Helpers shared by the text operators: tables, slices of texts, ordered buckets, components."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.session import shared_dir

#: Stands for a null doc_id inside jobs, so that such rows sort after all others.
NULL_ID = 2**63 - 1
#: Code points handled at once inside a task (a single longer text is handled alone).
SLICE_CHARS = 1_000_000


_shipped: set[str] = set()
#: Rows and bytes that go to a Python worker at once: whole texts are long, and a worker holds a batch several times.
BATCH_ROWS, BATCH_BYTES = 2_000, 4 * 2**20


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors (once a Spark application), so that Python
    workers can import them wherever they run, and keep the session's Arrow batches small."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tripmart-py-"), "tripmart_py.zip")  # read by the driver only
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


@functools.cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library: nothing to give back by hand
        return lambda _: 0


def release() -> None:
    """Give the memory of the last batch back to the system (workers live on between tasks)."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def freed(batches: Iterator) -> Iterator:
    """The batches of a Python worker; what one took is given back before the next."""
    for batch in batches:
        yield batch
        del batch
        release()


def trimmed(run):
    """``run`` (batches in, batches out) as a function that gives back all its memory at the end of a task: inside it, the last batch
    and what was made of it are still held when ``freed`` looks for more, and an idle worker would keep them."""
    @functools.wraps(run)
    def whole(batches):
        yield from run(batches)
        release()

    return whole


def inner_id(column):
    """doc_id as a long without nulls (pandas would turn a column with nulls into doubles)."""
    return F.coalesce(column.cast("long"), F.lit(NULL_ID))


def outer_id(column):
    """doc_id as it was."""
    return F.nullif(column, F.lit(NULL_ID))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and a lost
    executor costs only the tasks that were running."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(texts: Sequence[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) runs of at most ``limit`` code points; a null text is empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text if isinstance(text, str) else ""
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield first, held


def ordered_buckets(df: DataFrame, column: str, rows_per_bucket: int, least: int = 1, most: int = 4096) -> list[int]:
    """Upper bounds that cut ``column`` (long) into ranges of about equal row counts.

    Only the column is read; the result holds at most ``most`` numbers whatever the
    input. A range is a pure function of the value, so that a task that is run again
    sees the same rows (range partitioning by sampling would not promise that).
    """
    n = df.select(column).count()
    k = max(least, min(most, -(-n // max(rows_per_bucket, 1))))
    if n == 0 or k <= 1:
        return []
    cuts = [i / k for i in range(1, k)]
    got = df.select(F.percentile_approx(column, F.lit(cuts), F.lit(max(10_000, 20 * k))).alias("q")).first()["q"]
    return sorted(set(got or []))


def bucket_of(column, bounds: list[int]):
    """0-based index of the range of ``ordered_buckets`` that holds the value."""
    cuts = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def find(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, values.to_numpy(np.int64), side="left").astype(np.int32))

    return find(column)


def components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): (id, root), root = the smallest id.

    Every round rewrites the edges twice: each node's larger neighbours hang on its
    smallest neighbour, then its smaller neighbours do (alternating stars). Edges never
    grow in number, only small aggregates meet per node, and each round is written
    to the shared folder. Isolated nodes are not listed. An empty input gives no rows.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .filter("a <> b").distinct(), label)
    for _ in range(max_rounds):
        if now.isEmpty():
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                             F.col("m").alias("b")).filter("a <> b").distinct())
        then = stored(small, label)
        sums = [t.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
                for t in (now, then)]
        now = then
        if sums[0] == sums[1]:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = now.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("root"))).distinct()
