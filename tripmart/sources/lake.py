"""Lake layout and scans of raw and processed data.

Layout under one root (any Hadoop path: file:/, hdfs://, s3a://)::

    raw/yellow/<YYYY-MM>/*.parquet            raw months, schema drifts between months
    raw/zones/*.csv                           zone lookup
    processed/yellow_trips/version=V/year=Y/month=M/    clean trips
    processed/rejected_trips/version=V/source_month=M/  rejected + quarantined trips
    processed/_run_summaries/month=M/         run summaries (JSON, one folder per month)
    processed/_gate_reports/month=M/          gate reports (JSON, one folder per month)
    processed/_runs/clean_<M>.json            earlier one-document-per-month summaries (read only)
    processed/_quality/quality_<M>.json       earlier one-document-per-month gate reports (read only)
    warehouse/staging/yellow_trips/version=V/year=Y/month=M/
    warehouse/audit/load_history/
    warehouse/marts/<model>/version=V/
    _current/<number>.json                    which version of every partition is current (``plans/publish.py``)
    _writers/<number>.json                    leases of the lake's writers

Partition folders without ``version=`` (an earlier lake) are read where no map names a newer one; raw months
that are put in place by hand stay plain.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.months import validate_months


@dataclass(frozen=True)
class Lake:
    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw_trips(self) -> str:
        return self._p("raw", "yellow")

    def raw_month(self, month: str) -> str:
        return self._p("raw", "yellow", month)

    @property
    def raw_zones(self) -> str:
        return self._p("raw", "zones")

    @property
    def clean(self) -> str:
        return self._p("processed", "yellow_trips")

    @property
    def rejected(self) -> str:
        return self._p("processed", "rejected_trips")

    @property
    def runs(self) -> str:
        return self._p("processed", "_run_summaries")

    @property
    def quality(self) -> str:
        return self._p("processed", "_gate_reports")

    @property
    def legacy_runs(self) -> str:
        """Folder of one-document-per-month run summaries (``clean_<month>.json``)."""
        return self._p("processed", "_runs")

    @property
    def legacy_quality(self) -> str:
        """Folder of one-document-per-month gate reports (``quality_<month>.json``)."""
        return self._p("processed", "_quality")

    @property
    def ingestion_log(self) -> str:
        return self._p("raw", "_metadata", "ingestion_log")

    @property
    def staging_table(self) -> str:
        return self._p("warehouse", "staging", "yellow_trips")

    @property
    def audit_table(self) -> str:
        return self._p("warehouse", "audit", "load_history")

    def mart(self, name: str) -> str:
        return self._p("warehouse", "marts", name)

    def work(self, name: str) -> str:
        return self._p("_work", name)

    @property
    def maps(self) -> str:
        """Numbered maps of current folders (see ``plans/publish.py``)."""
        return self._p("_current")

    @property
    def leases(self) -> str:
        """Numbered records of the writers of this lake."""
        return self._p("_writers")

    def versioned_tables(self, ops) -> list[str]:
        """Every folder that may hold ``version=`` folders."""
        marts = self._p("warehouse", "marts")
        return [self.clean, self.rejected, self.staging_table, self.raw_zones, *(f"{marts}/{n}" for n in ops.list_dirs(marts)),
                *(self.raw_month(m) for m in ops.list_dirs(self.raw_trips))]


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Plain parquet scan (A1): schema from footers, nothing read until an action."""
    return spark.read.parquet(path)


def schema_groups(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """Files grouped by their footer schema, in order of first appearance.

    One footer is read per file (a few at a time); a folder of one file reads none twice.
    """
    if len(files) <= 1:
        return [files] if files else []
    with ThreadPoolExecutor(8) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(f).schema.simpleString(), files))
    groups: dict[str, list[str]] = {}
    for f, schema in zip(files, schemas):
        groups.setdefault(schema, []).append(f)
    return list(groups.values())


def raw_month_scan(spark: SparkSession, lake: Lake, month: str) -> DataFrame:
    """One raw month folder, standardized, with a literal ``source_month``.

    Each month is its own scan: column names, case and integer widths drift between
    months and may drift between the files of one month, so files are grouped by
    footer schema, each group is standardized by itself and the groups are
    united. The month is a constant, so rules that depend on it fold to literals per
    scan instead of being recomputed for every row.
    """
    from tripmart.operators.clean import standardize  # local import: operators depend on sources
    from tripmart.plans.publish import FileOps

    folder = raw_folder(spark, lake, month) or lake.raw_month(month)
    groups = schema_groups(spark, FileOps(spark).list_files(folder, ".parquet")) or [[folder]]
    return union_by_name(
        standardize(spark.read.parquet(*group).withColumn("source_month", F.lit(month)), keep=("source_month",))
        for group in groups)


def raw_folder(spark: SparkSession, lake: Lake, month: str) -> str | None:
    """The current folder of a raw month: a published version, or what was put in place by hand."""
    from tripmart.plans.publish import FileOps, folder_of

    return folder_of(FileOps(spark), lake, lake.raw_month(month))


def raw_row_counts(spark: SparkSession, lake: Lake, months) -> DataFrame:
    """(source_month, rows_in) of raw months from the files alone: no column is read, whatever their schemas."""
    parts = [spark.read.schema("`_none` string").option("pathGlobFilter", "*.parquet").parquet(raw_folder(spark, lake, m))
             .select(F.lit(m).alias("source_month")) for m in months]
    return union_by_name(parts).groupBy("source_month").agg(F.count(F.lit(1)).alias("rows_in"))


def union_by_name(parts) -> DataFrame:
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_raw_months(spark: SparkSession, lake: Lake, months) -> DataFrame:
    """Raw trips of many months in one DataFrame with a ``source_month`` column
    (a union of per-month standardized scans, see :func:`raw_month_scan`)."""
    return union_by_name(raw_month_scan(spark, lake, m) for m in validate_months(months))


def read_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """Hive-partitioned parquet table; filters on partition columns prune folders (A4)."""
    return spark.read.parquet(root)


def read_table(spark: SparkSession, lake: Lake, table: str, parts=None) -> DataFrame:
    """The current version of a lake table (``lake.clean``, ``lake.mart(...)``, ...): all of one commit, whatever is written meanwhile.

    Folders come from one map; filters on partition columns prune them (A4). ``parts`` reads only those
    partitions. A partition of another schema than the first keeps to the first's columns, as in any Parquet table.
    """
    from tripmart.plans.publish import FileOps, partitions

    found = partitions(FileOps(spark), lake, table)
    if not found:
        if FileOps(spark).has_files(table, ".parquet"):
            return spark.read.parquet(table)  # written without versions or partitions
        raise FileNotFoundError(f"no table at {table}")
    wanted = [found[p] for p in (found if parts is None else parts) if p in found]
    if not wanted:
        return read_table(spark, lake, table).limit(0)
    versioned = [f for f in wanted if "/version=" in f]
    plain = [f for f in wanted if "/version=" not in f]
    scan = spark.read.option("basePath", table)
    scans = ([scan.parquet(*versioned).drop("version")] if versioned else []) + ([scan.parquet(*plain)] if plain else [])
    return union_by_name(scans)


def read_month_partition(spark: SparkSession, lake: Lake, table: str, year: int, month: int) -> DataFrame:
    """Only one (year, month) partition of a lake table, partition columns kept (A5).

    Reads that partition's folder alone; a month that the table does not hold yields an empty
    DataFrame with the table's schema.
    """
    return read_table(spark, lake, table, [f"year={year}/month={month}"])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


SUMMARY_DOC_SCHEMA = ("month string, rows_in bigint, rows_clean bigint, rows_rejected_or_quarantined bigint, "
                      "counts_by_reason map<string,bigint>, finished_at_utc string, duration_seconds double")
GATE_DOC_SCHEMA = ("month string, status string, "
                   "checks array<struct<name:string,passed:boolean,value:double,threshold:string>>, "
                   "evaluated_at_utc string")


def read_json_documents(spark: SparkSession, folder: str, prefix: str, schema: str) -> DataFrame:
    """One multi-line JSON document per file, ``<prefix><YYYY-MM>.json``; the
    month is taken from the file name (A6). Files of other names are ignored."""
    df = (spark.read.schema(schema).option("multiLine", True)
          .option("pathGlobFilter", f"{prefix}*.json").json(folder))
    from_name = F.regexp_extract(F.col("_metadata.file_name"), prefix + r"(\d{4}-\d{2})\.json$", 1)
    return df.withColumn("month", F.coalesce(F.nullif(from_name, F.lit("")), F.col("month")))


def read_summary_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Run summaries kept as ``clean_<month>.json`` documents."""
    return read_json_documents(spark, folder, "clean_", SUMMARY_DOC_SCHEMA)


def read_gate_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Gate reports kept as ``quality_<month>.json`` documents."""
    return read_json_documents(spark, folder, "quality_", GATE_DOC_SCHEMA)
