"""Data tests over the warehouse tables.

The fact-level tests (4 not_null, 4 relationships, 3 singular, row count)
run in ONE scan of the fact: the three small dimensions contribute only
their distinct keys, broadcast behind a size check, and every test is a
``count_if`` of the same aggregation. Results are long rows
(test_name, failures, passed) as a test runner reports them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators.joins import sized_broadcast

RELATIONSHIPS = [
    # child column, parent dimension name, parent key
    ("pickup_date_key", "dim_date", "date_key"),
    ("pickup_zone_key", "dim_zone", "zone_key"),
    ("dropoff_zone_key", "dim_zone", "zone_key"),
    ("payment_type_key", "dim_payment_type", "payment_type_key"),
]
def singular_tests() -> list[tuple[str, F.Column]]:
    """Singular tests: each predicate selects failing fact rows (K4)."""
    return [
        ("fact_distance_within_limit", F.col("trip_distance") > 100),
        ("fact_dropoff_not_before_pickup", F.col("dropoff_datetime") < F.col("pickup_datetime")),
        ("fact_no_negative_fare", F.col("fare_amount") < 0),
    ]
DIM_KEYS = [("dim_zone", "zone_key"), ("dim_payment_type", "payment_type_key"),
            ("dim_date", "date_key"), ("dim_date", "full_date")]
STAGING_NOT_NULL = ["pickup_datetime", "dropoff_datetime"]


def relationship_failures(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Child keys (non-NULL) with no parent row, with their row counts."""
    keys = sized_broadcast(parent.select(F.col(parent_col).alias(child_col)).distinct())
    return (child.filter(F.col(child_col).isNotNull()).join(keys, child_col, "left_anti")
            .groupBy(child_col).agg(F.count(F.lit(1)).alias("failing_rows")).orderBy(child_col))


def rowcount_matches(staging_like: DataFrame, fact: DataFrame) -> DataFrame:
    """Both counts side by side and whether they match (K5, D9: cross join of two 1-row aggregates)."""
    s = staging_like.agg(F.count(F.lit(1)).alias("staging_rows"))
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    return s.crossJoin(f).withColumn("matches", F.col("staging_rows") == F.col("fact_rows"))


def _row_tests(staging: DataFrame, fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Every test over staging and fact rows: one aggregate of each, side by side."""
    keys: dict[tuple[str, str], DataFrame] = {}
    joined, checks = fact, []
    for i, (child, dim, key) in enumerate(RELATIONSHIPS):
        flag = f"_has_parent_{i}"
        if (dim, key) not in keys:  # each dimension is measured once
            keys[dim, key] = sized_broadcast(dims[dim].select(F.col(key).alias("_key")).distinct())
        parent = keys[dim, key].select(F.col("_key").alias(f"_k{i}"), F.lit(True).alias(flag))
        joined = joined.join(parent, F.col(child) == F.col(f"_k{i}"), "left")
        checks.append((f"relationships:fact_trips.{child}->{dim}.{key}", F.col(child).isNotNull() & F.col(flag).isNull()))
    nn = [(f"not_null:fact_trips.{c}", F.col(c).isNull()) for c, _, _ in RELATIONSHIPS]
    tests = nn + checks + singular_tests()
    of_fact = joined.agg(F.count(F.lit(1)).alias("_fact_rows"), *[F.count_if(p).alias(f"_t{i}") for i, (_, p) in enumerate(tests)])
    of_staging = staging.agg(F.count(F.lit(1)).alias("_stg_rows"),
                             *[F.count_if(F.col(c).isNull()).alias(f"_s{i}") for i, c in enumerate(STAGING_NOT_NULL)])
    result = lambda name, failures: F.struct(F.lit(name).alias("test_name"), failures.cast("bigint").alias("failures"))
    rows = [result(f"not_null:staging.yellow_trips.{c}", F.col(f"_s{i}")) for i, c in enumerate(STAGING_NOT_NULL)]
    rows += [result(name, F.col(f"_t{i}")) for i, (name, _) in enumerate(tests)]
    rows.append(result("fact_row_count_matches_staging", (F.col("_fact_rows") != F.col("_stg_rows"))))
    return of_fact.crossJoin(of_staging).select(F.inline(F.array(*rows)))  # 1-row x 1-row


def _dim_tests(name: str, dim: DataFrame, key: str) -> DataFrame:
    """NULL and duplicate keys of a dimension in one pass."""
    per_key = dim.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    found = per_key.agg(F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("nulls"),
                        F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("dups"))
    return found.select(F.inline(F.array(
        F.struct(F.lit(f"not_null:{name}.{key}").alias("test_name"), F.col("nulls").cast("bigint").alias("failures")),
        F.struct(F.lit(f"unique:{name}.{key}").alias("test_name"), F.col("dups").cast("bigint").alias("failures")),
    )))


def dq_summary(staging: DataFrame, fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Every data test in one report: test_name, failures, passed.

    The staging view has the rows of the staging table, so the row-count test
    shares the one staging pass with the NOT NULL tests.
    """
    out = _row_tests(staging, fact, dims)
    for name, key in DIM_KEYS:
        out = out.unionByName(_dim_tests(name, dims[name], key))
    return out.withColumn("passed", F.col("failures") == 0)
