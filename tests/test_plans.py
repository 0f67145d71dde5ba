"""Physical-plan checks: broadcast choice, pruning, pushdown, aggregation before joins."""

from pyspark.sql import functions as F

from tripmart import catalog
from tripmart.operators import clean as C
from tripmart.operators.joins import checked_dimension
from tripmart.sources import fixture

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_enrich_broadcasts_the_checked_zone_dimension_m3(spark):
    p = plan(catalog.Chain(spark, SF).clean)
    assert p.count("LeftOuter, BuildRight") == 2
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning" not in p


def test_oversized_dimension_is_not_broadcast(spark):
    dim = spark.range(100).withColumnRenamed("id", "k")
    hinted = checked_dimension(dim, "k", max_bytes=100)
    fact = spark.range(1000).withColumn("k", F.col("id") % 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(fact.join(hinted, "k"))
        assert "BroadcastHashJoin" in plan(fact.join(checked_dimension(dim, "k", max_bytes=10_000), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shuffle_variant_uses_sort_merge_join_d4(spark):
    p = plan(catalog.q_borough_counts_shuffle(spark, SF))
    assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
    assert "BroadcastHashJoin" in plan(catalog.q_borough_counts_raw(spark, SF))


def test_partition_filters_reach_the_scan_m4(spark, lake):
    fixture.raw_month(spark, SF).withColumn("year", F.year("tpep_pickup_datetime")) \
        .withColumn("month", F.month("tpep_pickup_datetime")).write.partitionBy("year", "month").parquet(lake.clean)
    df = spark.read.parquet(lake.clean).filter((F.col("year") == 2024) & (F.col("month") == 1))
    text = formatted(df)
    assert "PartitionFilters: [isnotnull(year" in text and "(year#" in text


def test_filters_and_columns_are_pushed_to_the_events_scan(spark):
    df = catalog.q_profile_neg_by_payment(spark, SF)
    text = formatted(df)
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text


def test_reports_aggregate_before_joining_dimensions(spark):
    p = plan(catalog.q_trips_by_borough(spark, SF))
    # partial + final aggregate on the fact key, then the (broadcast) dimension join, then re-aggregate.
    assert p.count("HashAggregate") >= 3
    assert "BroadcastHashJoin" in p


def test_tagging_has_no_shuffle(spark):
    p = plan(catalog.Chain(spark, SF).tagged)
    assert "Exchange" not in p


def test_repartition_and_coalesce_m1_m2(spark):
    df = fixture.raw_month(spark, SF)
    assert df.repartition(12).rdd.getNumPartitions() == 12
    assert df.repartition(12).coalesce(2).rdd.getNumPartitions() == 2
    assert "Exchange RoundRobinPartitioning(12)" in plan(df.repartition(12))
    assert "Coalesce 2" in plan(df.coalesce(2)) or "Exchange" not in plan(df.coalesce(2))


def test_literal_month_bounds_are_folded(spark):
    std = C.standardize(fixture.raw_month(spark, SF))
    p = C.tag_rows(std, "2024-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "add_months" not in p and "to_date" not in p


def test_hot_zone_is_split_by_adaptive_skew_join(spark):
    """One zone holds 40 % of the trips; with the shuffle join AQE splits its partition."""
    trips = spark.range(200_000).select(
        F.when(F.col("id") % 5 < 2, F.lit(7)).otherwise((F.col("id") % 997).cast("int")).alias("PULocationID"),
        F.col("id").alias("trip_id"))
    zones = spark.range(1000).select(F.col("id").cast("int").alias("LocationID"),
                                     (F.col("id") % 5).cast("string").alias("Borough"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # thresholds scaled down to this test's compressed shuffle sizes
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = (trips.join(zones.hint("merge"), trips.PULocationID == zones.LocationID)
              .groupBy("Borough").agg(F.count(F.lit(1)).alias("trips")))
        rows = {r["Borough"]: r["trips"] for r in df.collect()}
        assert sum(rows.values()) == 200_000
        final = formatted(df)  # after collect(): the final adaptive plan
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_month_rebalance_is_split_into_many_tasks(spark):
    """All rejected rows of one month: the rebalance exchange is read as skew-split partitions."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")  # scaled to the test's size
    try:
        df = spark.range(300_000).select(F.lit("2024-01").alias("source_month"), F.col("id"),
                                         (F.col("id") * 7 % 1000).alias("v"))
        r = df.hint("rebalance", "source_month")
        assert r.count() == 300_000
        r.collect()
        text = formatted(r)
        assert "AQEShuffleRead" in text and "Arguments: skewed" in text
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if old is None else \
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_a_query_builds_the_lake_as_far_as_it_reads(spark, monkeypatch):
    from tripmart import catalog

    monkeypatch.setattr(catalog, "_LAKES", {})
    done = {name: [] for name in ("load_months", "build_marts", "evaluate_months")}
    for name, calls in done.items():
        monkeypatch.setattr(catalog, name, lambda *a, calls=calls, real=getattr(catalog, name): (calls.append(1), real(*a)))
    sf = "/root/testdata/sf0.001"
    assert catalog.q_scan_raw_month(spark, sf).count() == catalog.fixture.table(spark, sf, "events").count()
    assert set(catalog.LAKE_SECONDS) == {"land_raw"}
    flags = catalog.q_clean_flag_sums(spark, sf).collect()
    assert set(catalog.LAKE_SECONDS) == {"land_raw", "clean_two_months", "clean_rerun"} and not any(done.values())
    lake = catalog.fixture_lake(spark, sf)
    assert list(catalog.LAKE_SECONDS)[-1] == "marts" and [len(c) for c in done.values()] == [2, 1, 1]
    assert catalog.q_clean_flag_sums(spark, sf).collect() == flags and catalog.fixture_lake(spark, sf).root == lake.root
    assert [len(c) for c in done.values()] == [2, 1, 1]
