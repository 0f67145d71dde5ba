"""Property test: Spark tagging equals a plain statement of the rules on random trips."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

from tripmart.operators import clean as C

SCHEMA = StructType([
    StructField("tpep_pickup_datetime", TimestampNTZType()),
    StructField("tpep_dropoff_datetime", TimestampNTZType()),
    StructField("trip_distance", DoubleType()),
    StructField("fare_amount", DoubleType()),
    StructField("PULocationID", IntegerType()),
    StructField("passenger_count", LongType()),
    StructField("source_month", StringType()),
])

stamps = st.one_of(st.none(), st.datetimes(min_value=dt.datetime(2024, 11, 20), max_value=dt.datetime(2025, 2, 10)))
numbers = st.one_of(st.none(), st.just(float("nan")), st.just(100.0), st.just(0.0),
                    st.floats(min_value=-50, max_value=300, allow_nan=False))
months = st.sampled_from(["2024-12", "2025-01", "2025-02"])
rows = st.lists(st.tuples(stamps, stamps, numbers, numbers, months), min_size=1, max_size=60)


def expected(pickup, dropoff, dist, fare, month):
    y, m = map(int, month.split("-"))
    start = dt.datetime(y, m, 1)
    end = dt.datetime(y + (m == 12), m % 12 + 1, 1)
    if pickup is None or dropoff is None:
        return "missing_timestamp"
    if dropoff < pickup:
        return "dropoff_before_pickup"
    if pickup < start or pickup >= end:
        return "pickup_outside_month"
    if dist is not None and (math.isnan(dist) or dist > 100):  # NaN sorts above every number
        return "distance_over_100_miles"
    if fare is not None and not math.isnan(fare) and fare < 0:
        return "negative_fare"
    return None


@settings(max_examples=25, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_tagging_matches_rule_statement(spark, data):
    df = spark.createDataFrame([(p, d, x, f, 1, 1, m) for p, d, x, f, m in data], SCHEMA)
    tagged = C.tag_rows(C.standardize(df, keep=("source_month",)))
    got = [r["reject_reason"] for r in tagged.collect()]
    assert got == [expected(*r) for r in data]
    clean = C.split_clean(tagged).count()
    rejected = C.split_rejected(tagged).count()
    assert clean + rejected == len(data)
