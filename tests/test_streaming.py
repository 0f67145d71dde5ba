"""Months are cleaned as their raw files land, once per new file set."""

from tripmart.sources import fixture
from tripmart.sources.lake import read_table
from tripmart.streaming import start_landing_stream

SF = "/root/testdata/sf0.001"


def test_months_are_cleaned_as_they_land(spark, lake):
    fixture.zones(spark, SF).coalesce(1).write.option("header", True).csv(lake.raw_zones)
    fixture.raw_month(spark, SF, "2024-01").write.parquet(lake.raw_month("2024-01"))
    seen = []
    q = start_landing_stream(spark, lake, on_result=lambda b, r: seen.append(sorted(r.outcomes)))
    q.awaitTermination(300)
    assert seen == [["2024-01"]]
    assert read_table(spark, lake, lake.clean).count() == 947

    fixture.raw_month_drifted(spark, SF, "2024-02").write.parquet(lake.raw_month("2024-02"))
    q = start_landing_stream(spark, lake, on_result=lambda b, r: seen.append(sorted(r.outcomes)))
    q.awaitTermination(300)
    assert seen[1:] == [["2024-02"]]  # the first month is not processed again
    assert {(r["year"], r["month"]) for r in read_table(spark, lake, lake.clean).select("year", "month").distinct().collect()} \
        == {(2024, 1), (2024, 2)}
