import pytest
from pyspark.sql import functions as F

from tripmart.functions.months import (
    InvalidMonth, month_bounds, month_of_path, month_shift, valid_month_col, validate_month, validate_months,
)


@pytest.mark.parametrize("m", ["2025-01", "1999-12", "2024-10"])
def test_valid_months(m):
    assert validate_month(m) == m


@pytest.mark.parametrize("m", ["2025-13", "2025-00", "2025-1", "25-01", "2025/01", "", None, "2025-01-01"])
def test_invalid_months(m):
    with pytest.raises(InvalidMonth):
        validate_month(m)


def test_validate_months_sorts_and_dedups():
    assert validate_months(["2025-02", "2025-01", "2025-02"]) == ["2025-01", "2025-02"]


def test_month_shift_rolls_over_years():
    assert month_shift("2024-12", 1) == "2025-01"
    assert month_shift("2025-01", -1) == "2024-12"


def test_bounds_as_columns_with_december_rollover(spark):
    df = spark.createDataFrame([("2024-12",), ("2025-01",), ("2024-02",)], "m string")
    start, end = month_bounds(F.col("m"))
    got = {r["m"]: (str(r["s"]), str(r["e"])) for r in df.select("m", start.alias("s"), end.alias("e")).collect()}
    assert got["2024-12"] == ("2024-12-01 00:00:00", "2025-01-01 00:00:00")
    assert got["2024-02"] == ("2024-02-01 00:00:00", "2024-03-01 00:00:00")
    assert dict(df.select(start.alias("s")).dtypes)["s"] == "timestamp_ntz"


def test_month_text_check_as_column(spark):
    df = spark.createDataFrame([("2025-01",), ("2025-13",), ("x",)], "m string")
    assert [r["ok"] for r in df.select(valid_month_col("m").alias("ok")).collect()] == [True, False, False]


def test_month_of_path(spark):
    df = spark.createDataFrame([("s3a://b/raw/yellow/2025-01/a.parquet",), ("/x/y.parquet",)], "p string")
    assert [r[0] for r in df.select(month_of_path("p")).collect()] == ["2025-01", ""]


def test_month_range_for_backfills():
    from tripmart.functions.months import month_range
    assert month_range("2024-11", "2025-02") == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert month_range("2025-01", "2025-01") == ["2025-01"]
    with pytest.raises(InvalidMonth):
        month_range("2025-02", "2025-01")
