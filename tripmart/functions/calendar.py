"""Calendar expressions for the date dimension and star-schema keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def date_key(d: Column | str) -> Column:
    """YYYYMMDD integer surrogate key of a date."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def iso_weekday(d: Column | str) -> Column:
    """ISO day of week: Monday=1 ... Sunday=7."""
    return (F.weekday(_c(d)) + 1).cast("int")


def is_weekend(d: Column | str) -> Column:
    return iso_weekday(d).isin(6, 7)


def month_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "MMMM")


def day_name(d: Column | str) -> Column:
    return F.date_format(_c(d), "EEEE")
