"""Month handling: text validation and half-open month bounds as columns.

Bounds are Column expressions over a ``source_month`` column, so any number of
months is tagged in one plan; with a literal month Catalyst folds them to
constants.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: month text format YYYY-MM with month 01-12.
MONTH_PATTERN = r"^\d{4}-(0[1-9]|1[0-2])$"
_MONTH_RE = re.compile(MONTH_PATTERN)


class InvalidMonth(ValueError):
    """Month text is not YYYY-MM."""


def validate_month(month: str) -> str:
    if not isinstance(month, str) or not _MONTH_RE.fullmatch(month):
        raise InvalidMonth(f"invalid month {month!r}, expected YYYY-MM")
    return month


def validate_months(months) -> list[str]:
    out = sorted({validate_month(m) for m in months})
    if not out:
        raise InvalidMonth("no months given")
    return out


def month_shift(month: str, delta: int) -> str:
    y, m = map(int, validate_month(month).split("-"))
    idx = y * 12 + (m - 1) + delta
    return f"{idx // 12:04d}-{idx % 12 + 1:02d}"


def month_range(start: str, end: str) -> list[str]:
    """All months from ``start`` to ``end`` inclusive (for backfills)."""
    a, b = validate_month(start), validate_month(end)
    if b < a:
        raise InvalidMonth(f"empty month range {a}..{b}")
    out, m = [], a
    while m <= b:
        out.append(m)
        m = month_shift(m, 1)
    return out


def valid_month_col(col: Column | str) -> Column:
    """Boolean column: the value is a YYYY-MM month."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(MONTH_PATTERN)


def _as_col(month: Column | str) -> Column:
    if isinstance(month, Column):
        return month
    return F.lit(validate_month(month))


def _first_day(month: Column | str) -> Column:
    return F.to_date(F.concat(_as_col(month), F.lit("-01")), "yyyy-MM-dd")


def month_start(month: Column | str) -> Column:
    """First instant of the month as timestamp_ntz."""
    return _first_day(month).cast("timestamp_ntz")


def month_end(month: Column | str) -> Column:
    """First instant of the next month (exclusive bound); December rolls over."""
    return F.add_months(_first_day(month), 1).cast("timestamp_ntz")


def month_bounds(month: Column | str) -> tuple[Column, Column]:
    return month_start(month), month_end(month)


def month_of_path(path_col: Column | str = "_metadata.file_path") -> Column:
    """Month folder of a raw file path ``.../<YYYY-MM>/<file>``; empty string when absent."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.regexp_extract(c, r"/(\d{4}-\d{2})/[^/]+$", 1)


def partition_filter(months, year_col: str = "year", month_col: str = "month") -> Column:
    """``(year = Y AND month = M) OR ...`` over partition columns: plain equality
    predicates that prune partition folders (and metastore partitions)."""
    cond = None
    for m in validate_months(months):
        y, mm = (int(x) for x in m.split("-"))
        c = (F.col(year_col) == y) & (F.col(month_col) == mm)
        cond = c if cond is None else cond | c
    return cond
