"""Column-expression helpers (all JVM-side built-ins, no UDFs)."""

from tripmart.functions.calendar import date_key, iso_weekday, is_weekend, month_name, day_name
from tripmart.functions.months import (
    InvalidMonth, month_bounds, month_end, month_start, month_of_path, valid_month_col, validate_month,
    validate_months, month_shift, partition_filter, month_range,
)
from tripmart.functions.money import to_money, money_sum

__all__ = [
    "date_key", "iso_weekday", "is_weekend", "month_name", "day_name",
    "InvalidMonth", "month_bounds", "month_end", "month_start", "month_of_path", "valid_month_col",
    "validate_month", "validate_months", "month_shift", "partition_filter", "month_range", "to_money", "money_sum",
]
