"""Money coercion used at the warehouse boundary."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.contracts import MONEY


def to_money(c: Column | str) -> Column:
    """double -> decimal(12,2). ANSI mode raises on overflow instead of nulling."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(MONEY)


def money_sum(c: Column | str, scale: int = 2) -> Column:
    """Exact decimal sum reported as a double rounded to cents (engine-neutral)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(F.sum(col).cast("double"), scale)
