"""Dimension-join helpers: broadcast only behind a measured size and a unique key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension is broadcast only when its measured size is within this budget
# (zone, payment and calendar dimensions are a few KB). Above it, the join is
# left to Spark's shuffle join, where AQE can still convert or split it at
# runtime from real statistics.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
                T.LongType: 8, T.DoubleType: 8, T.FloatType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
                T.DecimalType: 16}


class DuplicateKey(ValueError):
    """A dimension key is not unique, so a join would multiply fact rows."""


def _size_exprs(dim: DataFrame):
    fixed = sum(_FIXED_WIDTH.get(type(f.dataType), 0) for f in dim.schema.fields)
    var = [F.coalesce(F.length(F.col(f"`{f.name}`")), F.lit(0)) for f in dim.schema.fields
           if type(f.dataType) not in _FIXED_WIDTH]
    var_sum = F.sum(sum(var[1:], var[0])) if var else F.lit(0)
    return F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) * fixed + F.coalesce(var_sum, F.lit(0))).alias("bytes")


def dimension_stats(dim: DataFrame, key: str) -> tuple[int, int, int]:
    """(rows, distinct non-null keys, estimated bytes) in one aggregation over the dimension."""
    n, size = _size_exprs(dim)
    row = dim.agg(n, F.count_distinct(F.col(key)).alias("k"), size).first()
    return int(row["n"]), int(row["k"]), int(row["bytes"])


def checked_dimension(dim: DataFrame, key: str, max_bytes: int = BROADCAST_MAX_BYTES,
                      require_unique: bool = True) -> DataFrame:
    """Return ``dim`` hinted for broadcast if its measured size is within ``max_bytes``.

    Also guards against fan-out: a duplicated (or NULL) key would multiply or
    hide fact rows, so it raises :class:`DuplicateKey` first.
    """
    rows, keys, size = dimension_stats(dim, key)
    if require_unique and rows != keys:
        raise DuplicateKey(f"dimension key {key!r} is not unique and non-null: {rows} rows, {keys} distinct keys")
    return F.broadcast(dim) if size <= max_bytes else dim


def sized_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint behind a measured-size check, without a key check."""
    n, size = _size_exprs(dim)
    measured = dim.agg(n, size).first()["bytes"]
    return F.broadcast(dim) if int(measured or 0) <= max_bytes else dim
