"""Order-free digests of a table's content: what was written can be held against what is read back.

The digest of a set of rows is the exact sum of their 64-bit hashes, so it needs no sort and no shuffle of rows,
partial sums add up over tasks, and repeated rows count as often as they occur. NULLs are hashed by their place:
a value that moved to a neighbouring column changes the hash.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(columns: Iterable[str]) -> Column:
    """64-bit hash of a row's values and of which of them are NULL."""
    cols = [F.col(c) for c in columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def digest_of(hashes: Column) -> Column:
    """Sum of row hashes (0 for no rows); exact up to some 10^11 rows a group."""
    return F.coalesce(F.sum(hashes.cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
