"""Seeded randomness that depends on the row's key alone.

The same key gets the same draw whatever the partitioning, the engine or the retry, which
``rand(seed)`` cannot promise because it numbers rows per partition.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def _as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(seed: int, stream: str, *keys: str | Column) -> Column:
    """A 60-bit non-negative integer from ``md5(seed:stream:key...)``."""
    parts = [_as_column(k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(stream), *parts))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def uniform(seed: int, stream: str, *keys: str | Column) -> Column:
    """A draw in [0, 1] from the same digest."""
    return hash_key(seed, stream, *keys).cast("double") / F.lit(float(1 << HASH_BITS))


def hash_bucket(key: str | Column, buckets: int) -> Column:
    """Equal slices of the hash range, in hash order. ``buckets`` must be a power of two."""
    if buckets < 1 or buckets & (buckets - 1):
        raise ValueError("buckets must be a power of two")
    shift = HASH_BITS - (buckets.bit_length() - 1)
    return F.shiftright(_as_column(key), shift)
