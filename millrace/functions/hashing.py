"""Repeatable pseudo-random numbers from keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def key_bucket(key: Column, buckets: int, salt: str = "", portable: bool = False) -> Column:
    """Number in ``0 .. buckets-1`` that depends on the key alone, not on the partitioning.

    ``portable`` uses MD5, which any other engine can recompute; the default is the cheaper
    ``xxhash64``.
    """
    if portable:
        digest = F.md5(F.concat(key.cast("string"), F.lit(salt)).cast("binary"))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(buckets))
