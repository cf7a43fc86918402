"""Deterministic draws keyed by a row's identity.

A draw depends only on its key, never on partitioning or task order, so a job that is retried
after an executor loss draws the same values again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 48
HASH_RANGE = 1 << HASH_BITS


def _as_column(part: Column | str | int) -> Column:
    return part if isinstance(part, Column) else F.lit(str(part))


def h48(*parts: Column | str | int) -> Column:
    """A uniform integer in [0, 2^48): the first twelve hex digits of the md5 of ``a:b:c``."""
    key = F.concat_ws(":", *[_as_column(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("bigint")


def leading_bits(hashed: Column, bits: int) -> Column:
    """The top ``bits`` bits of a 48-bit draw: equal-sized buckets in the draw's own order."""
    return F.shiftright(hashed, HASH_BITS - bits)
