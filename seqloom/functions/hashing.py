"""Reproducible pseudo-random order from md5: the same on any cluster and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def seeded_hash(*parts: object) -> Column:
    """The first 60 bits of the md5 of the parts joined with `:`, as BIGINT.

    Sorts like the hexadecimal digest, in a quarter of its bytes. Plain values stand for
    themselves; pass columns as Column.
    """
    return F.conv(F.substring(seeded_digest(*parts), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def seeded_digest(*parts: object) -> Column:
    """The whole md5 of the parts joined with `:`, in hexadecimal."""
    columns = [part if isinstance(part, Column) else F.lit(str(part)) for part in parts]
    return F.md5(F.concat_ws(":", *[column.cast("string") for column in columns]).cast("binary"))


def leading_bits(hashed: Column) -> Column:
    """The first 32 bits of a hash."""
    return F.shiftright(hashed, HASH_BITS - 32)


def hash_bucket(hashed: Column, buckets: Column | int) -> Column:
    """Equal slices of the hash space, in its order; exact for up to 2^31 of them."""
    count = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.shiftright(leading_bits(hashed) * count.cast("bigint"), 32)


def unit_interval(hashed: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return leading_bits(hashed) / F.lit(float(1 << 32))
