"""Seeded randomness as a hash of the row id, so results never depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(part) -> Column:
    return part.cast("string") if isinstance(part, Column) else F.lit(str(part))


def hash_hex(*parts) -> Column:
    """md5 of the parts joined by '|', as 32 hex digits; columns and plain values may be mixed."""
    return F.md5(F.concat_ws("|", *[_text(part) for part in parts]))


def hash_int(*parts, digits: int = 8) -> Column:
    """The first hex digits of hash_hex as a number: in [0, 2^32) by default, up to [0, 2^60) with 15 digits."""
    return F.conv(F.substring(hash_hex(*parts), 1, digits), 16, 10).cast("long")


def hash_uniform(*parts) -> Column:
    """A number in [0, 1)."""
    return hash_int(*parts) / F.lit(4294967296.0)
