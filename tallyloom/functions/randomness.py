"""Reproducible randomness: everything random is a hash of a seed and a row's own id.

The same row gets the same draw on any cluster, after any retry, and in any SQL
engine that has ``md5``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(seed: int | str, *ids: Column) -> Column:
    """Hex digest that orders rows at random; parts are joined by ``:``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in ids]))


def leading_bits(digest: Column, hex_digits: int) -> Column:
    """The first hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def uniform(seed: int | str, *ids: Column) -> Column:
    """A number in [0, 1) with 32 random bits."""
    return leading_bits(seeded_hash(seed, *ids), 8) / F.lit(4294967296.0)
