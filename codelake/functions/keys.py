"""Seeded draws that give the same numbers in every engine.

``rand`` and ``xxhash64`` cannot be replayed elsewhere, so every sample, split,
shuffle and mask is ordered by the first 60 bits of an MD5 digest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_BITS = 60
BUCKET_BITS = 10


def draw_digest(seed, *parts) -> Column:
    """The digest all draws for (seed, parts) are taken from."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(p) if isinstance(p, str) else p for p in parts]))


def _hex_to_long(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def draw_key(seed, *parts) -> Column:
    """A 60-bit uniform integer for (seed, parts)."""
    return _hex_to_long(F.substring(draw_digest(seed, *parts), 1, KEY_BITS // 4))


def draw_bucket(key: Column) -> Column:
    """Leading bits of a draw key: equal-sized buckets that keep the key's order."""
    return F.shiftright(key, KEY_BITS - BUCKET_BITS).cast("int")


def draw_word(digest: Column, place: int) -> Column:
    """One of three independent 32-bit draws (place 0, 1, 2) of a digest."""
    return _hex_to_long(F.substring(digest, 8 * place + 1, 8))
