"""Polynomial string hash used by the bitmap distinct count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hash base and bitmap width (2^28 positions = 32 MB of bits).
HASH_BASE = 61
BITMAP_BITS = 28


def bitmap_position(value: Column | str, base: int = HASH_BASE, bits: int = BITMAP_BITS) -> Column:
    """Position of a value in a bitmap of ``2**bits`` bits.

    The hash is polynomial over the character codes and only its low bits are kept. Low bits of
    sums and products depend on low bits only, so reducing after every character gives the same
    position as 32-bit overflow arithmetic, and no step can exceed a BIGINT.
    """
    col = F.col(value) if isinstance(value, str) else value
    width = 1 << bits
    return F.aggregate(
        F.split(col.cast("string"), ""),
        F.lit(0).cast("bigint"),
        lambda acc, ch: (acc * base + F.ascii(ch)) % width,
    )
