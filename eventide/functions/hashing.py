"""Position hash of the bitmap distinct count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bitmap holds 2^30 positions; each character multiplies by 32 and adds its code.
BITMAP_CAPACITY = 1 << 30
MULTIPLIER = 32


def bitmap_offset(value: Column, capacity: int = BITMAP_CAPACITY) -> Column:
    """Bit position of a value's decimal text; `capacity` must be a power of two.

    The mask is applied at every step: modulo a power of two it gives the same position as masking
    once at the end, and stays clear of long overflow.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    chars = F.split(value.cast("string"), "(?!$)")
    return F.aggregate(
        chars,
        F.lit(0).cast("long"),
        lambda pos, ch: (pos * MULTIPLIER + F.ascii(ch)).bitwiseAND(F.lit(capacity - 1).cast("long")),
    )
