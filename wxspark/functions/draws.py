"""Random draws that depend on a row key only, never on partitioning, retries or task order.

``rand(seed)`` changes with the partition layout, so a lost executor or another cluster size would
give other data. These draws hash (salt, key) instead: the same row gets the same value anywhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAW_BITS = 52  # as many as a double holds exactly


def draw_bits(key: Column, salt: int | Column) -> Column:
    """52 hashed bits of the key, as a non-negative long."""
    salt = salt if isinstance(salt, Column) else F.lit(salt)
    return F.shiftrightunsigned(F.xxhash64(salt.cast("long"), key.cast("long")), 64 - DRAW_BITS)


def uniform(key: Column, salt: int | Column) -> Column:
    """Uniform on [0, 1)."""
    return draw_bits(key, salt) / F.lit(float(1 << DRAW_BITS))


def normal(key: Column, salt: int) -> Column:
    """Standard normal from two uniforms (Box and Muller); uses the salts ``salt`` and ``salt + 1``."""
    radius = F.sqrt(F.log(1 - uniform(key, salt)) * -2)
    return radius * F.cos(uniform(key, salt + 1) * (2 * math.pi))


def fixed(value: Column, places: int = 2) -> Column:
    """Round to decimal places in double arithmetic; adding 0.0 turns a negative zero positive.

    ``round`` allocates a BigDecimal per value, five times the cost of this form. They differ only
    for values exactly halfway, which continuous draws do not hit.
    """
    scale = float(10**places)
    return (F.rint(value * scale) + F.lit(0.0)) / scale
