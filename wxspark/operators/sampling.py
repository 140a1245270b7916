"""Seeded samples and splits whose result depends on row ids only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxspark.constants import TEST_FRACTION
from wxspark.functions.draws import DRAW_BITS, draw_bits, uniform

SAMPLE_SALT, SPLIT_SALT = 101, 102
_LEVEL_BITS = 12
_FIRST = DRAW_BITS - _LEVEL_BITS
_SECOND = _FIRST - _LEVEL_BITS


def split_bucket(df: DataFrame, key: str = "id", fraction: float = TEST_FRACTION) -> DataFrame:
    """Flag about ``fraction`` of the rows as test rows. Narrow: no shuffle, no count."""
    return df.withColumn("is_test", uniform(F.col(key), SPLIT_SALT) < fraction)


def split_exact(df: DataFrame, key: str = "id", fraction: float = TEST_FRACTION) -> DataFrame:
    """Flag exactly ceil(fraction * n) rows as test rows: none for a fraction of 0, all for 1."""
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction {fraction} is not between 0 and 1")
    total = df.count()
    return df.withColumn("is_test", _smallest(df, key, SPLIT_SALT, math.ceil(total * fraction), total))


def sample_exact(df: DataFrame, size: int, key: str = "id") -> DataFrame:
    """Exactly ``size`` rows without replacement, or all of them when there are fewer."""
    if size < 0:
        raise ValueError(f"size {size} is negative")
    return df.where(_smallest(df, key, SAMPLE_SALT, size, df.count()))


def head(df: DataFrame, rows: int = 5, key: str = "id") -> DataFrame:
    return df.orderBy(key).limit(rows)


def _smallest(df: DataFrame, key: str, salt: int, wanted: int, total: int) -> Column:
    """Whether a row is among the ``wanted`` smallest by (draw, key).

    The cut is found here, once, and goes into the condition as two literals, so later passes do not search
    for it again. Keys have to be unique: an exact number of rows cannot be told apart otherwise.
    """
    if wanted <= 0:
        return F.lit(False)
    if wanted >= total:
        return F.lit(True)
    bits, cut = _cut(df, key, salt, wanted)
    drawn = draw_bits(F.col(key), salt)
    return (drawn < bits) | ((drawn == bits) & (F.col(key).cast("long") <= cut))


def _cut(df: DataFrame, key: str, salt: int, wanted: int) -> tuple[int, int]:
    """The (draw, key) of the last of the ``wanted`` smallest rows, of more than ``wanted``.

    ``orderBy(draw).limit(k)`` would move k rows of every task into one. Here two histograms of 4096
    counters narrow the place of the cut to a 2**-24 share of the keys, and only those are ranked, by one
    task: some 60,000 of 10**12. All three passes read the key column only.
    """
    drawn = df.select(F.col(key).cast("long").alias("key"), draw_bits(F.col(key), salt).alias("bits"))
    left = wanted
    for bits_kept in (_FIRST, _SECOND):
        bucket, left = _bucket_of(drawn, bits_kept, left)
        drawn = drawn.where(F.shiftright("bits", bits_kept) == bucket)
    upto = F.row_number().over(Window.orderBy("bits", "key"))
    ranked = drawn.withColumn("upto", upto).where(F.col("upto").between(left, left + 1)).orderBy("upto").collect()
    at = ranked[0]
    if len(ranked) > 1 and (ranked[1].bits, ranked[1].key) == (at.bits, at.key):
        raise ValueError(f"{key} {at.key} repeats; an exact sample needs unique keys")
    return at.bits, at.key


def _bucket_of(drawn: DataFrame, shift: int, wanted: int) -> tuple[int, int]:
    """The bucket that the ``wanted``-th row falls in, and how many of its rows are taken."""
    counts = drawn.groupBy(F.shiftright("bits", shift).alias("bucket")).agg(F.count("*").alias("n"))
    for bucket, n in sorted(counts.collect()):  # at most 4096 counters
        if wanted <= n:
            return bucket, wanted
        wanted -= n
    raise ValueError("the rows changed between two passes")
