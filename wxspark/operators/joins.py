"""Lookup joins whose broadcast is decided by a size check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.functions.draws import draw_bits
from wxspark.session import scratch_path

BROADCAST_ROWS = 500_000  # of ground truth: some 60 MB, or nine years of hours for six cities
SALTS = 32


def bounded_lookup(
    left: DataFrame, right: DataFrame, keys: list[str], spread: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join to a table that is small as a rule but may grow.

    ``right`` holds one row per key and should be a stored table, as it is counted first (from file
    footers, for parquet). Within the bound it is broadcast and ``left`` is not shuffled. Beyond it
    ``left`` is shuffled, except for its hot keys; a stream, which cannot be counted, is salted by
    the row id ``spread`` instead.
    """
    if right.count() <= broadcast_rows:
        return left.join(F.broadcast(right), keys, "left")
    if left.isStreaming:
        return _salted(left, right, keys, spread)
    return _hot_keys_apart(left, right, keys, broadcast_rows)


def _hot_keys_apart(left: DataFrame, right: DataFrame, keys: list[str], broadcast_rows: int) -> DataFrame:
    """Broadcast join for the hot keys, sort-merge join for the rest.

    A key is hot when it holds more than a 1/broadcast_rows share of ``left``. There cannot be more
    than ``broadcast_rows`` such keys, so their rows of ``right`` may be broadcast, and no other key
    is large. Rows with a null key match nothing and take the broadcast side, too: the shuffle would
    send all of them to one task. ``left`` is written to the shared folder first, so that what stands below it
    is computed once, and not for the counts and for either side.
    """
    path = scratch_path(left.sparkSession, "lookup")
    left.write.parquet(path)
    left = left.sparkSession.read.schema(left.schema).parquet(path)
    counts = left.groupBy(*keys).agg(F.count("*").alias("n")).checkpoint()
    total = counts.agg(F.sum("n")).scalar()
    hot = counts.dropna(subset=keys).where(F.col("n") * F.lit(broadcast_rows) > total).select(*keys)

    flagged = left.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    shuffled = F.col("_hot").isNull() & reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    hot_right = right.join(F.broadcast(hot), keys, "left_semi")
    apart = flagged.where(~shuffled).join(F.broadcast(hot_right), keys, "left")
    rest = flagged.where(shuffled).join(right.hint("merge"), keys, "left")
    return apart.unionByName(rest).drop("_hot")


def _salted(left: DataFrame, right: DataFrame, keys: list[str], spread: str) -> DataFrame:
    """Every key of a micro-batch over SALTS tasks, the null ones as well."""
    salted_left = left.withColumn("_salt", (draw_bits(F.col(spread), 0) % SALTS).cast("int"))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted_left.join(salted_right.hint("merge"), [*keys, "_salt"], "left").drop("_salt")
