"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.session import scratch_path

#: Rows that Spark hands to Python at once. A batch of the longest texts then stays in tens of megabytes.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: later reads need no executor's memory."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of an id or two that may be broadcast: some tens of megabytes.
FEW = 1_000_000


def few(df: DataFrame, label: str) -> DataFrame:
    """The rows stored, and marked for broadcast if they are counted to be at most FEW; else joins shuffle."""
    df = stored(df, label)
    return F.broadcast(df) if df.count() <= FEW else df


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch length to BATCH_ROWS, if it is longer or unlimited."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


_at_work: list = []  # the operator whose task this Python worker had last, and what forgets its memory


def at_work(operator: str, forget: Callable[[], None]) -> None:
    """Say in a task, before it remembers anything, which operator it is of.

    Spark keeps Python workers from stage to stage. What one remembers for an operator is given back when a task of
    another operator comes, so the stages of a pipeline need the memory of the largest of them, not of all.
    """
    if _at_work and _at_work[0] != operator:
        _at_work[1]()
        pa.default_memory_pool().release_unused()
    _at_work[:] = [operator, forget]


def id_lists(rows: list[list[int]]) -> pa.ListArray:
    """Lists of ids as an Arrow column."""
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.fromiter((i for ids in rows for i in ids), dtype=np.int32, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are.

    ``lower`` on the whole text is faster than ``translate``, but changes letters beyond ASCII too; it is
    taken where the text has none of the characters that it would change.
    """
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), F.lower(text)).otherwise(F.translate(text, upper, small))


#: Labels that a sample may have: the driver then holds some hundreds of megabytes of excerpts.
MAX_LABELS = 500


def sampled(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """label, order and the whole text of a bounded sample: at most ``per_label`` rows of each label, stored. More than
    MAX_LABELS labels are an error; none is left out.

    Only models are fitted on it. ``rows`` has doc_id, text and ``label``. The choice is by a hash of
    doc_id, so it does not depend on partitions; rows that repeat an id count once.
    """
    rows = rows.where(F.col(label).isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    spark, kind = rows.sparkSession, rows.schema[label].dataType.simpleString()
    counts = rows.groupBy(label).count().limit(MAX_LABELS + 1).collect()
    if len(counts) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} different values of {label} to learn from")
    hashed = F.xxhash64(F.lit("sample"), "doc_id")
    shares = spark.createDataFrame([(v, min(1.0, 1.3 * (per_label + 10) / n)) for v, n in counts], f"{label} {kind}, share double")
    unit = F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))
    chosen = (
        rows.join(F.broadcast(shares), label)
        .where(unit < F.col("share"))
        .select(F.col(label).alias("label"), hashed.alias("order"), "text")
        .groupBy("label", "order")
        .agg(F.min("text").alias("text"))
    )
    chosen = stored(chosen, "sample")
    orders: dict[object, list[int]] = {}
    for value, order in chosen.select("label", "order").collect():  # about 1.3 * per_label numbers a label
        orders.setdefault(value, []).append(order)
    cuts = [(v, sorted(o)[:per_label][-1]) for v, o in orders.items()]
    cuts = spark.createDataFrame(cuts, f"label {kind}, last long")
    return chosen.join(F.broadcast(cuts), "label").where(F.col("order") <= F.col("last")).drop("last")


def excerpts(sample: DataFrame, piece: int) -> list[tuple]:
    """(label, excerpt) of a sample, in its order: what goes into dictionaries, which hold a fixed number of bytes.

    Excerpts begin at a hashed place, so that they are not all beginnings.
    """
    start = 1 + F.pmod("order", F.greatest(F.char_length("text") - piece, F.lit(0)) + 1).cast("int")
    rows = sample.select("label", "order", F.substring("text", start, F.lit(piece)).alias("piece")).collect()
    return [(r.label, r.piece) for r in sorted(rows, key=lambda r: (r.order, str(r.label)))]
