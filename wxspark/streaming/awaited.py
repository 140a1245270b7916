"""Requests whose hour has not landed yet: they wait for it, and are answered once, when it lands or too late.

Waiting is an outer join of two streams in event time: the requests that wait, and the hours of forecasts as they land.
Both carry watermarks. A request meets an hour that lands within its time to wait; when the watermark has passed that time
without one, the join gives the request out alone. Several forecasts may bring the hour: the first that does answers, the
others are dropped by the request's ticket for as long as they can come. So the join decides when a request is
answered. What it is answered with is read from the merged ground truth of that moment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wxspark.functions.draws import draw_bits
from wxspark.plans.verify import accepted
from wxspark.schemas import PAYLOAD_FILE, WAITING
from wxspark.sources import payloads

#: Parts of each hour in the join's state: a third of all requests may wait for the same hour.
SALTS = 16


def open_requests(results: DataFrame) -> Column:
    """Accepted requests whose hour is not known."""
    return F.col("error").isNull() & ~F.col("real_found")


def tickets(results: DataFrame, batch_id: int) -> DataFrame:
    """Add ``ticket``, equal for rows of a batch that ask the same under the same id."""
    asked = F.concat_ws("|", F.lit(batch_id), F.coalesce(F.col("id").cast("string"), F.lit("-")), "city", "requested_at")
    return results.withColumn("ticket", F.sha2(asked, 256))


def waiting_rows(ticketed: DataFrame, asked_at: Column) -> DataFrame:
    """Open requests as rows of WAITING; equal ones are one row with their number."""
    body = F.to_json(F.struct("id", F.date_format("requested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date"), "city"))
    hour_at = F.replace("hour_key", F.lit("T"), F.lit(" ")).cast("timestamp_ntz")
    one = ticketed.where(open_requests(ticketed)).select("ticket", body.alias("body"), "city", hour_at.alias("hour_at"))
    counted = one.groupBy("ticket", "body", "city", "hour_at").agg(F.count("*").alias("copies"))
    # A row that stands for no request moves the time on, also when nothing new has to wait.
    names = [*WAITING.fieldNames()]
    nothing = {"ticket": F.expr("uuid()"), "copies": F.lit(0).cast("long")}
    tick = one.sparkSession.range(1).select(*[nothing.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in WAITING])
    return counted.withColumn("asked_at", asked_at).select(*names).unionByName(tick.withColumn("asked_at", asked_at))


def read_waiting(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(WAITING).option("recursiveFileLookup", "true").parquet(path)


def landing_hours(spark: SparkSession, landed_payloads: str, lateness: str, landed_at: Column | None = None) -> DataFrame:
    """city, hour_at, landed_at of forecasts as they land; by default the time at which their file was written.

    Every document moves the time on, also one without hours, or without a city: the join's condition on cities would
    become a filter in front of the watermark if they could be null.
    """
    at = F.col("_metadata.file_modification_time") if landed_at is None else landed_at
    landed = spark.readStream.schema(PAYLOAD_FILE).json(landed_payloads)
    documents = landed.withColumns({"landed_at": at, "city": F.coalesce("city", F.lit(""))})
    return payloads.document_hours(documents.withWatermark("landed_at", lateness), "landed_at")


def due(waiting: DataFrame, hours: DataFrame, wait: str, lateness: str) -> DataFrame:
    """Rows of ``waiting`` to be answered now, each once: its hour has landed, or can no longer do so in time.

    ``hours`` has city, hour_at and landed_at with its watermark. Hours may have landed up to ``lateness`` before the request began to wait, as
    the two streams do not run in step; files may be read out of their order by as much.
    """
    salt = draw_bits(F.xxhash64("ticket"), 0) % SALTS
    left = waiting.withWatermark("asked_at", lateness).withColumn("salt", salt.cast("int"))
    right = hours.select(
        F.col("city").alias("h_city"), F.col("hour_at").alias("h_hour"), "landed_at",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("h_salt"),
    )
    same = (F.col("city") == F.col("h_city")) & (F.col("hour_at") == F.col("h_hour")) & (F.col("salt") == F.col("h_salt"))
    in_time = F.expr(
        f"landed_at >= asked_at - interval {lateness} and landed_at <= asked_at + interval {wait}"
    )
    joined = left.join(right, same & in_time, "left_outer")
    return joined.select(*WAITING.fieldNames()).dropDuplicatesWithinWatermark(["ticket"])


def answer_waiting(
    waiting: DataFrame,
    hours: DataFrame,
    answer: Callable[[DataFrame, int], None],
    checkpoint: str,
    wait: str = "6 hours",
    lateness: str = "10 minutes",
    **trigger,
) -> StreamingQuery:
    """Call ``answer(requests, batch_id)`` with the bodies that are due; equal requests come as often as they were asked.

    ``answer`` may be called again for a batch after a failure. Time is that of the slower stream: it stands still while no
    forecast, of whatever status, or no batch of requests comes.
    """

    def due_now(batch: DataFrame, batch_id: int) -> None:
        each = batch.where("copies > 0").select("body", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
        answer(each.select("body"), batch_id)

    writer = due(waiting, hours, wait, lateness).writeStream.foreachBatch(due_now).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
