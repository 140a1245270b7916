"""Landed forecast payloads: JSON documents of parallel hourly arrays, one per city and issue date."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.operators.joins import BROADCAST_ROWS, bounded_lookup
from wxspark.schemas import HOURLY_VALUES, PAYLOAD, PAYLOAD_FILE

# Payload array -> column of the ground truth.
REAL_COLUMNS = {
    "temperature_2m": "real_temp_celsius",
    "relative_humidity_2m": "real_humidity_percent",
    "wind_speed_10m": "real_wind_speed_kmh",
    "precipitation": "real_precipitation_mm",
}


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines (city, issued, status, body); the body is the document's text."""
    return spark.read.schema(PAYLOAD_FILE).json(path)


def payload_hours(payloads: DataFrame) -> DataFrame:
    """(city, issued, status, body) to one row per array position.

    Only status 200 counts. A body that is not JSON or lacks ``hourly`` has no hours, and an hour
    beyond the end of a value array (or a missing array) is not an hour.
    """
    return _hours(payloads, "city", "issued")


def _hours(payloads: DataFrame, *keys: str) -> DataFrame:
    """The keys, pos, time and values of each array position."""
    parsed = payloads.where(F.col("status") == 200).select(*keys, F.from_json("body", PAYLOAD)["hourly"].alias("hourly"))
    arrays = [F.coalesce(f"hourly.{name}", F.array()) for name in ("time", *HOURLY_VALUES)]
    complete = F.least(*[F.size(a) for a in arrays])
    zipped = F.arrays_zip(*[a.alias(name) for a, name in zip(arrays, ("time", *HOURLY_VALUES))])
    # The outer form keeps the optimizer from inferring a filter on the array's size, which would
    # parse every document again, once for each array.
    return (
        parsed.select(*keys, F.slice(zipped, 1, complete).alias("hours"))
        .select(*keys, F.posexplode_outer("hours").alias("pos", "h"))
        .where(F.col("pos").isNotNull())
        .select(*keys, "pos", "h.*")
    )


def document_hours(documents: DataFrame, *keys: str) -> DataFrame:
    """city, hour_at and the named columns of the documents, a row for each full hour that one has.

    Documents of another status lose their body instead of being filtered out, as a filter would be moved in front of a
    stream's watermark.
    """
    answered = documents.withColumns({"body": F.when(F.col("status") == 200, F.col("body")), "status": F.lit(200)})
    hours = _hours(answered, "city", *keys)
    hour_at = F.when(F.col("time").rlike(HOUR_TEXT), F.col("time").try_cast("timestamp_ntz"))
    return hours.select("city", hour_at.alias("hour_at"), *keys).where(F.col("hour_at").isNotNull())


HOUR_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:00$"


def ground_truth(hours: DataFrame) -> DataFrame:
    """One row per city and hour: from the newest payload, and in it the first position.

    A payload without an issue date counts as older than any with one. Only times written as a full hour
    are hours.
    """
    return as_truth(newest(ranked_hours(hours)))


def ranked_hours(hours: DataFrame) -> DataFrame:
    """city, hour_at, rank and the values of each hour; of a city and hour the smallest rank counts.

    Newer documents have smaller ranks, in a document earlier positions. Documents of one city and issue date may
    differ; a hash of the values then decides, so that no order of rows does. All of that is packed into one number so
    that ``newest`` keeps fixed-width buffers and runs as a hash aggregate with map-side partials; ``min_by`` on structs
    would sort.
    """
    issued = F.coalesce("issued", F.expr("date'0001-01-01'"))
    order = F.col("pos") - F.unix_date(issued).cast("long") * 1_000_000_000
    rank = order.cast("decimal(18,0)") * F.lit(Decimal(1 << 64)) + F.xxhash64(*HOURLY_VALUES).cast("decimal(19,0)")
    hour_at = F.when(F.col("time").rlike(HOUR_TEXT), F.col("time").try_cast("timestamp_ntz"))
    ranked = hours.select("city", hour_at.alias("hour_at"), rank.cast("decimal(38,0)").alias("rank"), *HOURLY_VALUES)
    return ranked.where(F.col("hour_at").isNotNull())


def newest(ranked: DataFrame) -> DataFrame:
    """The row of the smallest rank of each city and hour."""
    values = [F.min_by(v, "rank").alias(v) for v in HOURLY_VALUES]
    return ranked.groupBy("city", "hour_at").agg(F.min("rank").alias("rank"), *values)


def as_truth(rows: DataFrame) -> DataFrame:
    named = [F.col(source).alias(target) for source, target in REAL_COLUMNS.items()]
    return rows.select("city", "hour_at", *named).withColumn("real_found", F.lit(True))


def lookup_truth(requests: DataFrame, truth: DataFrame, spread: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join of requests to the ground truth on (city, hour_at); ``real_found`` tells a miss."""
    joined = bounded_lookup(requests, truth, ["city", "hour_at"], spread, broadcast_rows)
    return joined.withColumn("real_found", F.coalesce("real_found", F.lit(False)))
