"""Verification requests: parse, default, validate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.constants import BAD_CITY, BAD_DATE, DEFAULT_CITY
from wxspark.functions.calendar import minute_text, to_hour
from wxspark.schemas import REQUEST
from wxspark.sources.dims import city_dim


def parse_requests(bodies: DataFrame, body: str = "body") -> DataFrame:
    """JSON bodies to (id, date, city); requests with an empty date are skipped, absent fields are null.

    Bodies that come without an ``id`` column take it from the JSON, or else from a hash of the body.
    """
    if "id" in bodies.columns:
        kept = [c for c in bodies.columns if c != body]
        parsed = bodies.select(*kept, F.json_tuple(body, *REQUEST).alias(*REQUEST))
    else:
        parsed = bodies.select("*", F.json_tuple(body, "id", *REQUEST).alias("id", *REQUEST))
        own = F.col("id").try_cast("long")
        parsed = parsed.withColumn("id", F.coalesce(own, F.xxhash64(body))).drop(body)
    # The filter stays above the generator, so every body is parsed once.
    return parsed.where(F.col("date").isNull() | (F.col("date") != ""))


def read_bodies(reader, path: str) -> DataFrame:
    """body, file: the lines of landed files. ``reader`` is a session, or a stream's or a batch's reader."""
    source = reader.read if isinstance(reader, SparkSession) else reader
    return source.text(path).select(F.col("value").alias("body"), F.col("_metadata.file_path").alias("file"))


def _damage(body: Column) -> Column:
    """Why a line is no request; null for one that is. The kind of a JSON value is the word that its type begins with."""
    value = F.try_parse_json(body)
    kind = F.schema_of_variant(value)
    return (
        F.when(F.trim(body) == "", "empty line")
        .when(value.isNull(), "no JSON")
        .when(~kind.startswith("OBJECT"), F.concat(F.lit("no JSON object but "), F.lower(F.split_part(kind, F.lit("<"), F.lit(1)))))
    )


def sound_bodies(lines: DataFrame) -> DataFrame:
    """body: the lines that are JSON objects."""
    return lines.where(_damage(F.col("body")).isNull()).select("body")


def damaged_bodies(lines: DataFrame) -> DataFrame:
    """body, file, reason of all other lines, so that every line is in one of the two."""
    return lines.select("body", "file", _damage(F.col("body")).alias("reason")).where(F.col("reason").isNotNull())


def default_requests(requests: DataFrame, now: datetime) -> DataFrame:
    """Fill absent fields as an untouched form does: the current hour and the first city."""
    this_hour = minute_text(to_hour(F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")))
    return requests.withColumns(
        {
            "date": F.coalesce("date", this_hour),
            "city": F.coalesce("city", F.lit(DEFAULT_CITY)),
        }
    )


# Patterns of a lower-case text and what they become, in this order: a weekday in front and a zone after a clock are
# taken off, names of months come to three letters, dates to year-month-day, clocks to hours and minutes. Month-first unless that
# cannot be a month.
_WRITTEN = (
    (r"^(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\.?,? +", ""),
    (r"(:\d{2}(?:[.,]\d+)?|t\d{4}(?:\d{2})?) ?(?:z|utc|gmt|[+-]\d{2}:?\d{2})$", "$1"),
    (r"^([a-z]{3})[a-z]*\.? +(\d{1,2})(?:st|nd|rd|th)?,? +(\d{4})", "$2 $1 $3"),
    (r"^(\d{1,2})(?:st|nd|rd|th)? +([a-z]{3})[a-z]*\.?,? +(\d{4})", "$3-$2-$1"),
    (r"^(\d{4})(\d{2})(\d{2})(?=$|\D)", "$1-$2-$3"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})", "$1-$2-$3"),
    (r"^(1[3-9]|2\d|3[01])[-/.](\d{1,2})[-/.](\d{4})", "$3-$2-$1"),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})", "$3-$1-$2"),
    (r"^(\d{4}-\w+-\d{1,2}),?[t ]+", "$1 "),
    (r" (\d{2})(\d{2})(\d{2})$", " $1:$2:$3"),
    (r" (\d{2})(\d{2})$", " $1:$2"),
    (r" (\d{1,2}) ?([ap])\.?m\.?$", " $1:00 $2m"),
    (r"(:\d{2}) ?([ap])\.?m\.?$", "$1 $2m"),
)
_FORMS = ("yyyy-M-d[ H:mm[:ss]]", "yyyy-M-d h:mm a", "yyyy-MMM-d[ H:mm[:ss]]", "yyyy-MMM-d h:mm a")


def parse_date(text: Column) -> Column:
    """Dates with or without a time, in the forms people write; else null.

    ISO with dashes, slashes, dots or compact; month-first, or day-first where the first number exceeds 12;
    names of months; 12-hour clocks. A zone at the end is taken off: what counts is the wall clock. So is the name of a
    weekday in front, whether or not it is that of the date.
    """
    plain = F.lower(F.trim(text))
    for pattern, form in _WRITTEN:
        plain = F.regexp_replace(plain, pattern, form)
    # The lambda binds the rewritten text, which would be computed once for each form otherwise.
    read = F.transform(F.array(plain), lambda d: F.coalesce(*(F.try_to_timestamp(d, F.lit(f)) for f in _FORMS)))
    return F.coalesce(text.try_cast("timestamp_ntz"), F.get(read, 0).cast("timestamp_ntz"))


def lookup_city(requests: DataFrame) -> DataFrame:
    """Left join to the six cities; ``lat`` is null for a city that is not mapped."""
    cities = city_dim(requests.sparkSession).select("city", "lat", "lon", "timezone", "label")
    return requests.join(F.broadcast(cities), "city", "left")


def validate_requests(requests: DataFrame) -> DataFrame:
    """Add city, ``requested_at`` and ``error``; a bad date is reported before a bad city."""
    checked = lookup_city(requests).withColumn("requested_at", parse_date(F.col("date")))
    return checked.withColumn(
        "error",
        F.when(F.col("requested_at").isNull(), BAD_DATE).when(F.col("lat").isNull(), BAD_CITY),
    )
