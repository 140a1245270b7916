"""The jobs' input tables, derived by Spark from the given ``events`` table. They grow with it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.constants import CITIES, TARGETS
from wxspark.functions.calendar import hour_key, minute_text, to_hour
from wxspark.functions.draws import fixed, uniform
from wxspark.functions.rules import extreme
from wxspark.schemas import HOURLY_VALUES
from wxspark.sources import generate

ANCHOR = datetime(2024, 1, 31)
NOW = datetime(2024, 1, 31, 17, 45, 12)
FIRST_WEEK, FIRST_ISSUE = date(2024, 1, 1), date(2024, 1, 8)
UNMAPPED_CITY = "Atlantis"
CITY_NAMES = [city[0] for city in CITIES] + [UNMAPPED_CITY]
SILENT_CITY = "Mumbai"  # each request for it was answered with status 404, as for the unmapped city
BROKEN_CITY, BROKEN_ISSUE = "London", date(2024, 1, 15)  # answered with status 503
UNDATED_CITY = "Sydney"  # its documents carry no issue date

# Salts of the payload values; the second copy of a repeated hour adds COPY_SALT.
VALUE_SALTS = dict(zip(HOURLY_VALUES, (41, 42, 43, 44)))
COPY_SALT = 10


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.col("event_id").alias("id"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.observations(ids(spark, sf_dir), ANCHOR)


# Steps of the hour: value before, hour of the step, value from then on. Forests learn them exactly, so SQL can
# state what comes out of training and scoring.
STEPS = {
    "temp_celsius": (12, 16, 27),
    "humidity_percent": (80, 10, 55),
    "wind_speed_kmh": (10, 14, 20),
    "precipitation_mm": (0, 20, 4),
}
EXTREME_FROM = 12


def stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations with targets and label that are steps of the hour."""
    hour = F.hour("timestamp")
    steps = {t: F.when(hour < at, F.lit(float(low))).otherwise(float(high)) for t, (low, at, high) in STEPS.items()}
    return observations(spark, sf_dir).withColumns({**steps, "is_extreme_weather": hour >= EXTREME_FROM})


def regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = ids(spark, sf_dir)
    return generate.regimes(source, source.count())


def _city() -> Column:
    return F.array(*map(F.lit, CITY_NAMES))[F.pmod("user_id", F.lit(7)).cast("int")]


def requests_of(events_: DataFrame) -> DataFrame:
    """One request per event: mostly valid, some with a bad, empty, absent or slashed date or an unmapped city."""
    key, text = F.col("event_id"), minute_text(F.col("ts"))
    slashed = F.concat(
        F.substring(text, 6, 2), F.lit("/"), F.substring(text, 9, 2), F.lit("/"), F.substring(text, 1, 4),
        F.lit(" "), F.substring(text, 12, 5),
    )
    asked = (
        F.when(key % 50 == 0, "garbage").when(key % 51 == 0, "").when(key % 53 == 0, None).when(key % 47 == 0, slashed)
    )
    return events_.select(key.alias("id"), asked.otherwise(text).alias("date"), _city().alias("city"))


def bodies_of(events_: DataFrame) -> DataFrame:
    """The same requests as JSON bodies; an absent date has no key."""
    return requests_of(events_).select("id", F.to_json(F.struct("date", "city")).alias("body"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bodies_of(events(spark, sf_dir))


def request_lines(events_: DataFrame) -> DataFrame:
    """The requests as lines of JSON with their ids, as they land in files."""
    return requests_of(events_).select(F.to_json(F.struct("id", "date", "city")).alias("value"))


def damaged_request_lines(events_: DataFrame) -> DataFrame:
    """The same, with some lines cut off, not JSON objects, or empty."""
    key, line = F.col("event_id"), F.to_json(F.struct("event_id", F.col("ts").cast("string").alias("date")))
    value = (
        F.when(key % 11 == 0, F.substring(line, 1, 12))
        .when(key % 11 == 1, F.concat(F.lit("["), key, F.lit("]")))
        .when(key % 11 == 2, key.cast("string"))
        .when(key % 11 == 3, "")
        .otherwise(line)
    )
    return events_.select(value.alias("value"))


def damaged_observation_lines(observations_: DataFrame) -> DataFrame:
    """Observations as lines of CSV, some short of fields, some with too many, a wrong type or a missing value."""
    key = F.col("id")
    temp = F.when(key % 13 == 2, "warm").when(key % 13 == 3, "").otherwise(F.col("temp_celsius").cast("string"))
    at = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    front = F.concat_ws(",", key, "weather_station_id", at, temp, "humidity_percent", "wind_speed_kmh", "precipitation_mm")
    whole = F.concat_ws(",", front, "pressure_hpa", "is_extreme_weather")
    line = F.when(key % 13 == 0, front).when(key % 13 == 1, F.concat(whole, F.lit(",1"))).otherwise(whole)
    return observations_.select(line.alias("value"))


def body_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies as a stream over the events table, whether that is one file or a folder of files.

    A stream takes a folder or a pattern, so the name is given as a pattern that only it matches.
    """
    source = spark.readStream.schema(events(spark, sf_dir).schema)
    return bodies_of(source.parquet(f"{sf_dir}/events.parque[t]"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly payload documents per city, with an hour for every city-hour that has an event; the early weeks and
    two cities were answered with an error.

    Events are reduced to one row per city and hour before documents are packed, so a document holds
    at most 168 hours (and one repeated) however many events fall on it.
    """
    cells = (
        events(spark, sf_dir)
        .select(_city().alias("city"), to_hour(F.col("ts")).alias("hour_at"), "event_id")
        .groupBy("city", "hour_at")
        .agg(F.min("event_id").alias("key"))
    )
    week = F.floor(F.datediff(F.col("hour_at").cast("date"), F.lit(FIRST_WEEK)) / 7).cast("int")
    dated = cells.withColumn("issued", F.date_add(F.lit(FIRST_WEEK), week * 7))
    repeated = (F.hour("hour_at") == 2) & (F.col("hour_at").cast("date") == F.col("issued"))
    copies = F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    drawn = dated.withColumn("copy", F.explode(copies))

    def value(name: str) -> Column:
        return uniform(F.col("key"), VALUE_SALTS[name] + F.col("copy") * COPY_SALT)

    entries = drawn.select(
        "city",
        "issued",
        F.struct(
            "hour_at",
            "copy",
            hour_key(F.col("hour_at")).alias("time"),
            F.when(F.col("key") % 13 != 0, fixed(value("temperature_2m") * 30, 1)).alias("temperature_2m"),
            F.floor(value("relative_humidity_2m") * 60 + 40).cast("double").alias("relative_humidity_2m"),
            fixed(value("wind_speed_10m") * 30, 1).alias("wind_speed_10m"),
            fixed(value("precipitation") * 5, 1).alias("precipitation"),
        ).alias("entry"),
    )
    packed = entries.groupBy("city", "issued").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    hourly = F.struct(*[F.col(f"entries.{name}").alias(name) for name in ("time", *HOURLY_VALUES)])
    broken = (F.col("city") == BROKEN_CITY) & (F.col("issued") == F.lit(BROKEN_ISSUE))
    missing = F.col("city").isin(SILENT_CITY, UNMAPPED_CITY) | (F.col("issued") < F.lit(FIRST_ISSUE))
    return packed.select(
        "city",
        F.when(F.col("city") != UNDATED_CITY, F.col("issued")).alias("issued"),
        F.when(broken, 503).when(missing, 404).otherwise(200).alias("status"),
        F.to_json(F.struct(hourly.alias("hourly")), {"ignoreNullFields": "false"}).alias("body"),
    )


def drawn_predictions(requests: DataFrame) -> DataFrame:
    """Stand-in for the forests that SQL can repeat: the observation values drawn for the request's id."""
    accepted = F.col("error").isNull()
    drawn = generate.measurements(F.col("id"))
    predicted = requests.withColumns({f"ai_{t}": F.when(accepted, drawn[t]) for t in TARGETS})
    label = extreme(*[F.col(f"ai_{t}") for t in ("temp_celsius", "wind_speed_kmh", "precipitation_mm")])
    return predicted.withColumn("ai_is_extreme_weather", label)
