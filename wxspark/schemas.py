"""Explicit schemas; nothing in the package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

OBSERVATION = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("weather_station_id", T.IntegerType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("temp_celsius", T.DoubleType()),
        T.StructField("humidity_percent", T.DoubleType()),
        T.StructField("wind_speed_kmh", T.DoubleType()),
        T.StructField("precipitation_mm", T.DoubleType()),
        T.StructField("pressure_hpa", T.DoubleType()),
        T.StructField("is_extreme_weather", T.BooleanType()),
    ]
)

# Text fields of a request body.
REQUEST = ("date", "city")

HOURLY_VALUES = (
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "precipitation",
)

PAYLOAD = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in HOURLY_VALUES]
            ),
        )
    ]
)

PAYLOAD_FILE = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("issued", T.DateType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

# Merged ground truth: of each city and hour the row that counts, with its rank among all that landed.
TRUTH_ROW = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("hour_at", T.TimestampNTZType()),
        T.StructField("rank", T.DecimalType(38, 0)),
    ]
    + [T.StructField(name, T.DoubleType()) for name in HOURLY_VALUES]
)
TRUTH_DAY = T.StructType([T.StructField("day", T.DateType()), T.StructField("version", T.IntegerType())])

# Requests that wait for their hour: what they ask, and how many times.
WAITING = T.StructType(
    [
        T.StructField("ticket", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("copies", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("hour_at", T.TimestampNTZType()),
        T.StructField("asked_at", T.TimestampType()),
    ]
)
