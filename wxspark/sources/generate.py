"""Generators: column expressions over a table of ids, in one narrow stage without a shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.constants import ATTRIBUTES, DEFAULT_SCALE, SCALES, STATIONS
from wxspark.functions.draws import fixed, normal, uniform
from wxspark.functions.rules import extreme
from wxspark.sources.dims import regime_profiles

# Salts of the draws. Another set of salts gives another, independent data set.
STATION, TEMP, HUMIDITY, WIND, WET, RAIN, PRESSURE = 1, 2, 4, 5, 6, 7, 8  # TEMP and PRESSURE take two
REGIME_SALT = 200  # + 10 * regime number + attribute number


def id_range(spark: SparkSession, rows: int, partitions: int) -> DataFrame:
    return spark.range(0, rows, 1, partitions)


def scale_ids(spark: SparkSession, scale: str) -> DataFrame:
    """Ids of a scale preset."""
    return id_range(spark, *SCALES.get(scale, DEFAULT_SCALE))


def anchor_literal(anchor: datetime | None) -> Column:
    return F.lit((anchor or datetime.now()).isoformat(sep=" ")).cast("timestamp_ntz")


def measurements(key: Column) -> dict[str, Column]:
    """The drawn columns of the observation with this id."""
    rain = F.when(uniform(key, WET) > 0.8, uniform(key, RAIN) * 20).otherwise(0.0)
    return {
        "temp_celsius": fixed(normal(key, TEMP) * 12 + 25),
        "humidity_percent": fixed(uniform(key, HUMIDITY) * 60 + 40),
        "wind_speed_kmh": fixed(uniform(key, WIND) * 30 + 5),
        "precipitation_mm": fixed(rain),
        "pressure_hpa": fixed(normal(key, PRESSURE) * 10 + 1013),
    }


def observations(ids: DataFrame, anchor: datetime | None = None) -> DataFrame:
    """Station observations, one a minute backwards from the anchor (now, when not given)."""
    key = F.col("id")
    measured = ids.select(
        key.cast("long").alias("id"),
        (uniform(key, STATION) * STATIONS).cast("int").alias("weather_station_id"),
        (anchor_literal(anchor) - key * F.expr("INTERVAL '1' MINUTE")).alias("timestamp"),
        *[value.alias(name) for name, value in measurements(key).items()],
    )
    return label_extreme(measured)


def label_extreme(df: DataFrame) -> DataFrame:
    label = extreme(F.col("temp_celsius"), F.col("wind_speed_kmh"), F.col("precipitation_mm"))
    return df.withColumn("is_extreme_weather", label)


def regimes(ids: DataFrame, rows_per_type: int) -> DataFrame:
    """Rows of every weather type for every id in [0, rows_per_type).

    ``row_no`` numbers the union of the types in order; it is arithmetic, so no global ordering runs.
    """
    typed = ids.select("id", F.explode(regime_profiles()).alias("p")).select("id", "p.*")
    low_high = [(F.col("lo")[i], F.col("hi")[i]) for i in range(len(ATTRIBUTES))]
    salt = F.col("regime_no") * 10 + REGIME_SALT
    return typed.select(
        (F.col("regime_no") * F.lit(rows_per_type).cast("long") + F.col("id")).alias("row_no"),
        *[
            fixed(lo + uniform(F.col("id"), salt + i) * (hi - lo)).alias(name)
            for i, (name, (lo, hi)) in enumerate(zip(ATTRIBUTES, low_high))
        ],
        "weather",
    )
