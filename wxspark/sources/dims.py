"""Fixed dimensions. Six cities and five regimes: small enough to broadcast anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wxspark.constants import ATTRIBUTES, CITIES, REGIMES


def city_dim(spark: SparkSession) -> DataFrame:
    """City, coordinates, zone, label, and the shown code and coordinates (cut, not rounded, to one decimal)."""
    names = ("city", "lat", "lon", "timezone", "label", "iso3")
    return _literal_rows(spark, CITIES, names).select("*", _cut("lat").alias("lat_shown"), _cut("lon").alias("lon_shown"))


def _literal_rows(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A plan of literals: its size is known to the optimizer, and no Python task produces it."""
    structs = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def _cut(name: str) -> Column:
    return (F.col(name) * 10).cast("int") / 10


def regime_dim(spark: SparkSession) -> DataFrame:
    """Number, name and the bounds ``<attribute>_lo`` and ``<attribute>_hi`` of each weather type."""
    rows = [
        (number, weather, *[float(edge) for bounds in profile for edge in bounds])
        for number, (weather, profile) in enumerate(REGIMES.items())
    ]
    names = ("regime_no", "weather", *[f"{a}_{edge}" for a in ATTRIBUTES for edge in ("lo", "hi")])
    return _literal_rows(spark, rows, names)


def regime_profiles() -> Column:
    """The same five profiles as one array literal of (regime_no, weather, lo, hi) for ``explode``."""
    return F.array(
        *[
            F.struct(
                F.lit(number).alias("regime_no"),
                F.lit(weather).alias("weather"),
                F.array(*[F.lit(float(lo)) for lo, _ in profile]).alias("lo"),
                F.array(*[F.lit(float(hi)) for _, hi in profile]).alias("hi"),
            )
            for number, (weather, profile) in enumerate(REGIMES.items())
        ]
    )
