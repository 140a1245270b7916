"""Texts shown to people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wxspark.constants import NO_TEMPERATURE, NO_WIND


def number_text(value: Column) -> Column:
    """Shortest form: ``20.5`` stays, ``20.0`` shows as ``20``."""
    whole = value.cast("long")
    return F.when(value == whole, whole.cast("string")).otherwise(value.cast("string"))


def with_unit(value: Column, unit: str, missing: str | None = None) -> Column:
    text = F.concat(number_text(value), F.lit(unit))
    return text if missing is None else F.coalesce(text, F.lit(missing))


def real_temperature(value: Column) -> Column:
    return with_unit(value, "°", NO_TEMPERATURE)


def real_wind(value: Column) -> Column:
    return with_unit(value, " km/h", NO_WIND)


def percent_text(share: Column) -> Column:
    """Share as a percentage with one decimal."""
    return F.format_string("%.1f%%", share.cast("double") * 100)


def decimals_text(value: Column, places: int) -> Column:
    return F.format_string(f"%.{places}f", value.cast("double"))
