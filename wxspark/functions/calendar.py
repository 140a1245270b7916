"""Wall-clock parts of a ``timestamp_ntz``; none of them depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def calendar_parts(at: Column) -> dict[str, Column]:
    return {"month": F.month(at), "day": F.day(at), "hour": F.hour(at)}


def to_hour(at: Column) -> Column:
    """Start of the hour. ``date_trunc`` would go through the session zone and its clock changes."""
    past = F.make_dt_interval(F.lit(0), F.lit(0), F.minute(at), F.date_part(F.lit("SECOND"), at))
    return at - past


def hour_key(at: Column) -> Column:
    """Start of the hour as ``yyyy-MM-ddTHH:00``."""
    return F.concat(F.replace(F.substring(at.cast("string"), 1, 13), F.lit(" "), F.lit("T")), F.lit(":00"))


def minute_text(at: Column) -> Column:
    """``yyyy-MM-ddTHH:mm``, the form of a request's date."""
    return F.replace(F.substring(at.cast("string"), 1, 16), F.lit(" "), F.lit("T"))


def weekday_clock(at: Column) -> Column:
    """Such as ``Monday, 05:30 PM``."""
    weekday = F.get(F.array(*map(F.lit, WEEKDAYS)), F.weekday(at))
    hour = F.lpad(((F.hour(at) + 11) % 12 + 1).cast("string"), 2, "0")
    minute = F.lpad(F.minute(at).cast("string"), 2, "0")
    half = F.when(F.hour(at) < 12, " AM").otherwise(" PM")
    return F.concat(weekday, F.lit(", "), hour, F.lit(":"), minute, half)


def season(month: Column, lat: Column) -> Column:
    """Meteorological season; south of the equator it is the one half a year later."""
    shifted = F.when(lat >= 0, month).when(lat < 0, month + 6) % 12
    names = F.array(*map(F.lit, ("winter", "spring", "summer", "autumn")))
    return F.get(names, F.floor(shifted / 3).cast("int"))
