"""Labels and verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wxspark.constants import ALERT_OFF, ALERT_ON, COLD, DELUGE, GALE, HOT, NOT_FOUND, VERDICTS


def extreme(temp: Column, wind: Column, precipitation: Column) -> Column:
    return (temp > HOT) | (temp < COLD) | (wind > GALE) | (precipitation > DELUGE)


def deviation(predicted: Column, actual: Column) -> Column:
    """Absolute difference to one decimal, computed in decimals so that ties round up reliably.

    Values a forecast cannot hold (beyond 16 digits) give null, not a failed job.
    """
    money = "decimal(18,2)"
    return F.round(F.abs(predicted.try_cast(money) - actual.try_cast(money)), 1)


def verdict(found: Column, deviation_: Column) -> Column:
    """The deviation is judged after rounding. Null when the hour was found but holds no value."""
    text = F.when(~found, NOT_FOUND).when(deviation_.isNull(), None)
    for limit, words in VERDICTS:
        message = F.concat(F.lit("Deviation: "), deviation_.cast("string"), F.lit("°C. " + words))
        text = text.otherwise(message) if limit is None else text.when(deviation_ < limit, message)
    return text


def alert(is_extreme: Column) -> Column:
    return F.when(is_extreme, ALERT_ON).when(~is_extreme, ALERT_OFF)
