"""Seven-day hourly forecast per city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.functions.calendar import calendar_parts
from wxspark.plans.train import model_predictions

HOURS = 7 * 24


def timeline_hours(starts: DataFrame, hours: int = HOURS) -> DataFrame:
    """(city, start_at) to one row per hour from the start on, with its calendar parts."""
    ahead = F.explode(F.sequence(F.lit(0), F.lit(hours - 1)))
    return (
        starts.select("city", "start_at", ahead.alias("ahead"))
        .select("city", (F.col("start_at") + F.col("ahead") * F.expr("INTERVAL '1' HOUR")).alias("hour_at"))
        .withColumns(calendar_parts(F.col("hour_at")))
    )


def forecast_timeline(starts: DataFrame, grid: DataFrame) -> DataFrame:
    return model_predictions(grid)(timeline_hours(starts))
