"""Verify requests: parse, validate, predict, look up the ground truth, judge.

One plan for tables and streams. Requests are never shuffled unless the ground truth outgrows its
broadcast bound; it is stateless, so a stream needs no watermark.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.constants import TARGETS
from wxspark.functions import display
from wxspark.functions.calendar import calendar_parts, hour_key, season, to_hour, weekday_clock
from wxspark.functions.rules import alert, deviation, verdict
from wxspark.operators.joins import BROADCAST_ROWS
from wxspark.sources.payloads import lookup_truth
from wxspark.sources.requests import default_requests, parse_requests, validate_requests

Predictor = Callable[[DataFrame], DataFrame]

RESULT = (
    ["id", "city", "label", "requested_at", "hour_key", "season", "error"]
    + [f"ai_{t}" for t in TARGETS]
    + ["ai_is_extreme_weather", "real_found"]
    + [f"real_{t}" for t in TARGETS]
    + ["deviation", "verdict", "alert"]
)


def verify(
    bodies: DataFrame,
    predict: Predictor,
    truth: DataFrame,
    key: str = "id",
    broadcast_rows: int = BROADCAST_ROWS,
    also: tuple[str, ...] = (),
    now: datetime | None = None,
) -> DataFrame:
    """Request bodies (id, body) to results; a rejected request keeps its ``error`` and null results.

    ``also`` names columns of the predictor's that results carry behind their own. With ``now`` absent dates and cities
    are filled in as an untouched form has them at that time.
    """
    asked = parse_requests(bodies)
    checked = validate_requests(asked if now is None else default_requests(asked, now))
    timed = with_request_time(checked)
    predicted = predict(timed)
    return judge(lookup_truth(predicted, truth, key, broadcast_rows)).select(*RESULT, *also)


def with_request_time(checked: DataFrame) -> DataFrame:
    """Time columns of the valid requests; null for rejected ones, which then match nothing below."""
    at = F.when(F.col("error").isNull(), F.col("requested_at"))
    return checked.withColumn("requested_at", at).withColumns(
        {
            **calendar_parts(F.col("requested_at")),
            "hour_at": to_hour(F.col("requested_at")),
            "hour_key": hour_key(F.col("requested_at")),
        }
    )


def judge(looked_up: DataFrame) -> DataFrame:
    """Season, deviation, verdict and alert."""
    accepted = F.col("error").isNull()
    found = F.when(accepted, F.col("real_found"))
    return (
        looked_up.withColumn("real_found", found)
        .withColumn("_deviation", deviation(F.col("ai_temp_celsius"), F.col("real_temp_celsius")))
        .withColumns(
            {
                "season": season(F.col("month"), F.col("lat")),
                "deviation": F.col("_deviation").cast("double"),
                "verdict": verdict(F.col("real_found"), F.col("_deviation")),
                "alert": alert(F.col("ai_is_extreme_weather")),
            }
        )
    )


def accepted(results: DataFrame) -> DataFrame:
    return results.where(F.col("error").isNull())


def rejected(results: DataFrame) -> DataFrame:
    return results.where(F.col("error").isNotNull())


def result_json(results: DataFrame) -> DataFrame:
    """The response text, as ``{"ai": …, "real": …}``; a rejected request gets ``{"error": …}``.

    ``real`` carries values, null ones too, when the hour was found, else only ``"found": false``.
    """
    ai = F.struct(*[F.col(f"ai_{f}").alias(f) for f in (*TARGETS, "is_extreme_weather")]).alias("ai")
    real = F.struct(*[F.col(f"real_{f}").alias(f) for f in ("found", *TARGETS)]).alias("real")
    missing = F.struct(F.col("real_found").alias("found")).alias("real")
    keep_nulls = {"ignoreNullFields": "false"}
    response = (
        F.when(F.col("error").isNotNull(), F.to_json(F.struct("error")))
        .when(F.col("real_found"), F.to_json(F.struct(ai, real), keep_nulls))
        .otherwise(F.to_json(F.struct(ai, missing), keep_nulls))
    )
    return results.select("id", response.alias("response"))


def display_fields(results: DataFrame) -> DataFrame:
    """What a reader is shown for each accepted request."""
    shown: dict[str, Column] = {
        "location": F.col("label"),
        "moment": weekday_clock(F.col("requested_at")),
        "ai_temp": display.with_unit(F.col("ai_temp_celsius"), "°C"),
        "ai_precip": display.with_unit(F.col("ai_precipitation_mm"), " mm"),
        "ai_humid": display.with_unit(F.col("ai_humidity_percent"), "%"),
        "synth_temp": display.with_unit(F.col("ai_temp_celsius"), "°"),
        "synth_wind": display.with_unit(F.col("ai_wind_speed_kmh"), " km/h"),
        "real_temp": display.real_temperature(F.col("real_temp_celsius")),
        "real_wind": display.real_wind(F.col("real_wind_speed_kmh")),
        "report": F.col("verdict"),
        "status": F.col("alert"),
    }
    return accepted(results).select("id", *[value.alias(name) for name, value in shown.items()])
