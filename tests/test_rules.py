"""Labels, seasons, verdicts and texts at their boundaries."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wxspark.functions import calendar, display, rules


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "temp, wind, rain, expected",
    [
        (40.0, 0.0, 0.0, False),
        (40.01, 0.0, 0.0, True),
        (-10.0, 0.0, 0.0, False),
        (-10.01, 0.0, 0.0, True),
        (20.0, 100.0, 0.0, False),
        (20.0, 100.01, 0.0, True),
        (20.0, 0.0, 50.0, False),
        (20.0, 0.0, 50.01, True),
    ],
)
def test_extreme(spark, temp, wind, rain, expected):
    column = rules.extreme(F.col("t"), F.col("w"), F.col("r"))
    assert values(spark, [(temp, wind, rain)], "t double, w double, r double", column) == [expected]


def test_recorded_rows_keep_their_label(spark):
    rows = [
        (20.95, 14.44, 0.0),
        (48.03, 8.69, 0.0),
        (36.52, 17.17, 0.0),
        (21.96, 30.84, 0.0),
        (37.89, 13.98, 0.0),
    ]
    column = rules.extreme(F.col("t"), F.col("w"), F.col("r"))
    assert values(spark, rows, "t double, w double, r double", column) == [False, True, False, False, False]


def test_season(spark):
    north = ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["autumn"] * 3 + ["winter"]
    opposite = {"winter": "summer", "summer": "winter", "spring": "autumn", "autumn": "spring"}
    rows = [(m, lat) for lat in (51.5, 0.0, -33.8) for m in range(1, 13)]
    got = values(spark, rows, "m int, lat double", calendar.season(F.col("m"), F.col("lat")))
    assert got == north + north + [opposite[s] for s in north]
    assert values(spark, [(None, 1.0), (1, None)], "m int, lat double", calendar.season(F.col("m"), F.col("lat"))) == [None, None]


@pytest.mark.parametrize(
    "ai, real, found, expected",
    [
        (4.94, 0.0, True, "Deviation: 4.9°C. Excellent Synthetic Match!"),
        (4.95, 0.0, True, "Deviation: 5.0°C. Acceptable variance."),
        (5.0, 0.0, True, "Deviation: 5.0°C. Acceptable variance."),
        (0.0, 11.94, True, "Deviation: 11.9°C. Acceptable variance."),
        (11.95, 0.0, True, "Deviation: 12.0°C. AI deviates heavily from live API."),
        (-6.0, 6.0, True, "Deviation: 12.0°C. AI deviates heavily from live API."),
        (7.0, 7.0, True, "Deviation: 0.0°C. Excellent Synthetic Match!"),
        (7.0, None, True, None),
        (7.0, 1e300, True, None),
        (7.0, None, False, "API 7-day query limit exceeded."),
    ],
)
def test_verdict(spark, ai, real, found, expected):
    gap = rules.deviation(F.col("ai"), F.col("real"))
    assert values(spark, [(ai, real, found)], "ai double, real double, found boolean", rules.verdict(F.col("found"), gap)) == [expected]


def test_alert(spark):
    got = values(spark, [(True,), (False,), (None,)], "x boolean", rules.alert(F.col("x")))
    assert got == ["ALERT ACTIVE", "ALL CLEAR", None]


def test_times(spark):
    moments = [datetime(2024, 2, 29, 0, 0), datetime(2024, 1, 1, 12, 5, 59, 999999), datetime(1969, 12, 31, 23, 59, 1)]
    df = spark.createDataFrame([(m,) for m in moments], "at timestamp_ntz")
    at = F.col("at")
    got = df.select(calendar.to_hour(at), calendar.hour_key(at), calendar.minute_text(at), calendar.weekday_clock(at)).collect()
    for row, m in zip(got, moments):
        assert row[0] == m.replace(minute=0, second=0, microsecond=0)
        assert row[1] == m.strftime("%Y-%m-%dT%H:00")
        assert row[2] == m.strftime("%Y-%m-%dT%H:%M")
        assert row[3] == m.strftime("%A, %I:%M %p")


def test_times_ignore_the_session_zone(spark):
    """02:30 does not exist on that day in that zone; wall-clock times must not move."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS at")
        at = F.col("at")
        row = df.select(
            calendar.hour_key(at), calendar.to_hour(at).cast("string"), F.hour(at), calendar.weekday_clock(at)
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == ("2024-03-10T02:00", "2024-03-10 02:00:00", 2, "Sunday, 02:30 AM")


def test_texts(spark):
    got = values(spark, [(20.0,), (20.5,), (-0.25,), (0.0,), (None,)], "x double", display.number_text(F.col("x")))
    assert got == ["20", "20.5", "-0.25", "0", None]
    got = values(spark, [(20.0,), (None,)], "x double", display.real_temperature(F.col("x")))
    assert got == ["20°", "N/A"]
    got = values(spark, [(7.5,), (None,)], "x double", display.real_wind(F.col("x")))
    assert got == ["7.5 km/h", "--"]
    assert values(spark, [(0.8931,)], "x double", display.percent_text(F.col("x"))) == ["89.3%"]
    assert values(spark, [(9.5678,)], "x double", display.decimals_text(F.col("x"), 4)) == ["9.5678"]
