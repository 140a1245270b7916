from datetime import datetime

from conftest import plan_of

from wxspark.sources import requests
from wxspark.sources.dims import city_dim

BAD_DATE, BAD_CITY = "Invalid date format", "City not mapped"


def test_parse(spark):
    bodies = spark.createDataFrame(
        [
            (1, '{"date": "2024-01-08T05:00", "city": "London"}'),
            (2, '{"date": "", "city": "London"}'),
            (3, '{"city": "London"}'),
            (4, '{"date": null, "city": null}'),
            (5, "not json"),
            (6, None),
            (7, '{"date": "garbage", "city": "Tokyo", "extra": [1]}'),
        ],
        "id long, body string",
    )
    parsed = requests.parse_requests(bodies)
    got = {r.id: (r.date, r.city) for r in parsed.collect()}
    assert got == {
        1: ("2024-01-08T05:00", "London"),
        3: (None, "London"),
        4: (None, None),
        5: (None, None),
        6: (None, None),
        7: ("garbage", "Tokyo"),
    }
    assert plan_of(parsed).count("json_tuple(") == 1


WRITTEN = {
    "2024-01-31T17:00Z": datetime(2024, 1, 31, 17),
    "2024-01-31T17:00:05+02:00": datetime(2024, 1, 31, 17, 0, 5),
    "20240131T1700": datetime(2024, 1, 31, 17),
    "20240131T170059Z": datetime(2024, 1, 31, 17, 0, 59),
    "2024-01-31 5:00 PM": datetime(2024, 1, 31, 17),
    "31.01.2024 12:30 am": datetime(2024, 1, 31, 0, 30),
    "01-31-2024": datetime(2024, 1, 31),
    "31/01/2024": datetime(2024, 1, 31),
    "02/01/2024": datetime(2024, 2, 1),
    "2024.01.31": datetime(2024, 1, 31),
    "Jan 5, 2024": datetime(2024, 1, 5),
    "5 January 2024 15:00": datetime(2024, 1, 5, 15),
    "January 5th 2024 3pm": datetime(2024, 1, 5, 15),
    "Wed, 31 Jan 2024 17:00:00 GMT": datetime(2024, 1, 31, 17),
    "Wednesday 31 January 2024": datetime(2024, 1, 31),
    "Thurs. Feb 1, 2024 3:05 pm": datetime(2024, 2, 1, 15, 5),
    "Monday, 2024-01-08 05:30": datetime(2024, 1, 8, 5, 30),
    "sun 2024-01-07": datetime(2024, 1, 7),
    "Wednesday": None,
    "March": None,
    "13/13/2024": None,
    "2024-13-01": None,
}


def test_dates_as_people_write_them(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(d,) for d in WRITTEN], "date string")
    assert dict(rows.select("date", requests.parse_date(F.col("date"))).collect()) == WRITTEN


def test_validate(spark):
    rows = [
        (1, "2024-01-08T05:30", "London", datetime(2024, 1, 8, 5, 30), None),
        (2, "2024-01-08", "Dhaka", datetime(2024, 1, 8), None),
        (3, "2024/1/8 05:30", "Dhaka", datetime(2024, 1, 8, 5, 30), None),
        (4, "01/08/2024 05:30", "Dhaka", datetime(2024, 1, 8, 5, 30), None),
        (5, "20240108", "Dhaka", datetime(2024, 1, 8), None),
        (6, "garbage", "Dhaka", None, BAD_DATE),
        (7, "2024-02-30", "Dhaka", None, BAD_DATE),
        (8, None, "Dhaka", None, BAD_DATE),
        (9, "2024-01-08", "Atlantis", datetime(2024, 1, 8), BAD_CITY),
        (10, "2024-01-08", None, datetime(2024, 1, 8), BAD_CITY),
        (11, "garbage", "Atlantis", None, BAD_DATE),
        (12, "2024-01-08", "london", datetime(2024, 1, 8), BAD_CITY),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "id long, date string, city string")
    got = {r.id: (r.requested_at, r.error) for r in requests.validate_requests(df).collect()}
    assert got == {r[0]: (r[3], r[4]) for r in rows}


def test_defaults(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", "Tokyo")], "id long, date string, city string")
    got = {r.id: (r.date, r.city) for r in requests.default_requests(df, datetime(2024, 5, 6, 7, 8, 9)).collect()}
    assert got == {1: ("2024-05-06T07:00", "Dhaka"), 2: ("x", "Tokyo")}


def test_cities(spark):
    shown = {r.city: (r.lat_shown, r.lon_shown) for r in city_dim(spark).collect()}
    assert shown["Tokyo"] == (35.6, 139.6) and shown["London"] == (51.5, -0.1) and shown["Sydney"] == (-33.8, 151.2)
    assert "Scan ExistingRDD" not in plan_of(city_dim(spark))


def test_ids_from_bodies(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"id": 5, "date": "2024-01-01"}\n{"date": "2024-01-01"}\n')
    bodies = spark.read.text(str(tmp_path)).withColumnRenamed("value", "body")
    rows = requests.parse_requests(bodies).collect()
    assert rows[0].id == 5 and rows[1].id is not None
    assert [r.date for r in rows] == ["2024-01-01"] * 2
