"""Generators: repeatable on any partitioning, within bounds, with the right distribution."""

import math
from datetime import datetime

import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from wxspark.constants import ATTRIBUTES, REGIMES, SCALES
from wxspark.functions.draws import fixed, uniform
from wxspark.operators.units import rename_units
from wxspark.schemas import OBSERVATION
from wxspark.sources import generate
from wxspark.sources.dims import regime_dim

ANCHOR = datetime(2024, 1, 31)
ROWS = 200_000


@pytest.mark.parametrize("partitions", [3, 8])
def test_same_rows_on_any_partitioning(spark, partitions):
    def both(p):
        ids = spark.range(0, 2_000, 1, p)
        return generate.observations(ids, ANCHOR), generate.regimes(ids, 2_000)

    for one, other in zip(both(1), both(partitions)):
        assert same_rows(one, other)


def test_schema_and_no_shuffle(spark):
    df = generate.observations(generate.scale_ids(spark, "million"))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in OBSERVATION]
    assert df.rdd.getNumPartitions() == SCALES["million"][1]
    assert "Exchange" not in plan_of(df)
    assert "Exchange" not in plan_of(generate.regimes(generate.id_range(spark, 10, 2), 10))


def test_scale_presets(spark):
    sizes = {name: generate.scale_ids(spark, name) for name in ("million", "half-billion", "billion", "other")}
    # A range is counted from its bounds.
    assert {n: (d.count() if n in ("million", "other") else None) for n, d in sizes.items()} == {
        "million": 500_000, "half-billion": None, "billion": None, "other": 1_000_000,
    }
    assert {n: d.rdd.getNumPartitions() for n, d in sizes.items()} == {
        "million": 10, "half-billion": 2_000, "billion": 10_000, "other": 20,
    }


def test_distribution(spark):
    df = generate.observations(spark.range(ROWS), ANCHOR)
    r = df.agg(
        F.avg("temp_celsius").alias("t"), F.stddev("temp_celsius").alias("ts"),
        F.avg("pressure_hpa").alias("p"), F.stddev("pressure_hpa").alias("ps"),
        F.min("humidity_percent").alias("h0"), F.max("humidity_percent").alias("h1"), F.avg("humidity_percent").alias("h"),
        F.min("wind_speed_kmh").alias("w0"), F.max("wind_speed_kmh").alias("w1"),
        F.avg((F.col("precipitation_mm") > 0).cast("int")).alias("wet"), F.max("precipitation_mm").alias("r1"),
        F.avg(F.when(F.col("precipitation_mm") > 0, F.col("precipitation_mm"))).alias("r"),
        F.min("weather_station_id").alias("s0"), F.max("weather_station_id").alias("s1"),
        F.avg(F.col("is_extreme_weather").cast("int")).alias("x"),
        F.corr("temp_celsius", "humidity_percent").alias("c1"), F.corr("precipitation_mm", "wind_speed_kmh").alias("c2"),
    ).first()
    assert abs(r.t - 25) < 0.1 and abs(r.ts - 12) < 0.1
    assert abs(r.p - 1013) < 0.1 and abs(r.ps - 10) < 0.1
    assert 40 <= r.h0 < 40.1 and 99.9 < r.h1 <= 100 and abs(r.h - 70) < 0.2
    assert 5 <= r.w0 < 5.1 and 34.9 < r.w1 <= 35
    assert abs(r.wet - 0.2) < 0.005 and 19.9 < r.r1 <= 20 and abs(r.r - 10) < 0.1
    assert r.s0 == 0 and r.s1 == 9_999
    tail = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    assert abs(r.x - tail(1.25) - tail(35 / 12)) < 0.004
    assert abs(r.c1) < 0.01 and abs(r.c2) < 0.01


def test_timestamps_step_one_minute_backwards(spark):
    rows = generate.observations(spark.range(0, 3, 1, 1), ANCHOR).orderBy("id").collect()
    assert [r.timestamp for r in rows] == [datetime(2024, 1, 31), datetime(2024, 1, 30, 23, 59), datetime(2024, 1, 30, 23, 58)]


def test_anchor_defaults_to_one_moment(spark):
    r = generate.observations(spark.range(100)).agg(F.max(F.col("timestamp") + F.col("id") * F.expr("INTERVAL '1' MINUTE")).alias("a"), F.min(F.col("timestamp") + F.col("id") * F.expr("INTERVAL '1' MINUTE")).alias("b")).first()
    assert r.a == r.b


def test_regimes_within_bounds(spark):
    n = 5_000
    df = generate.regimes(spark.range(n), n)
    stats = df.groupBy("weather").agg(
        F.count("*").alias("n"), F.min("row_no").alias("first"), F.max("row_no").alias("last"), F.countDistinct("row_no").alias("ids"),
        *[f(a).alias(f"{a}_{name}") for a in ATTRIBUTES for f, name in ((F.min, "min"), (F.max, "max"))],
    )
    for r in stats.collect():
        number = list(REGIMES).index(r.weather)
        assert (r.n, r.first, r.last, r.ids) == (n, number * n, (number + 1) * n - 1, n)
        for a, (lo, hi) in zip(ATTRIBUTES, REGIMES[r.weather]):
            assert lo <= r[f"{a}_min"] and r[f"{a}_max"] <= hi
            if hi > lo:
                assert r[f"{a}_max"] - r[f"{a}_min"] > 0.9 * (hi - lo)
    assert regime_dim(spark).count() == len(REGIMES)


def test_headers(spark):
    df = rename_units(generate.regimes(spark.range(1), 1))
    assert df.columns == [
        "row_no", "temperature (°C)", "humidity (%)", "pressure (hPa)", "wind_speed (km/h)", "precipitation (mm)",
        "cloud_cover (%)", "visibility (km)", "weather",
    ]


def test_draws(spark):
    r = (
        spark.range(ROWS)
        .select(uniform(F.col("id"), 5).alias("u"), uniform(F.col("id"), 6).alias("v"))
        .agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("u").alias("m"), F.corr("u", "v").alias("c"))
        .first()
    )
    assert 0 <= r.lo < 1e-4 and 1 - 1e-4 < r.hi < 1 and abs(r.m - 0.5) < 0.003 and abs(r.c) < 0.01


def test_fixed_has_no_negative_zero(spark):
    df = spark.createDataFrame([(-0.001,), (1.005,), (-2.345678,)], "x double")
    assert [str(r[0]) for r in df.select(fixed(F.col("x"))).collect()] == ["0.0", "1.0", "-2.35"]
