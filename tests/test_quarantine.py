"""Damaged lines beside the good ones, and tables in buckets."""

import json
from datetime import datetime

from conftest import plan_of, same_rows

from wxspark.catalog import fixtures as fx
from wxspark.catalog import queries
from wxspark.plans import jobs, train
from wxspark.plans.registry import Registry
from wxspark.sources import generate, payloads, requests, tables

GOOD = "1,2,2024-01-31 00:00:00.000001,20.5,50.0,10.0,0.0,1013.0,false"
DAMAGED = {
    "2,2,2024-01-31 00:00:00,20.5,50.0,10.0": "6 of 9 fields",
    GOOD + ",7": "10 of 9 fields",
    GOOD.replace("20.5", "warm"): "temp_celsius is no double: warm",
    GOOD.replace("1,2,", "x,2,"): "id is no bigint: x",
    GOOD.replace("2024-01-31 00:00:00.000001", "yesterday"): "timestamp is no timestamp_ntz: yesterday",
    GOOD.replace("false", "maybe"): "is_extreme_weather is no boolean: maybe",
    GOOD.replace("1,2,", ",2,"): "id is missing",
    GOOD.replace("1013.0", ""): "pressure_hpa is missing",
}


def test_every_kind_of_damage(spark, tmp_path):
    header = "id,weather_station_id,timestamp,temp_celsius,humidity_percent,wind_speed_kmh,precipitation_mm,pressure_hpa,is_extreme_weather"
    folder = tmp_path / "o.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([header, GOOD, *DAMAGED, GOOD]) + "\n")
    (folder / "b.csv").write_text(f"{header}\n{GOOD}\n")
    (folder / "c.csv").write_text("")
    good, bad = tables.split_observations_csv(spark, str(folder))
    rows = bad.collect()
    assert sorted(r.reason for r in rows) == sorted(DAMAGED.values())
    assert all(r.file.endswith("a.csv") for r in rows)
    by_reason = {r.reason: r.record for r in rows}
    assert all(by_reason[reason] == line for line, reason in DAMAGED.items() if "missing" not in reason)
    assert good.count() == 3 and good.count() + len(rows) == 3 + len(DAMAGED)
    assert good.columns == generate.observations(spark.range(1), datetime(2024, 1, 1)).columns
    assert {r.timestamp for r in good.collect()} == {datetime(2024, 1, 31, 0, 0, 0, 1)}


def test_a_sound_folder_is_read_as_before(spark, tmp_path):
    tables.write_observations_csv(generate.observations(spark.range(500), datetime(2024, 1, 31)), str(tmp_path / "o.csv"))
    good, bad = tables.split_observations_csv(spark, str(tmp_path / "o.csv"))
    assert same_rows(good, tables.read_observations_csv(spark, str(tmp_path / "o.csv"))) and bad.count() == 0


def test_damaged_request_lines(spark, tmp_path):
    lines = {
        '{"id": 1, "date": "2024-01-08", "city": "London"}': None,
        '{"date": 5}': None,
        "{}": None,
        '{"id": 1': "no JSON",
        "hello": "no JSON",
        "[1, 2]": "no JSON object but array",
        '"text"': "no JSON object but string",
        "   ": "empty line",
    }
    (tmp_path / "r.json").write_text("\n".join(lines))
    read = requests.read_bodies(spark, str(tmp_path))
    bad = {r.body: r.reason for r in requests.damaged_bodies(read).collect()}
    assert bad == {line: reason for line, reason in lines.items() if reason}
    assert {r.body for r in requests.sound_bodies(read).collect()} == {line for line, reason in lines.items() if not reason}


def test_null_bodies_are_damaged(spark):
    read = spark.createDataFrame([(None, "f")], "body string, file string")
    assert requests.sound_bodies(read).count() + requests.damaged_bodies(read).count() == 1


def test_jobs_write_the_quarantine(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in ("requests", "payloads", "models", "out", "stream", "cp")}
    for n in ("requests", "payloads"):
        (tmp_path / n).mkdir()
    asked = [json.dumps({"id": 1, "date": "2024-01-08", "city": "London"}), "cut {", json.dumps({"id": 2}), ""]
    (tmp_path / "requests" / "r.json").write_text("\n".join(asked) + "\n")
    (tmp_path / "payloads" / "p.json").write_text('{"city": "London", "status": 204}')
    Registry(spark, at["models"]).publish(train.train(generate.observations(spark.range(1_000), datetime(2024, 1, 31))))
    now = datetime(2024, 1, 8, 7, 20)
    jobs.verify_requests(spark, at["requests"], at["payloads"], at["models"], at["out"], now)
    jobs.verify_landing_requests(
        spark, at["requests"], at["payloads"], at["models"], at["stream"], at["cp"], fill_defaults=True, availableNow=True
    ).awaitTermination()
    for out in (at["out"], at["stream"]):
        bad = spark.read.parquet(f"{out}/quarantine").collect()
        assert sorted(r.reason for r in bad) == ["empty line", "no JSON"]
        assert all(r.file.endswith("r.json") for r in bad)
        results = {r.id: r for r in spark.read.parquet(f"{out}/results").collect()}
        assert len(results) + len(bad) == len(asked)
        # an untouched form asks for the current hour and the first city
        assert results[2].city == "Dhaka" and results[2].error is None and results[1].city == "London"
    assert spark.read.parquet(f"{at['out']}/results").where("id = 2").first().hour_key == "2024-01-08T07:00"


def test_a_table_in_buckets_is_not_shuffled(spark, sf_dir):
    found = queries.ground_truth_lookup_bucketed(spark, sf_dir)
    assert same_rows(found, queries.ground_truth_lookup(spark, sf_dir))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(queries.ground_truth_lookup_bucketed(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    merge = next(part for part in plan.split("SortMergeJoin")[1:])
    truth_side = merge[merge.index("Sort [", merge.index("Sort [") + 1) :] if merge.count("Sort [") > 1 else merge
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(city") == 1, plan
    assert "Exchange" not in truth_side or "Bucketed: true" in truth_side


def test_truth_beyond_the_bound_is_a_bucketed_table(spark, sf_dir, tmp_path):
    fx.payloads(spark, sf_dir).write.json(str(tmp_path / "p"))
    small = jobs.land_truth(spark, str(tmp_path / "p"), str(tmp_path / "t-1"))
    large = jobs.land_truth(spark, str(tmp_path / "p"), str(tmp_path / "t-2"), broadcast_rows=10)
    assert same_rows(small, large)
    assert same_rows(small, payloads.ground_truth(payloads.payload_hours(fx.payloads(spark, sf_dir))))
    assert "Bucketed: true" in plan_of(large.groupBy("city", "hour_at").count()) and "Exchange" not in plan_of(large.groupBy("city", "hour_at").count())
