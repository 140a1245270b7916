"""Files and commands."""

import json
from datetime import datetime

import pytest
from conftest import same_rows
from pyspark.errors import AnalysisException

from wxspark.__main__ import parser
from wxspark.plans import jobs
from wxspark.session import scratch_base, scratch_path
from wxspark.sources import generate, tables
from wxspark.sources.truth_store import TruthStore

ANCHOR = datetime(2026, 3, 6, 9, 11, 7, 518562)


def observed(spark, rows=3_000):
    return generate.observations(spark.range(0, rows, 1, 3), ANCHOR)


def test_csv_keeps_microseconds(spark, tmp_path):
    tables.write_observations_csv(observed(spark), str(tmp_path / "o.csv"))
    assert same_rows(observed(spark), tables.read_observations_csv(spark, str(tmp_path / "o.csv")))
    text = next((tmp_path / "o.csv").glob("part-*")).read_text().splitlines()
    assert text[0].startswith("id,weather_station_id,timestamp,temp_celsius") and ".518562" in text[1]


def test_parquet_by_scale(spark, tmp_path):
    path = str(tmp_path / "o")
    tables.write_observations(observed(spark), path, "million")
    tables.write_observations(observed(spark, 10), path, "tiny")
    assert same_rows(observed(spark), tables.read_observations(spark, path, "million"))
    assert tables.read_observations(spark, path, "tiny").count() == 10


def test_regime_folders(spark, tmp_path):
    rows = generate.regimes(spark.range(100), 100)
    tables.write_regimes(rows, str(tmp_path / "r"))
    assert same_rows(rows, tables.read_regimes(spark, str(tmp_path / "r")))
    sheets = tables.sheet_names(tables.read_regimes(spark, str(tmp_path / "r"))).collect()
    assert {r.sheet for r in sheets} == {"All Data", "Sunny", "Cloudy", "Rain", "Thunderstorm", "Fog"}
    fog = tables.read_regimes(spark, str(tmp_path / "r"), "Fog")
    assert fog.count() == 100
    assert "PartitionFilters: [isnotnull(weather" in fog._jdf.queryExecution().executedPlan().toString()
    tables.write_regimes_csv(rows, str(tmp_path / "c"))
    header = next((tmp_path / "c" / "weather=Fog").glob("part-*")).read_text().splitlines()[0]
    assert header.startswith("row_no,temperature (°C),humidity (%),pressure (hPa)")


def test_table(spark, tmp_path):
    tables.save_table(observed(spark), "wx_test_table", str(tmp_path / "t"))
    assert same_rows(observed(spark), spark.table("wx_test_table"))
    spark.sql("DROP TABLE wx_test_table")


def test_missing_input_fails(spark, tmp_path):
    for read in (tables.read_observations_csv, tables.read_observations):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            read(spark, str(tmp_path / "none"))


def test_malformed_csv_fails(spark, tmp_path):
    tables.write_observations_csv(observed(spark, 10), str(tmp_path / "o.csv"))
    (tmp_path / "o.csv" / "part-bad.csv").write_text("id,weather_station_id,timestamp\n1,x,y\n")
    with pytest.raises(Exception, match="MALFORMED"):
        tables.read_observations_csv(spark, str(tmp_path / "o.csv")).collect()


def test_scratch_is_the_checkpoint_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_base(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_end_to_end(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in ("data", "models", "out", "stream", "progress", "week")}
    tables.write_observations(observed(spark, 20_000), at["data"], "million")
    metrics = jobs.train_models(spark, at["data"], at["models"], cap=10_000, exact_split=True)
    assert {r.metric for r in metrics.collect()} == {"accuracy", "precision", "mae"}

    requests, documents = tmp_path / "requests", tmp_path / "payloads"
    requests.mkdir(), documents.mkdir()
    asked = [
        {"id": 1, "date": "2026-03-06T09:30", "city": "London"},
        {"id": 2, "date": "2026-03-06T09:30", "city": "Sydney"},
        {"id": 3, "date": "soon", "city": "London"},
        {"id": 4, "date": "2026-03-06T09:30", "city": "Paris"},
        {"id": 5, "date": "", "city": "London"},
    ]
    (requests / "a.json").write_text("\n".join(map(json.dumps, asked)))
    hourly = {"time": ["2026-03-06T09:00"], "temperature_2m": [11.5], "relative_humidity_2m": [80], "wind_speed_10m": [12.1], "precipitation": [0.0]}
    document = {"city": "London", "issued": "2026-03-06", "status": 200, "body": json.dumps({"hourly": hourly})}
    (documents / "a.json").write_text(json.dumps(document))

    jobs.verify_requests(spark, str(requests), str(documents), at["models"], at["out"])
    results = spark.read.parquet(at["out"] + "/results")
    got = {r.id: (r.error, r.real_found, r.real_temp_celsius, r.season) for r in results.collect()}
    assert got == {
        1: (None, True, 11.5, "spring"),
        2: (None, False, None, "autumn"),
        3: ("Invalid date format", None, None, None),
        4: ("City not mapped", None, None, None),
    }
    responses = spark.read.json(at["out"] + "/responses")
    assert {r.id for r in responses.collect()} == {1, 2, 3, 4}
    assert json.loads(responses.where("id = 3").first().response) == {"error": "Invalid date format"}

    jobs.verify_landing_requests(
        spark, str(requests), str(documents), at["models"], at["stream"], at["progress"], availableNow=True
    ).awaitTermination()
    assert {r.model_version for r in results.collect()} == {1}
    assert same_rows(results, spark.read.parquet(at["stream"] + "/results").drop("batch_id"))
    assert same_rows(responses, spark.read.json(at["stream"] + "/responses").drop("batch_id"))

    # A second micro-batch merges the document that is new, and only that one.
    (requests / "b.json").write_text(json.dumps({"id": 6, "date": "2026-03-06T09:59", "city": "Sydney"}))
    (documents / "b.json").write_text(json.dumps(document | {"city": "Sydney"}))
    jobs.verify_landing_requests(
        spark, str(requests), str(documents), at["models"], at["stream"], at["progress"], availableNow=True
    ).awaitTermination()
    both = {r.id: r.real_found for r in spark.read.parquet(at["stream"] + "/results").where("error is null").collect()}
    assert both == {1: True, 2: False, 6: True}
    store = TruthStore(spark, at["progress"] + "/truth")
    assert sorted(r.city for r in store.read_all().collect()) == ["London", "Sydney"] and store.versions.current() == 2
    assert [r.city for r in spark.read.parquet(at["progress"] + "/truth/landed/version=2").collect()] == ["Sydney"]

    jobs.forecast(spark, at["models"], datetime(2026, 3, 6, 9), at["week"])
    assert spark.read.parquet(at["week"]).count() == 6 * 168


def test_generate_jobs(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(generate.SCALES, "tiny", (1_000, 4))
    for form, read in (("csv", tables.read_observations_csv), ("parquet", tables.read_observations)):
        out = str(tmp_path / form)
        jobs.generate_observations(spark, "tiny", out, form, ANCHOR)
        back = read(spark, out + "/observations_tiny.csv") if form == "csv" else read(spark, out, "tiny")
        assert same_rows(observed(spark, 1_000), back)
    assert same_rows(jobs.preview_observations(spark, ANCHOR), observed(spark, 5))
    jobs.generate_regimes(spark, str(tmp_path / "regimes"), 50)
    assert tables.read_regimes(spark, str(tmp_path / "regimes")).count() == 250


def test_table_and_scales(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(generate.SCALES, "tiny", (100, 2))
    monkeypatch.setitem(generate.SCALES, "small", (50, 2))
    jobs.generate_observations(spark, "tiny", str(tmp_path), anchor=ANCHOR, table="tiny_observations")
    assert same_rows(spark.table("tiny_observations"), observed(spark, 100))
    spark.sql("DROP TABLE tiny_observations")
    for scale in ("tiny", "small"):
        jobs.generate_observations(spark, scale, str(tmp_path / "p"), "parquet", ANCHOR)
    assert jobs.read_any_observations(spark, str(tmp_path / "p"), "small").count() == 50
    with pytest.raises(ValueError, match="several scales"):
        jobs.read_any_observations(spark, str(tmp_path / "p"))


def test_commands_parse():
    assert parser().parse_args(["generate"]).scale == "million"
    assert parser().parse_args(["generate", "billion", "--anchor", "2024-01-31"]).anchor == datetime(2024, 1, 31)
    assert parser().parse_args(["train", "--observations", "o", "--out", "m"]).cap is None
