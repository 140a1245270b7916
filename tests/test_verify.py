"""The verify plan, in batch and as a stream."""

import json
from datetime import date

import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from wxspark.catalog import fixtures as fx
from wxspark.catalog.queries import trained
from wxspark.plans import train, verify
from wxspark.sources import payloads
from wxspark.streaming.verify_stream import verify_stream, verify_stream_refreshed


@pytest.fixture(scope="module")
def truth(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("truth") / "t")
    payloads.ground_truth(payloads.payload_hours(fx.payloads(spark, sf_dir))).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def predict(spark, sf_dir):
    return train.model_predictions(trained(spark, sf_dir).grid)


def test_requests_are_not_shuffled(spark, sf_dir, predict, truth):
    plan = plan_of(verify.verify(fx.bodies(spark, sf_dir), predict, truth))
    assert plan.count("BroadcastHashJoin") == 3
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert plan.count("json_tuple(") == 1


def test_only_needed_columns_are_read(spark, sf_dir, predict, truth):
    plan = plan_of(verify.verify(fx.bodies(spark, sf_dir), predict, truth))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan


def test_every_request_is_answered_once(spark, sf_dir, predict, truth):
    results = verify.verify(fx.bodies(spark, sf_dir), predict, truth).cache()
    kept = fx.requests_of(fx.events(spark, sf_dir)).where("date IS NULL OR date <> ''")
    assert same_rows(results.select("id"), kept.select("id"))
    assert verify.accepted(results).count() + verify.rejected(results).count() == results.count()
    assert verify.accepted(results).where("ai_temp_celsius IS NULL OR real_found IS NULL OR season IS NULL").isEmpty()
    assert verify.rejected(results).where("ai_temp_celsius IS NOT NULL OR real_found IS NOT NULL OR alert IS NOT NULL").isEmpty()
    results.unpersist()


@pytest.mark.parametrize("start", [verify_stream, verify_stream_refreshed])
def test_stream_equals_batch(spark, sf_dir, predict, truth, tmp_path, start):
    given = truth if start is verify_stream else (lambda batch: truth)
    out = str(tmp_path / "out")
    query = start(fx.body_stream(spark, sf_dir), predict, given, out, str(tmp_path / "progress"), availableNow=True)
    query.awaitTermination()
    batch = verify.verify(fx.bodies(spark, sf_dir), predict, truth)
    assert same_rows(batch, spark.read.parquet(out))


def test_stream_resumes_where_it_stopped(spark, sf_dir, predict, truth, tmp_path):
    """Files that land between two runs are verified once, and nothing is verified again."""
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    bodies = fx.bodies(spark, sf_dir)
    parts = [bodies.where(F.col("id") % 2 == half) for half in (0, 1)]
    for part in parts:
        part.coalesce(2).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(bodies.schema).parquet(landing)
        verify_stream(stream, predict, truth, out, progress, availableNow=True).awaitTermination()
    assert same_rows(verify.verify(bodies, predict, truth), spark.read.parquet(out))


def test_stream_over_a_folder_of_events(spark, sf_dir, tmp_path):
    fx.events(spark, sf_dir).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    out = str(tmp_path / "out")
    writer = fx.body_stream(spark, str(tmp_path)).writeStream.format("parquet").option("path", out)
    writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert same_rows(fx.bodies(spark, sf_dir), spark.read.parquet(out))


def test_refreshed_truth_is_seen_by_the_next_batch(spark, predict, tmp_path):
    landing, out, progress = (str(tmp_path / n) for n in ("landing", "out", "progress"))
    schema = "city string, hour_at timestamp_ntz, real_temp_celsius double, real_humidity_percent double, real_wind_speed_kmh double, real_precipitation_mm double, real_found boolean"
    known = []

    def read_truth(_batch):
        return spark.createDataFrame(known, schema)

    def request(key):
        body = json.dumps({"date": "2024-01-08T05:10", "city": "London"})
        spark.createDataFrame([(key, body)], "id long, body string").write.mode("append").parquet(landing)
        stream = spark.readStream.schema("id long, body string").parquet(landing)
        verify_stream_refreshed(stream, predict, read_truth, out, progress, availableNow=True).awaitTermination()

    request(1)
    hour = spark.sql("SELECT timestamp_ntz'2024-01-08 05:00:00'").first()[0]
    known.append(("London", hour, 1.0, 2.0, 3.0, 4.0, True))
    request(2)
    got = {r.id: (r.real_found, r.real_temp_celsius) for r in spark.read.parquet(out).collect()}
    assert got == {1: (False, None), 2: (True, 1.0)}


def test_response_texts(spark, sf_dir, predict, truth):
    results = verify.verify(fx.bodies(spark, sf_dir), predict, truth)
    texts = {r.id: json.loads(r.response) for r in verify.result_json(results).collect()}
    for r in results.collect():
        answer = texts[r.id]
        if r.error:
            assert answer == {"error": r.error}
        else:
            assert list(answer) == ["ai", "real"] and len(answer["ai"]) == 5
            assert answer["ai"]["temp_celsius"] == r.ai_temp_celsius
            assert set(answer["real"]) == ({"found"} if not r.real_found else {"found", "temp_celsius", "humidity_percent", "wind_speed_kmh", "precipitation_mm"})


def test_fixture_covers_the_cases(spark):
    """The documents made from the events hold a repeated hour, a null value, a failed answer and a silent city."""
    documents = fx.payloads(spark, "/root/testdata/sf0.01").cache()
    hours = payloads.payload_hours(documents)
    assert hours.groupBy("city", "time").count().where("count > 1").count() > 0
    assert hours.where("temperature_2m IS NULL").count() > 0
    assert documents.where("status = 503").count() == 1
    assert {r.status for r in documents.where(F.col("city") == fx.SILENT_CITY).select("status").collect()} == {404}
    assert documents.where("issued IS NULL AND status = 200").count() > 0
    assert hours.agg(F.min("issued")).first()[0] == date(2024, 1, 8)
    dated = hours.where("issued IS NOT NULL")
    assert dated.groupBy("city", "issued").count().agg(F.max("count")).first()[0] <= 169
    documents.unpersist()
