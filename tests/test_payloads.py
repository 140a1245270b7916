"""Landed forecast documents and the lookup on them."""

import json
from datetime import date, datetime

from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from wxspark.operators import joins
from wxspark.operators.joins import bounded_lookup
from wxspark.sources import payloads


def document(times, temps, hums=None, winds=None, rains=None):
    fill = [1.0] * len(times)
    hourly = {
        "time": times,
        "temperature_2m": temps,
        "relative_humidity_2m": fill if hums is None else hums,
        "wind_speed_10m": fill if winds is None else winds,
        "precipitation": fill if rains is None else rains,
    }
    return json.dumps({"hourly": hourly, "latitude": 1.5})


H5, H6, H7 = "2024-01-08T05:00", "2024-01-08T06:00", "2024-01-08T07:00"
MONDAY, TUESDAY = date(2024, 1, 8), date(2024, 1, 9)


def landed(spark, rows):
    return spark.createDataFrame(rows, "city string, issued date, status int, body string")


def truth_of(spark, rows):
    truth = payloads.ground_truth(payloads.payload_hours(landed(spark, rows)))
    return {(r.city, r.hour_at): r.real_temp_celsius for r in truth.collect()}


def test_first_position_wins(spark):
    body = document([H5, H6, H5], [1.0, 2.0, 3.0])
    assert truth_of(spark, [("London", MONDAY, 200, body)]) == {
        ("London", datetime(2024, 1, 8, 5)): 1.0,
        ("London", datetime(2024, 1, 8, 6)): 2.0,
    }


def test_first_position_wins_even_when_null(spark):
    body = document([H5, H5], [None, 3.0])
    assert truth_of(spark, [("London", MONDAY, 200, body)]) == {("London", datetime(2024, 1, 8, 5)): None}


def test_newest_document_wins(spark):
    rows = [("London", TUESDAY, 200, document([H6], [9.0])), ("London", MONDAY, 200, document([H6, H7], [1.0, 2.0]))]
    assert truth_of(spark, rows) == {
        ("London", datetime(2024, 1, 8, 6)): 9.0,
        ("London", datetime(2024, 1, 8, 7)): 2.0,
    }


def test_undated_document_is_the_oldest(spark):
    rows = [("London", None, 200, document([H5, H6], [3.0, 4.0])), ("London", MONDAY, 200, document([H6], [9.0]))]
    assert truth_of(spark, rows) == {
        ("London", datetime(2024, 1, 8, 5)): 3.0,
        ("London", datetime(2024, 1, 8, 6)): 9.0,
    }


def test_only_full_hours_are_hours(spark):
    times = ["2024-01-08", "2024-01-08T05:30", "2024-01-08 05:00", "2024-01-08T05:00:00", "soon", H5]
    assert truth_of(spark, [("London", MONDAY, 200, document(times, [float(i) for i in range(6)]))]) == {
        ("London", datetime(2024, 1, 8, 5)): 5.0
    }


def test_broken_documents_have_no_hours(spark):
    good = document([H5], [1.0])
    rows = [
        ("A", MONDAY, 503, good),
        ("B", MONDAY, 200, "not json"),
        ("C", MONDAY, 200, None),
        ("D", MONDAY, 200, "{}"),
        ("E", MONDAY, 200, json.dumps({"hourly": {"time": [H5]}})),
        ("F", MONDAY, 200, json.dumps({"hourly": {"temperature_2m": [1.0]}})),
        ("G", MONDAY, None, good),
    ]
    assert truth_of(spark, rows) == {}


def test_short_array_ends_the_hours(spark):
    body = document([H5, H6, H7], [1.0, 2.0, 3.0], winds=[1.0, 2.0])
    got = payloads.payload_hours(landed(spark, [("A", MONDAY, 200, body)])).collect()
    assert [(r.pos, r.time, r.wind_speed_10m) for r in got] == [(0, H5, 1.0), (1, H6, 2.0)]


def test_document_is_parsed_once(spark, tmp_path):
    landed(spark, [("A", MONDAY, 200, document([H5], [1.0]))]).write.parquet(str(tmp_path / "p"))
    hours = payloads.payload_hours(spark.read.parquet(str(tmp_path / "p")))
    assert plan_of(hours).count("from_json(") == 1


def test_truth_is_a_hash_aggregate(spark):
    truth = payloads.ground_truth(payloads.payload_hours(landed(spark, [("A", MONDAY, 200, document([H5], [1.0]))])))
    plan = plan_of(truth)
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def skewed(spark):
    """A third of the rows on one key, and rows without a key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    left = spark.range(0, 3_000, 1, 5).select("id", key.alias("k"))
    right = spark.range(400).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("v"))
    return left, right.union(spark.sql("SELECT 'hot', 777L"))


def test_lookup_plans_agree(spark):
    left, right = skewed(spark)
    broadcast = bounded_lookup(left, right, ["k"], "id")
    apart = bounded_lookup(left, right, ["k"], "id", broadcast_rows=400)
    assert "BroadcastHashJoin" in plan_of(broadcast) and "SortMergeJoin" not in plan_of(broadcast)
    assert "SortMergeJoin" in plan_of(apart)
    assert same_rows(broadcast, apart) and same_rows(broadcast, joins._salted(left, right, ["k"], "id"))
    rows = {r.id: r.v for r in broadcast.collect()}
    assert len(rows) == 3_000 and rows[0] == 777 and rows[7] is None and rows[1] == 1 and rows[499] is None


def test_hot_and_null_keys_are_not_shuffled(spark):
    """Without cold keys nothing is left for the sort-merge join."""
    left, right = skewed(spark)
    joined = bounded_lookup(left.where("k IS NULL OR k = 'hot'"), right, ["k"], "id", broadcast_rows=400)
    assert joined.count() == left.where("k IS NULL OR k = 'hot'").count()
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(_hot" in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        by_task = joined.groupBy(F.spark_partition_id(), "k").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len([r for r in by_task if r.k == "hot"]) == 5 and len([r for r in by_task if r.k is None]) == 5


def test_no_hot_keys(spark):
    left = spark.range(0, 1_000, 1, 3).withColumn("k", F.col("id") % 250)
    right = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert same_rows(bounded_lookup(left, right, ["k"], "id"), bounded_lookup(left, right, ["k"], "id", broadcast_rows=100))


def test_stream_beyond_the_bound(spark, tmp_path):
    left, right = skewed(spark)
    left.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(left.schema).parquet(str(tmp_path / "in"))
    joined = bounded_lookup(stream, right, ["k"], "id", broadcast_rows=400)
    out = str(tmp_path / "out")
    writer = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert same_rows(bounded_lookup(left, right, ["k"], "id"), spark.read.parquet(out))
