"""Requests that wait for their hour, over restarts: late, repeated and never-landing forecasts."""

import json
import os
from collections import Counter
from datetime import datetime, timezone

import pytest
from conftest import same_rows
from pyspark.sql import functions as F
from test_payloads import document

from wxspark.catalog import fixtures as fx
from wxspark.plans import jobs, verify
from wxspark.sources import payloads, requests

BEGIN = datetime(2024, 6, 1, tzinfo=timezone.utc).timestamp()
MINUTE = 60


class Landing:
    """Folders into which files land at given minutes, and the two streams over them, started anew each time."""

    def __init__(self, spark, tmp_path):
        self.spark, self.at = spark, {n: str(tmp_path / n) for n in ("requests", "payloads", "out", "cp", "late")}
        for n in ("requests", "payloads"):
            os.mkdir(self.at[n])
        self.files = 0

    def _put(self, folder, lines, minute):
        self.files += 1
        path = f"{self.at[folder]}/f{self.files}.json"
        with open(path, "w") as out:
            out.write("\n".join(map(json.dumps, lines)))
        os.utime(path, (BEGIN + minute * MINUTE,) * 2)

    def ask(self, minute, *asked):
        """Requests (id, hour of the day, city) that land and are seen at a minute."""
        lines = [{"id": i, "date": f"2024-01-08T{hour:02d}:30", "city": city} for i, hour, city in asked]
        self._put("requests", lines or [{"id": -1, "date": ""}], minute)
        self.receive(minute)

    def receive(self, minute):
        clock = F.timestamp_seconds(F.lit(BEGIN + minute * MINUTE))
        jobs.verify_landing_requests(
            self.spark, self.at["requests"], self.at["payloads"], "", self.at["out"], self.at["cp"],
            wait=True, clock=clock, predict=fx.drawn_predictions, availableNow=True,
        ).awaitTermination()

    def land(self, minute, city=None, hours=(), temp=1.0, issued="2024-01-08"):
        times = [f"2024-01-08T{h:02d}:00" for h in hours]
        body = document(times, [temp] * len(times))
        self._put("payloads", [{"city": city, "issued": issued, "status": 200 if city else 204, "body": body}], minute)

    def answer(self):
        jobs.verify_waiting_requests(
            self.spark, self.at["payloads"], "", self.at["out"], self.at["late"], "60 minutes", "10 minutes",
            predict=fx.drawn_predictions, availableNow=True,
        ).awaitTermination()

    def results(self, name):
        path = f"{self.at['out']}/{name}"
        return self.spark.read.parquet(path).drop("batch_id") if os.path.exists(path) else None

    def found(self, name):
        rows = self.results(name)
        return Counter((r.id, r.real_found, r.real_temp_celsius) for r in rows.collect()) if rows is not None else Counter()


@pytest.fixture
def landing(spark, tmp_path):
    """With two partitions, as each has a state of its own in every run of a stream."""
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield Landing(spark, tmp_path)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_late_repeated_and_never_landing(spark, landing):
    landing.land(0, "London", [5])
    landing.ask(0, (1, 5, "London"), (2, 6, "London"), (3, 7, "London"), (4, 8, "Tokyo"), (5, 5, "Paris"), (6, 9, "London"))
    assert landing.found("results") == {(1, True, 1.0): 1, (5, None, None): 1}  # known, and rejected: answered at once
    landing.land(20, "London", [6], 2.0)  # lands in time
    landing.answer()
    assert landing.found("late_results") == {(2, True, 2.0): 1}

    landing.land(25, "London", [6, 7], 3.0, "2024-01-09")  # repeats an hour that was answered, brings another
    landing.land(26, "London", [7], 4.0, "2024-01-09")
    landing.answer()
    late = landing.found("late_results")
    assert late.total() == 2 and set(late) - {(2, True, 2.0)} <= {(3, True, 3.0), (3, True, 4.0)}

    landing.land(58, "London", [6], 9.0, "2024-01-10")  # the same hour once more, long after
    landing.ask(100)  # nothing to wait for, but the time goes on
    landing.land(100)
    landing.answer()
    late += Counter({(4, False, None): 1, (6, False, None): 1})
    assert landing.found("late_results") == late

    landing.land(101, "London", [9], 5.0)  # too late for request 6
    landing.ask(200), landing.land(200)
    landing.answer()
    assert landing.found("late_results") == late
    assert {r.id for r in spark.read.json(f"{landing.at['out']}/late_responses").collect()} == {2, 3, 4, 6}


def test_all_that_lands_in_time_gives_the_batch_plan(spark, landing):
    asked = [(i, i % 24, city) for i, city in enumerate(["London", "Tokyo", "Dhaka", "Sydney", "Mumbai"] * 12)]
    landing.ask(0, *asked)
    for k, city in enumerate(["London", "Tokyo", "Dhaka"]):
        landing.land(5 + 10 * k, city, range(0, 24, 2), 10.0 + k)
        if k == 1:
            landing.answer()
    landing.ask(300), landing.land(300)
    landing.answer()
    bodies = requests.sound_bodies(requests.read_bodies(spark, landing.at["requests"]))
    truth = payloads.ground_truth(payloads.payload_hours(payloads.read_payloads(spark, landing.at["payloads"])))
    batch = verify.verify(bodies, fx.drawn_predictions, truth)
    got = landing.results("results").unionByName(landing.results("late_results"))
    assert same_rows(batch, got)
    assert {True, False} == {r.real_found for r in got.select("real_found").distinct().collect()}


def test_equal_requests_are_answered_as_often(landing):
    landing.ask(0, (7, 5, "London"), (7, 5, "London"), (7, 5, "London"), (8, 5, "London"))
    landing.land(10, "London", [5])
    landing.answer()
    assert landing.found("late_results") == {(7, True, 1.0): 3, (8, True, 1.0): 1}


def test_a_batch_that_is_run_again(landing, monkeypatch):
    """After it has put requests into waiting it fails; meanwhile their hour lands. They are answered once."""
    write, calls = jobs._write_answers, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("executor lost")
        write(*args)

    monkeypatch.setattr(jobs, "_write_answers", failing)
    with pytest.raises(Exception, match="executor lost"):
        landing.ask(0, (1, 5, "London"), (2, 6, "Paris"))
    landing.land(10, "London", [5], 2.0)
    landing.receive(12)
    assert landing.found("results") == {(2, None, None): 1}
    landing.answer()
    assert landing.found("late_results") == {(1, True, 2.0): 1}


def test_a_batch_of_answers_that_is_run_again(landing, monkeypatch):
    landing.ask(0, (1, 5, "London"), (2, 6, "London"))
    landing.land(10, "London", [5, 6])
    write, calls = jobs._write_answers, []

    def failing(*args):
        write(*args)
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("driver lost")

    monkeypatch.setattr(jobs, "_write_answers", failing)
    with pytest.raises(Exception, match="driver lost"):
        landing.answer()
    landing.answer()
    assert landing.found("late_results") == {(1, True, 1.0): 1, (2, True, 1.0): 1}


def test_a_hot_hour(landing):
    landing.ask(0, *[(i, 5, "London") for i in range(300)])
    landing.land(10, "London", [5])
    landing.land(11, "London", [5], 2.0, "2024-01-09")
    landing.answer()
    assert sorted(i for i, found, _ in landing.found("late_results").elements() if found) == list(range(300))
