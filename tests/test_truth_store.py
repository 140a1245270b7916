"""Versions, and ground truth that is merged as forecasts land."""

import itertools
import json
import random
from datetime import date, datetime, timedelta

import pytest
from conftest import same_rows
from pyspark.sql import functions as F
from test_payloads import document, landed

from wxspark.plans import jobs
from wxspark.sources import payloads, truth_store
from wxspark.sources.truth_store import TruthStore
from wxspark.sources.versions import Versions


def test_only_committed_versions_count(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions.current() is None and versions.next() == 1
    versions.commit(1)
    versions.commit(2)
    assert versions.numbers() == [1, 2] and versions.next() == 3
    with pytest.raises(RuntimeError, match="another writer"):
        Versions(spark, str(tmp_path / "v")).commit(2)


def drawn_documents(rng, n):
    """Documents of three cities that overlap, repeat hours, carry equal issue dates, none, or an error."""
    out = []
    for _ in range(n):
        start = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(96))
        times = [(start + timedelta(hours=rng.randrange(30))).strftime("%Y-%m-%dT%H:00") for _ in range(rng.randrange(1, 25))]
        temps = [rng.choice([None, rng.randrange(400) / 10]) for _ in times]
        issued = rng.choice([None, date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)])
        body = rng.choice([document(times, temps), document(times, temps), document(times, temps), "broken"])
        out.append((rng.choice(["A", "B", "C"]), issued, rng.choice([200, 200, 200, 503]), body))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_equals_one_aggregate(spark, tmp_path, seed):
    rng = random.Random(seed)
    documents = drawn_documents(rng, 40)
    whole = payloads.ground_truth(payloads.payload_hours(landed(spark, documents)))
    store = TruthStore(spark, str(tmp_path / "s"))
    order = documents + rng.sample(documents, 10)  # some land twice
    rng.shuffle(order)
    for start in range(0, len(order), 13):
        store.merge(payloads.payload_hours(landed(spark, order[start : start + 13])))
    assert same_rows(whole, store.read_all())
    per_hour = store.read_all().groupBy("city", "hour_at").count().where("count > 1")
    assert per_hour.isEmpty()


def test_equal_dates_in_any_order(spark, tmp_path):
    """Documents of one issue date that differ: the same one counts whichever lands first, and it counts whole."""
    day = date(2024, 1, 8)
    three = [("A", day, 200, document(["2024-01-08T05:00"], [t], [h])) for t, h in ((1.0, 30.0), (2.0, 20.0), (3.0, 10.0))]
    found = set()
    for k, order in enumerate(itertools.permutations(three)):
        store = TruthStore(spark, str(tmp_path / str(k)))
        for one in order:
            store.merge(payloads.payload_hours(landed(spark, [one])))
        r = store.read_all().first()
        found.add((r.real_temp_celsius, r.real_humidity_percent))
    assert len(found) == 1 and found < {(1.0, 30.0), (2.0, 20.0), (3.0, 10.0)}


def weekly(spark, weeks):
    rows = []
    for w in range(weeks):
        start = datetime(2020, 1, 1) + timedelta(weeks=w)
        times = [(start + timedelta(hours=h)).strftime("%Y-%m-%dT%H:00") for h in range(168)]
        rows.append(("London", start.date(), 200, document(times, [float(w)] * 168)))
    return landed(spark, rows)


@pytest.mark.parametrize("most", [1_000, 1])
def test_two_far_days_open_two_folders(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(truth_store, "MOST_DAYS", most)  # beyond it, folders are listed and joined
    store = TruthStore(spark, str(tmp_path / "s"))
    store.merge(payloads.payload_hours(weekly(spark, 12)))
    store.merge(payloads.payload_hours(weekly(spark, 1)))  # rewrites its own week only
    days = [date(2020, 1, 2), date(2020, 3, 20)]
    asked = spark.createDataFrame([(d,) for d in days] * 50 + [(date(1999, 1, 1),)], "day date")
    got = store.read(asked)
    assert got.count() == 48
    assert {r.day for r in got.select(F.col("hour_at").cast("date").alias("day")).distinct().collect()} == set(days)
    if most > 1:
        opened = {f.split("/hours/")[1].rsplit("/", 1)[0] for f in got.inputFiles()}
        assert opened == {"version=2/day=2020-01-02", "version=1/day=2020-03-20"}
    assert store.read_all().count() == 12 * 168
    assert len({r.version for r in store.days().collect()}) == 2


def test_nothing_landed(spark, tmp_path):
    store = TruthStore(spark, str(tmp_path / "s"))
    assert store.merge(payloads.payload_hours(landed(spark, [("A", None, 503, "x")]))) is None
    assert store.read_all().count() == 0 and store.versions.current() is None
    assert store.read_all().columns == payloads.ground_truth(payloads.payload_hours(landed(spark, []))).columns


def test_a_reader_keeps_its_version(spark, tmp_path):
    store = TruthStore(spark, str(tmp_path / "s"))
    store.merge(payloads.payload_hours(landed(spark, [("A", date(2024, 1, 8), 200, document(["2024-01-08T05:00"], [1.0]))])))
    before = store.read_all()
    store.merge(payloads.payload_hours(landed(spark, [("A", date(2024, 1, 9), 200, document(["2024-01-08T05:00"], [2.0]))])))
    assert before.first().real_temp_celsius == 1.0 and store.read_all().first().real_temp_celsius == 2.0


def test_an_uncommitted_version_is_not_read(spark, tmp_path, monkeypatch):
    store = TruthStore(spark, str(tmp_path / "s"))
    hours = payloads.payload_hours(landed(spark, [("A", date(2024, 1, 8), 200, document(["2024-01-08T05:00"], [1.0]))]))
    monkeypatch.setattr(Versions, "commit", lambda self, n: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        store.merge(hours)
    assert store.read_all().count() == 0
    monkeypatch.undo()
    assert store.merge(hours) == 1 and store.read_all().count() == 1


def test_landing_files_are_merged_once(spark, tmp_path):
    folder, at = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()

    def land(name, city, temp):
        body = document(["2024-01-08T05:00"], [temp])
        (folder / name).write_text(json.dumps({"city": city, "issued": "2024-01-08", "status": 200, "body": body}))
        return jobs.land_new_hours(spark, str(folder), at)

    assert land("a.json", "London", 1.0).read_all().count() == 1
    store = land("b.json", "Tokyo", 2.0)
    assert {r.city for r in store.read_all().collect()} == {"London", "Tokyo"}
    assert spark.read.parquet(f"{at}/landed/version=2").count() == 1  # the second call read the second file only
    assert jobs.land_new_hours(spark, str(folder), at).versions.current() == 2
