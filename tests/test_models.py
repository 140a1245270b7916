"""Forests: scores in the bands that follow from the distributions, and results that repeat."""

import math
from collections import Counter
from datetime import datetime

import pytest
from conftest import plan_of, same_rows
from pyspark.sql import functions as F

from wxspark.constants import TARGETS
from wxspark.plans import timeline, train
from wxspark.sources import generate

ANCHOR = datetime(2024, 1, 31)
EXPECTED_MAE = {
    "temp_celsius": 12 * math.sqrt(2 / math.pi),
    "humidity_percent": 60 / 4,
    "wind_speed_kmh": 30 / 4,
    "precipitation_mm": 0.8 * 2 + 0.2 * 8.2,
}


def observed(spark, rows, partitions=8):
    return generate.observations(spark.range(0, rows, 1, partitions), ANCHOR)


@pytest.fixture(scope="module")
def job(spark):
    return train.train(observed(spark, 60_000))


def assert_in_bands(metrics, tolerance):
    values = {(r.model, r.metric): r.value for r in metrics.collect()}
    assert len(values) == 6
    for target, expected in EXPECTED_MAE.items():
        assert abs(values[target, "mae"] / expected - 1) < tolerance, (target, values)
    assert abs(values["extreme", "accuracy"] - 0.893) < 0.02
    assert 0 <= values["extreme", "precision"] <= 1


def test_scores(job):
    assert_in_bands(job.metrics(), 0.05)


def test_capped_exact_mode(spark):
    job = train.train(observed(spark, 30_000), cap=10_000, exact_split=True)
    assert job.test.count() == 2_000
    assert_in_bands(job.metrics(), 0.08)


def test_forest_parameters(job):
    _, classifier, *regressors = job.model.stages
    assert classifier.getNumTrees == 30 and classifier.getOrDefault("featureSubsetStrategy") == "1"
    assert [r.getNumTrees for r in regressors] == [20] * 4
    assert {r.getOrDefault("featureSubsetStrategy") for r in regressors} == {"all"}
    assert {m.getMaxDepth() for m in (classifier, *regressors)} == {8}
    assert {m.getSeed() for m in (classifier, *regressors)} == {42}


def test_grid_equals_direct_prediction(job):
    direct = job.model.transform(job.test).select("id", train.CLASS_PREDICTION, *map(train.predicted, TARGETS))
    looked_up = train.score(job.test, job.grid)
    assert job.grid.count() == 12 * 31 * 24
    assert same_rows(direct, looked_up.select(*direct.columns))
    assert "SortMergeJoin" not in plan_of(looked_up) and "Exchange hashpartitioning" not in plan_of(looked_up)


def test_same_forests_on_any_layout(spark):
    one, other = (train.train(observed(spark, 3_000, p)) for p in (3, 7))
    assert same_rows(one.grid, other.grid)


def test_reloaded_model_predicts_the_same(spark, job, tmp_path):
    train.save_model(job.model, str(tmp_path / "model"))
    loaded = train.load_model(str(tmp_path / "model"))
    assert same_rows(job.grid, train.prediction_grid(spark, loaded))


def test_cells_against_brute_force(spark):
    rows = train.training_rows(observed(spark, 2_000))
    cells = train.training_cells(rows, replicates=4).collect()
    weights, sums = Counter(), Counter()
    for r in rows.collect():
        weights[r.month, r.day, r.hour, r.extreme] += 1
        for t in TARGETS:
            sums[r.month, r.day, r.hour, r.extreme, t] += round(r[t] * 100)
    got_weights, got_sums = Counter(), Counter()
    for c in cells:
        got_weights[c.month, c.day, c.hour, c.extreme] += c.weight
        for t in TARGETS:
            got_sums[c.month, c.day, c.hour, c.extreme, t] += c[f"{t}_hundredths"]
    assert weights == got_weights and sums == got_sums
    assert max(c.replicate for c in cells) == 3


@pytest.mark.parametrize("rows", [60_000, 500_000, 2_000_000])
def test_replicates_follow_the_rows_of_a_cell(spark, rows):
    """w rows of a cell fall on 32 * (1 - (31 / 32) ** w) replicates on average, whatever the size of the ids."""
    cells = train.training_cells(train.training_rows(observed(spark, rows)))
    keys = [*train.FEATURES]
    per = cells.groupBy(*keys).agg(F.sum("weight").alias("w"), F.count_distinct("replicate").alias("n"))
    r = per.agg(F.avg("n").alias("n"), F.avg(32 * (1 - F.pow(F.lit(31 / 32), "w"))).alias("expected")).first()
    assert abs(r.n / r.expected - 1) < 0.02


def test_a_null_target_fails(spark):
    rows = train.training_rows(observed(spark, 100))
    broken = rows.withColumn("wind_speed_kmh", F.when(F.col("id") != 7, F.col("wind_speed_kmh")))
    with pytest.raises(Exception, match="wind_speed_kmh is null"):
        train.training_cells(broken).collect()


def test_cells_do_not_grow_with_a_hot_hour(spark):
    """A third of the rows in one hour still makes at most two cells per replicate."""
    rows = train.training_rows(observed(spark, 30_000))
    hot = rows.withColumns({c: F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col(c)) for c in train.FEATURES})
    cells = train.training_cells(hot)
    assert cells.where("month = 1 AND day = 1 AND hour = 1").count() <= 2 * train.REPLICATES
    assert cells.agg(F.sum("weight")).first()[0] == 30_000


def test_learns_a_signal(spark):
    """Targets that do depend on time are learned, from weighted cells as from rows."""
    rows = train.training_rows(observed(spark, 20_000))
    signal = rows.withColumns({"temp_celsius": F.col("hour") * 2.0, "extreme": (F.col("hour") >= 12).cast("int")})
    model = train.fit_forests(train.training_cells(signal))
    scored = train.score(signal, train.prediction_grid(spark, model))
    r = scored.agg(
        F.avg(F.abs(F.col("temp_celsius") - F.col(train.predicted("temp_celsius")))).alias("error"),
        F.avg((F.col("extreme") == F.col(train.CLASS_PREDICTION)).cast("int")).alias("accuracy"),
    ).first()
    assert r.error < 0.5 and r.accuracy > 0.99


def test_timeline(spark, job):
    starts = spark.sql("SELECT 'London' AS city, timestamp_ntz'2024-02-27 22:00:00' AS start_at")
    rows = timeline.forecast_timeline(starts, job.grid).orderBy("hour_at").collect()
    assert len(rows) == 168
    assert rows[2].hour_at == datetime(2024, 2, 28) and rows[-1].hour_at == datetime(2024, 3, 5, 21)
    assert all(r.ai_temp_celsius is not None and r.ai_is_extreme_weather is not None for r in rows)
