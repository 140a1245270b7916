"""Published models by version, sums kept over appended observations, and the bootstrap of rows."""

import json
from datetime import datetime

import pytest
from conftest import same_rows
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from wxspark.constants import FEATURES, REGRESSOR_TREES, TARGETS
from wxspark.plans import jobs, train
from wxspark.plans.cell_store import CellStore
from wxspark.plans.registry import Registry
from wxspark.sources import generate, tables

ANCHOR = datetime(2024, 1, 31)


def observed(spark, first, last, temp=None):
    rows = generate.observations(spark.range(first, last, 1, 3), ANCHOR)
    return rows if temp is None else rows.withColumn("temp_celsius", F.lit(float(temp)))


def test_no_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no model"):
        Registry(spark, str(tmp_path / "m")).grid()


def test_a_version_that_was_not_finished_is_not_current(spark, tmp_path, monkeypatch):
    registry = Registry(spark, str(tmp_path / "m"))
    job = train.train(observed(spark, 0, 2_000, 10))
    assert registry.publish(job) == 1
    monkeypatch.setattr(train.Trained, "metrics", lambda self: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        registry.publish(job)
    assert registry.current() == 1 and registry.grid().count() == train.CELLS
    monkeypatch.undo()
    assert registry.publish(job) == 2
    assert same_rows(registry.grid(1), registry.grid(2)) and same_rows(registry.metrics(), job.metrics())
    assert same_rows(train.prediction_grid(spark, registry.model()), registry.grid())


def test_training_while_a_stream_runs(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in ("obs1", "obs2", "models", "requests", "payloads", "out", "cp")}
    for n, temp in ((1, 10), (2, 30)):
        tables.write_observations(observed(spark, 0, 3_000, temp), at[f"obs{n}"], "million")
    for n in ("requests", "payloads"):
        (tmp_path / n).mkdir()
    (tmp_path / "payloads" / "a.json").write_text('{"city": "London", "status": 204}')
    jobs.train_models(spark, at["obs1"], at["models"])
    query = jobs.verify_landing_requests(
        spark, at["requests"], at["payloads"], at["models"], at["out"], at["cp"], processingTime="0 seconds"
    )
    try:
        for key in (1, 2):
            (tmp_path / "requests" / f"r{key}.json").write_text(json.dumps({"id": key, "date": "2024-01-08T05:10", "city": "London"}))
            query.processAllAvailable()
            if key == 1:
                jobs.train_models(spark, at["obs2"], at["models"])
    finally:
        query.stop()
    got = {r.id: (r.model_version, r.ai_temp_celsius) for r in spark.read.parquet(at["out"] + "/results").collect()}
    assert got == {1: (1, 10.0), 2: (2, 30.0)}


def test_training_on_appended_files_equals_training_on_all(spark, tmp_path):
    path, store_path = str(tmp_path / "obs"), str(tmp_path / "store")
    store = CellStore(spark, store_path)
    for n, (first, last) in enumerate(((0, 4_000), (4_000, 4_500), (4_500, 9_000)), 1):
        observed(spark, first, last).write.mode("append").parquet(path)
        assert store.take_in(path) == n
        assert store.take_in(path) == n  # nothing new
    whole = train.train(observed(spark, 0, 9_000))
    added = CellStore(spark, store_path).train()
    assert same_rows(train.training_cells(train.training_rows(observed(spark, 0, 9_000)).join(whole.test.select("id"), "id", "left_anti")), store.cells())
    assert same_rows(whole.grid, added.grid)
    scores = [{(r.model, r.metric): r.value for r in job.metrics().collect()} for job in (whole, added)]
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)  # sums of doubles depend on the order of the rows


def test_each_training_reads_new_files_only(spark, tmp_path):
    path = str(tmp_path / "obs")
    store = CellStore(spark, str(tmp_path / "store"))
    observed(spark, 0, 3_000).write.parquet(path)
    store.take_in(path)
    cells = store.cells().agg(F.sum("weight")).first()[0]
    for file in (tmp_path / "obs").glob("part-*"):
        file.unlink()  # what was taken in is not asked for again
    observed(spark, 3_000, 3_300).write.mode("append").parquet(path)
    store.take_in(path)
    assert store.cells().agg(F.sum("weight")).first()[0] + store.test_rows().count() == 3_300
    assert store.cells().agg(F.sum("weight")).first()[0] > cells


def test_a_batch_is_not_counted_twice(spark, tmp_path):
    store = CellStore(spark, str(tmp_path / "store"))
    store._add(observed(spark, 0, 500), 0)
    before = store.cells().collect()
    store._add(observed(spark, 0, 500), 0)
    assert sorted(store.cells().collect()) == sorted(before) and store.versions.current() == 1
    with pytest.raises(RuntimeError, match="progress batch 5"):
        store._add(observed(spark, 0, 500), 5)


def test_train_command_with_a_store(spark, tmp_path):
    tables.write_observations_csv(observed(spark, 0, 2_000), str(tmp_path / "o.csv"))
    shown = jobs.train_appended(spark, str(tmp_path / "o.csv"), str(tmp_path / "store"), str(tmp_path / "models"))
    assert {r.metric for r in shown.collect()} == {"accuracy", "precision", "mae"}
    assert Registry(spark, str(tmp_path / "models")).current() == 1


def test_bootstrap_weights_are_poisson(spark):
    rows = spark.range(0, 20_000).select("id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("tree"))
    drawn = rows.withColumn("w", train.bootstrap_weight(F.col("id"), F.col("tree")))
    counts = dict(drawn.groupBy("w").count().collect())
    for k, expected in enumerate((0.36788, 0.36788, 0.18394, 0.06131, 0.01533)):
        assert abs(counts[k] / 100_000 - expected) < 0.006
    pairs = drawn.where("tree < 2").groupBy("id").pivot("tree", [0, 1]).agg(F.first("w"))
    assert abs(pairs.select(F.corr("0", "1")).first()[0]) < 0.03


@pytest.mark.parametrize("rows", [60_000, 500_000])
def test_trees_spread_as_in_a_fit_on_rows(spark, rows):
    """The variance between trees, averaged over feature combinations that occur."""
    target = "temp_celsius"
    data = train.training_rows(generate.observations(spark.range(0, rows, 1, 8), ANCHOR)).select("id", *FEATURES, "extreme", *TARGETS)
    at = train.feature_matrix(data.select(*FEATURES).distinct().orderBy(F.xxhash64(*FEATURES)).limit(400)).cache()
    own = train.fit_bootstrapped(train.bootstrap_cells(data, REGRESSOR_TREES), only=(target,))
    names = [f"{target}_tree_{t}" for t in range(REGRESSOR_TREES)]

    def spread(frames):
        values = [[r[0] for r in f.orderBy(*FEATURES).collect()] for f in frames]
        out = 0.0
        for cell in zip(*values, strict=True):
            mean = sum(cell) / len(cell)
            out += sum((v - mean) ** 2 for v in cell) / (len(cell) - 1)
        return out / len(values[0])

    mine = spread([own.transform(at.drop("features")).select(n, *FEATURES) for n in names])
    forest = RandomForestRegressor(
        numTrees=REGRESSOR_TREES, maxDepth=8, seed=1, featureSubsetStrategy="all", labelCol=target, predictionCol="p"
    ).fit(train.feature_matrix(data.repartition(8)).cache())
    theirs = spread([t.setPredictionCol("p").transform(at).select("p", *FEATURES) for t in forest.trees])
    at.unpersist()
    assert 0.75 < mine / theirs < 1.33, (mine, theirs)


def test_row_bootstrap_scores_and_reloads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(train, "CLASSIFIER_TREES", 3)
    monkeypatch.setattr(train, "REGRESSOR_TREES", 2)
    job = train.train(observed(spark, 0, 8_000), bootstrap="rows")
    values = {(r.model, r.metric): r.value for r in job.metrics().collect()}
    assert len(values) == 6 and abs(values["temp_celsius", "mae"] / 9.57 - 1) < 0.15 and values["extreme", "accuracy"] > 0.8
    train.save_model(job.model, str(tmp_path / "m"))
    assert same_rows(job.grid, train.prediction_grid(spark, train.load_model(str(tmp_path / "m"))))
    with pytest.raises(ValueError, match="no bootstrap"):
        train.train(observed(spark, 0, 10), bootstrap="x")
